"""Language identification: known words first, then ever shorter character n-grams.

A word seen in training scores by its smoothed log frequency in each language. An unseen word
backs off: its n-grams of the longest order of which any is known (``ORDERS``) are averaged.
The word scores of a text are summed; the posterior is taken over at most ``EVIDENCE`` words'
worth of the mean, so that long texts don't all round to 1.

Words are maximal runs of letters (Unicode's ``L``) of the lower-cased text; fitting and prediction
share ``words_of``. Number signs, however much they look like letters, are none.

Fit on all rows with text and language: all their words and n-grams are counted, in Spark, and none is dropped or estimated.
The counts are stored, a row per term. The terms with the most frequent (language, term) pairs, with at most ``HEAD`` pairs in all, also
come to the driver, the ``Table`` that goes to each worker; so a model in memory is of bounded size whatever the table. If there are no
others, a batch of texts is scored by looking all its words up at once. Else workers add up what they find of a text, and hand on its other
words, which are joined with the stored counts; those unseen are cut to n-grams, each word once, and n-grams not in memory are joined in turn.
What that gives is added up per text, as whole numbers of ``1 / SCALE``, so in any order. Every text is scored whole.

Defined results: null or letterless text gives ``und`` and 0.0, as does any text when nothing
could be learned; ties go to the smaller language name; repeated rows each give a row; an empty
table gives an empty result; a null doc_id counts as held out False; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructType

from .common import Splitter, held_out, map_rows, on_executors, stored

SAMPLE_ROWS = LEAST_ROWS = None  # no sample is drawn; the names are there for callers that set them
HEAD = 300_000  # pairs of language and term that workers hold, of words and of n-grams
SCALE = 1 << 28  # no sum over the words of a text overflows: 2^30 words of the highest score stay below 2^63
ORDERS = (4, 3, 2, 1)
EVIDENCE = 12
ACCEPT = 0.4  # least posterior of a document that a filter keeps
FLUSH = 200_000  # counts that a task holds
UNKNOWN = "und"
LETTERS = Splitter(r"\p{L}+")
INTS, LONGS, STRINGS = ArrayType(IntegerType()), ArrayType(LongType()), ArrayType(StringType())
HELD = StructType().add("total", ArrayType(DoubleType())).add("n", "long").add("terms", STRINGS).add("times", LONGS)
BACKED = StructType().add("order", "integer").add("slots", INTS).add("values", LONGS).add("far_orders", INTS).add("far", STRINGS)
FOUND = StructType().add("lang_pred", "string").add("score", "double")


def words_of(text: str) -> list[str]:
    return LETTERS(text.lower())


def grams_of(word: str, order: int) -> list[str]:
    padded = f"^{word}$"
    return [padded[i:i + order] for i in range(len(padded) - order + 1)]


def sums(of: np.ndarray, vectors: np.ndarray, size: int) -> np.ndarray:
    """The sum of the vectors of each of ``size`` groups."""
    return np.stack([np.bincount(of, weights=v, minlength=size) for v in vectors.T], axis=1)


def _entry(slot, value: int):
    return F.array(F.struct(slot.alias("slot"), F.lit(value).cast("long").alias("value")))


class Tail:
    """The stored counts ``term, counts`` of all terms that a table doesn't hold."""

    def __init__(self, rows: DataFrame, names: list[str]):
        self.rows, self.names = rows, names

    def counts(self, terms: pa.Array) -> np.ndarray:
        """A row per term, a column per language, found by a join; for the driver."""
        asked = self.rows.sparkSession.createDataFrame(pa.table({"at": pa.array(range(len(terms)), pa.int64()), "term": terms}))
        got = self.rows.join(F.broadcast(asked), "term").select("at", F.inline("counts")).toArrow()
        out = np.zeros((len(terms), len(self.names)))
        out[got["at"].to_numpy(), pc.index_in(got["lang"], value_set=pa.array(self.names)).to_numpy()] = got["n"].to_numpy()
        return out

    def entries(self, name: str, slot: int, value: int) -> DataFrame:
        """``name`` and entries (of slot, value): what an occurrence of the term adds to each language that it was seen in, beyond what an
        unseen term would; and another slot with its value."""
        langs = F.array(*map(F.lit, self.names))
        seen = F.transform("counts", lambda c: F.struct((F.array_position(langs, c["lang"]) - 1).cast("int").alias("slot"),
                                                        F.round(F.log(c["n"] * 10 + 1) * SCALE).cast("long").alias("value")))
        return self.rows.select(F.col("term").alias(name), F.concat(seen, _entry(F.lit(slot), value)).alias("entries"))


class Table:
    """Log frequencies of terms, one column per language: ``base`` of a term's group for one that a language lacks, and for each
    term held what its count adds (``seen``). ``tail`` has the others, if any; it stays with the driver."""

    def __init__(self, head: pa.Table, names: list[str], totals: dict, kinds: dict, tail: Tail | None, groups: bool):
        terms, langs = (head[c].combine_chunks() for c in ("term", "lang"))
        coded = terms.dictionary_encode()
        self.terms, self.tail, self.whole, self.groups = coded.dictionary, tail, tail is None, groups
        # occurrences and distinct terms among the n-grams of one order, or among all words
        self.total = np.zeros((1 + max(ORDERS) if groups else 1, len(names)))
        self.kinds = np.zeros(len(self.total))
        for (g, lang), n in totals.items():
            self.total[g, names.index(lang)] = n
        for g, n in kinds.items():
            self.kinds[g] = n
        self.base = np.zeros_like(self.total)
        some = self.kinds > 0
        self.base[some] = np.log(0.1) - np.log(self.total[some] + 0.1 * self.kinds[some, None])
        m = np.zeros((len(self.terms), len(names)))
        m[coded.indices.to_numpy(), pc.index_in(langs, value_set=pa.array(names)).to_numpy()] = head["n"].to_numpy()
        self.seen = np.log(10 * m + 1).astype(np.float32)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"tail": None}

    def place(self, terms: pa.Array) -> np.ndarray:
        """The row of each term held, or -1."""
        return pc.fill_null(pc.index_in(terms, value_set=self.terms), -1).to_numpy()

    def look_up(self, terms: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Whether each term is known, and its scores."""
        rows = self.place(terms)
        known, seen = rows >= 0, np.zeros((len(terms), self.seen.shape[1]))
        seen[known] = self.seen[rows[known]]
        left = np.flatnonzero(~known)
        if self.tail and len(left):
            counts = self.tail.counts(terms.take(pa.array(left)))
            known[left], seen[left] = counts.any(axis=1), np.log(10 * counts + 1)
        return known, seen + self.base[pc.utf8_length(terms).to_numpy() if self.groups else np.zeros(len(terms), dtype=np.int64)]


class Model:
    """Per-language log frequencies of words and n-grams."""

    def __init__(self, langs: list[str], words: Table | None = None, grams: Table | None = None):
        self.langs, self.words, self.grams = langs, words, grams

    @property
    def whole(self) -> bool:
        """Whether workers hold all terms."""
        return not self.langs or (self.words.whole and self.grams.whole)

    @staticmethod
    def _bags(texts: list[str | None]) -> tuple[pa.DictionaryArray, np.ndarray, np.ndarray]:
        """The distinct words of each text, its place, and how often it has the word."""
        bags = [Counter(words_of(t)) if t else Counter() for t in texts]
        of = np.repeat(np.arange(len(bags)), np.array([len(b) for b in bags], dtype=np.int64))
        return pa.array([w for b in bags for w in b], pa.string()).dictionary_encode(), of, np.array([n for b in bags for n in b.values()], dtype=np.int64)

    @staticmethod
    def _grams(words: list[str], order: int) -> tuple[pa.DictionaryArray, np.ndarray]:
        """The n-grams of each word, and its place."""
        grams = [grams_of(w, order) for w in words]
        of = np.repeat(np.arange(len(words)), np.array([len(g) for g in grams], dtype=np.int64))
        return pa.array([x for g in grams for x in g], pa.string()).dictionary_encode(), of

    def vectors(self, words: pa.Array) -> np.ndarray:
        """The scores of distinct words."""
        known, out = self.words.look_up(words)
        left = np.flatnonzero(~known)
        out[left] = 0.0
        for order in ORDERS:
            if not len(left):
                break
            coded, of = self._grams(words.take(pa.array(left)).to_pylist(), order)
            known, scores = self.grams.look_up(coded.dictionary)
            at = coded.indices.to_numpy()
            known, scores = known[at], scores[at]
            n = np.bincount(of[known], minlength=len(left))
            found = n > 0
            out[left[found]] = sums(of[known], scores[known], len(left))[found] / n[found, None]
            left = left[~found]
        return out

    def _choose(self, total: np.ndarray, n: np.ndarray) -> tuple[list[str], list[float]]:
        """Language and score of texts of ``n`` words, from the sums of their words' scores."""
        pred, score = [UNKNOWN] * len(n), [0.0] * len(n)
        for i in np.flatnonzero(n):
            p = np.exp((total[i] - total[i].max()) * (min(n[i], EVIDENCE) / n[i]))
            best = int(np.argmax(total[i]))
            pred[i], score[i] = self.langs[best], float(p[best] / p.sum())
        return pred, score

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text."""
        coded, of, times = self._bags(texts)
        if not self.langs or not len(coded):
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        vectors = self.vectors(coded.dictionary)[coded.indices.to_numpy()] * times[:, None]
        return self._choose(sums(of, vectors, len(texts)), np.bincount(of, weights=times, minlength=len(texts)))

    def held(self, texts: list[str | None]) -> tuple[list, list, list, list]:
        """``HELD`` of each text: the sums over its words that are held, the number of all its words, and the other words."""
        coded, of, times = self._bags(texts)
        at = self.words.place(coded.dictionary)[coded.indices.to_numpy()]
        found, left = np.flatnonzero(at >= 0), np.flatnonzero(at < 0)
        total = sums(of[found], (self.words.seen[at[found]] + self.words.base[0]) * times[found, None], len(texts))
        terms, times_left = coded.dictionary.take(coded.indices.take(pa.array(left))).to_pylist(), times[left].tolist()
        cuts = np.searchsorted(of[left], np.arange(len(texts) + 1)).tolist()
        parts = list(zip(cuts, cuts[1:], strict=False))
        n = np.bincount(of, weights=times, minlength=len(texts)).astype(np.int64)
        return total.tolist(), n.tolist(), [terms[a:b] for a, b in parts], [times_left[a:b] for a, b in parts]

    def backed(self, words: list[str]) -> tuple[list, list, list, list, list]:
        """``BACKED`` of each unseen word: the longest order of which an n-gram is held, with the sums over those held (slot -1: their
        number), and the other n-grams of that and longer orders."""
        order = np.zeros(len(words), dtype=np.int32)
        slots, values, far_orders, far = ([[] for _ in words] for _ in range(4))
        left = np.arange(len(words))
        for o in ORDERS:
            if not len(left):
                break
            coded, of = self._grams([words[i] for i in left], o)
            at = self.grams.place(coded.dictionary)[coded.indices.to_numpy()]
            held = at >= 0
            n = np.bincount(of[held], minlength=len(left))
            total = np.rint(sums(of[held], self.grams.seen[at[held]].astype(np.float64), len(left)) * SCALE).astype(np.int64)
            for i in np.flatnonzero(n):
                some = np.flatnonzero(total[i])
                slots[left[i]], values[left[i]] = [-1, *some.tolist()], [int(n[i]), *total[i, some].tolist()]
            order[left[n > 0]] = o
            if not self.grams.whole:
                others = np.flatnonzero(~held)
                for i, g in zip(left[of[others]], coded.dictionary.take(coded.indices.take(pa.array(others))).to_pylist(), strict=True):
                    far_orders[i].append(o)
                    far[i].append(g)
            left = left[n == 0]
        return order.tolist(), slots, values, far_orders, far

    def joined(self, total: list, n: list, slots: list, values: list) -> tuple[list[str], list[float]]:
        """Language and score, from the sums over the words held and those by slot: a language's, or, after these, the number of words
        that had scores as words (0) or by n-grams of an order."""
        size = len(self.langs)
        of = np.repeat(np.arange(len(n)), np.array([len(s) for s in slots], dtype=np.int64))
        more = np.zeros((len(n), size + 1 + max(ORDERS)))
        more[of, np.array([x for s in slots for x in s], dtype=np.int64)] = np.array([x for v in values for x in v], dtype=np.float64) / SCALE
        base = np.concatenate([self.words.base, self.grams.base[1:]])
        return self._choose(np.array(total).reshape(-1, size) + more[:, :size] + more[:, size:] @ base, np.array(n))


def _tally(rows: DataFrame, terms) -> DataFrame:
    """term, counts (of lang, n), most: ``terms(value)`` of all rows ``lang, value, n``, counted in tasks and then in a shuffle."""
    def run(batches):
        total: dict[str, Counter] = defaultdict(Counter)

        def flush(last=False):
            """Hand on all counts; or, if enough room is left then, those of 1 only, as the others tend to come again."""
            all_ = last or 2 * sum(n > 1 for c in total.values() for n in c.values()) > FLUSH
            out = [(lang, t, n) for lang, c in total.items() for t, n in c.items() if all_ or n == 1]
            for lang, c in total.items():
                total[lang] = Counter() if all_ else Counter({t: n for t, n in c.items() if n > 1})
            return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "term", "n"])

        for batch in batches:
            for lang, value, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = total[lang]
                if n == 1:
                    own.update(terms(value))
                else:
                    for t in terms(value):
                        own[t] += n
                if sum(map(len, total.values())) >= FLUSH:
                    yield flush()
        yield flush(last=True)

    counted = rows.mapInArrow(run, "lang string, term string, n long").repartition("term").groupBy("term", "lang").agg(F.sum("n").alias("n"))
    return counted.groupBy("term").agg(F.collect_list(F.struct("lang", "n")).alias("counts"), F.max("n").alias("most"))


def _table(counted: DataFrame, names: list[str], groups: bool) -> Table:
    """The table of stored counts ``term, counts, most``: what comes to the driver is bounded, the rest is found by joins."""
    group = (F.length("term") if groups else F.lit(0)).alias("g")
    pairs = counted.select(group, "term", F.inline("counts"))
    totals = {(r.g, r.lang): r.n for r in pairs.groupBy("g", "lang").agg(F.sum("n").alias("n")).collect()}
    size = F.floor(F.log2("most") * 8) * 16 + F.pmod(F.xxhash64("term"), F.lit(16))  # equal counts in sixteenths, to fill the head
    kinds, sizes = Counter(), Counter()
    for r in counted.groupBy(group, size.alias("b")).agg(F.count("*").alias("terms"), F.sum(F.size("counts")).alias("pairs")).collect():
        kinds[r.g] += r.terms
        sizes[r.b] += r.pairs
    least, held = None, 0
    for b, n in sorted(sizes.items(), reverse=True):
        held += n
        if held > HEAD:
            break
        least = b
    own = F.lit(held <= HEAD) if held <= HEAD or least is None else size >= least
    tail = Tail(counted.where(~own).select("term", "counts"), names) if held > HEAD else None
    return Table(counted.where(own).select("term", F.inline("counts")).toArrow(), names, totals, kinds, tail, groups)


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from all rows with text and language."""
    on_executors(labelled.sparkSession)
    rows = labelled.where(F.col(text).isNotNull() & F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("value"), F.lit(1).cast("long").alias("n"))
    words = stored(_tally(rows, words_of), "words")
    pairs = words.select(F.col("term").alias("value"), F.inline("counts"))
    names = sorted(r.lang for r in pairs.select("lang").distinct().collect())
    if not names:
        return Model(names)
    grams = stored(_tally(pairs.select("lang", "value", "n"), lambda w: [g for order in ORDERS for g in grams_of(w, order)]), "grams")
    return Model(names, _table(words, names, False), _table(grams, names, True))


def _backed(unseen: DataFrame, model: Model, shared) -> DataFrame:
    """term, entries (of slot, value): what an occurrence of each of these unseen terms adds, see ``Model.joined``; no row for one without
    a known n-gram."""
    backed = map_rows(unseen, ["term"], ["term"], BACKED, lambda words: shared.value.backed(words))
    near = F.arrays_zip(F.col("slots").alias("slot"), F.col("values").alias("value"))
    if model.grams.tail:
        backed = stored(backed, "backed")
        others = backed.select("term", F.inline(F.arrays_zip(F.col("far_orders").alias("order"), "far")))
        others = others.join(model.grams.tail.entries("far", -1, 1), "far").select("term", "order", F.inline("entries"))
        each = backed.select("term", "order", F.inline(near)).union(others).repartition("term").groupBy("term", "order", "slot").agg(F.sum("value").alias("value"))
        each = each.groupBy("term", "order").agg(F.collect_list(F.struct("slot", "value")).alias("entries"))
        each = each.groupBy("term").agg(F.max("order").alias("order"), F.max_by("entries", "order").alias("entries"))
    else:
        each = backed.where("order > 0").select("term", "order", near.alias("entries"))
    number = F.filter("entries", lambda e: e["slot"] < 0)[0]["value"]
    mean = F.transform(F.filter("entries", lambda e: e["slot"] >= 0), lambda e: F.struct(e["slot"].alias("slot"), F.round(e["value"] / number).cast("long").alias("value")))
    return each.select("term", F.concat(mean, _entry(F.col("order") + len(model.langs), SCALE)).alias("entries"))


def identify(docs: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] | None = None) -> DataFrame:
    """``docs`` (its columns ``keep``, else all) with ``lang_pred`` and ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    if model.whole:
        return map_rows(docs, names, [text], FOUND, lambda texts: list(shared.value.predict(texts)))
    own = docs.select(F.struct(*names).alias("own"), F.col(text).alias("text"))
    held = map_rows(own, ["own"], ["text"], HELD, lambda texts: shared.value.held(texts))
    held = stored(held.select(F.monotonically_increasing_id().alias("row"), "*"), "held")
    unseen, known = held.select("row", F.inline(F.arrays_zip(F.col("terms").alias("term"), "times"))), None
    if model.words.tail:
        known = unseen.join(model.words.tail.entries("term", len(model.langs), SCALE), "term", "left")
        known = known.select("row", "times", "entries", F.when(F.col("entries").isNull(), F.col("term")).alias("term")).repartition("row")
        known = known.select("row", "times", "term", F.inline_outer("entries")).groupBy("row", "slot", "term").agg(
            F.sum(F.col("times") * F.col("value")).alias("value"), F.sum("times").alias("times"))
        known = stored(known.groupBy("row").agg(F.collect_list(F.when(F.col("slot").isNotNull(), F.struct("slot", "value"))).alias("known"),
                                                F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "times"))).alias("unseen")), "known")
        unseen = known.select("row", F.inline("unseen"))
    each = unseen.join(_backed(unseen.select("term").distinct(), model, shared), "term").select("row", "times", F.inline("entries"))
    each = each.select("row", "slot", (F.col("times") * F.col("value")).alias("value"))
    if known is not None:
        each = each.union(known.select("row", F.inline("known")))
    parts = each.repartition("row").groupBy("row", "slot").agg(F.sum("value").alias("value")).groupBy("row").agg(F.collect_list(F.struct("slot", "value")).alias("parts"))
    found = held.select("row", "own", "total", "n").join(parts, "row", "left")
    found = found.select("own", "total", "n", *(F.coalesce(f"parts.{c}", F.array().cast(f"array<{kind}>")).alias(f"{c}s") for c, kind in (("slot", "int"), ("value", "long"))))
    return map_rows(found, ["own"], ["total", "n", "slots", "values"], FOUND, lambda *sums: list(shared.value.joined(*sums))).select("own.*", "lang_pred", "score")


def language_report(docs: DataFrame) -> DataFrame:
    """Learn from the documents that aren't held out (crc32 of the id modulo 5 is not 0); predict all."""
    model = fit(docs.where(~held_out("doc_id", 5, 0)))
    slim = docs.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "text")
    return identify(slim, model, keep=("doc_id", "held_out"))
