"""Personal data: candidate spans, boosted trees, calibrated thresholds; column expressions throughout.

High-recall generators propose spans that may overlap. A candidate's normalised form ('(at)' to '@',
separators and a missing plus put right) must pass the base checks of its kind, and it must not be cut
out of a longer word or number (``form``). A form that passes is labelled personal data unless a word
before it says that it is something else (``against``: version, invoice, ...), or it is a number without
'+' that no word before it calls a phone. Boosted trees learn these labels on the candidates of half of all
distinct texts (by a hash of the text) from shape and other surroundings only: nothing
that makes a label is a feature. Only candidates that pass, have no word against them and overlap no
base span may be added; the score above which such candidates and base spans in the other, held-out half
are at least ``PRECISION`` pure is the kind's threshold, and those above it are added. Base spans
always stay. For the fit, candidates that look alike are one row with a weight; no text is shuffled for it. The trees are applied as one nested conditional expression inside each row, so whole
texts are scanned where they lie and nothing is shuffled.

Defined results: null and empty texts have no spans; with no candidates nothing is added; where all are
of one class there are no trees and all score alike; a kind with fewer than ``LEAST_SUPPORT`` confirmed
held-out candidates adds nothing; of overlapping additions the one that starts first stays (then the longer);
repeated rows each give a row; an empty table gives an empty result; other columns pass through
``annotate`` and ``redact`` unless they bear the names these add.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .spans import find, in_order, joined, no_spans

KINDS = ("email", "ip", "card", "phone")
TREES = 10
DEPTH = 3
PRECISION = 0.98
LEAST_SUPPORT = 20  # confirmed held-out candidates of a kind before its threshold means anything
CONTEXT = 24  # characters on the left that context features see

# The base rules. A run that fails at its first character fails at the later ones too, so each
# run is tried once (a look-behind, or the end of the last match) and its loops don't back up.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The generators: looser forms of the same kinds.
GENERATORS = (
    ("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++(?:@|\x20?[(\[](?:at|AT)[)\]]\x20?)[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[](?:dot|DOT)[)\]]\x20?)[A-Za-z0-9-]++)++"),
    ("ip", r"(?:(?<![0-9])|\G)[0-9]{1,6}+(?:\.[0-9]{1,6}+){3}+"),
    ("card", r"(?:(?<![0-9])|\G)[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{4}[\x20.-]?[0-9]{1,7}+"),
    ("phone", r"(?:(?<![0-9])|\G)[+(]?[0-9][\x20().0-9/-]{5,18}[0-9]"),
)
_AT, _DOT = r"\x20?[(\[](?:at|AT)[)\]]\x20?", r"\x20?[(\[](?:dot|DOT)[)\]]\x20?"
PHONE_WORD = r"(?i)(?:phone|tel|call|fax|mobile|whatsapp)"
NEAR = (r"(?i)(?:mail|contact|write)", r"(?i)(?:card|visa|master|account|iban)", r"(?i)(?:\bip|host|server|address|gateway)")
# a word for another thing, with no word for personal data after it
AGAINST = (r"(?is)\b(?:version|order|isbn|invoice|build|release|v\.?\x20?$)"
           r"(?!.*(?:phone|tel|call|fax|mobile|whatsapp|card|visa|master|account|iban|\bip|host|server|address|gateway))")
FEATURES = ("kind", "length", "letters", "dots", "hyphens", "spaces", "slashes", "brackets", "groups", "first_group", "last_group",
            "mark_before", *(f"near{i}" for i in range(len(NEAR))))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    n = F.char_length(digits)
    digit = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    twice = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(F.sequence(F.lit(1), n), F.lit(0),
                        lambda acc, i: acc + F.when((n - i) % 2 == 1, twice(digit(i))).otherwise(digit(i)))
    return F.when(n > 0, total % 10 == 0).otherwise(F.lit(False))


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"


def base_spans(text: Column) -> Column:
    """The base rules' spans, all kinds, by kind then start."""
    digit = text.rlike("[0-9]")
    card = F.filter(find(text, "card", CARD, digit), lambda s: F.char_length(_digits(s["match"])).between(16, 19) & _luhn(_digits(s["match"])))
    ip = F.filter(find(text, "ip", IP, digit), lambda s: s["match"].rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
    phone = F.filter(find(text, "phone", PHONE, text.contains("+")), lambda s: F.char_length(_digits(s["match"])).between(8, 15))
    return F.concat(find(text, "email", EMAIL, text.contains("@")), ip, card, phone)


def candidates(text: Column) -> Column:
    """The generators' spans with ``form``, ``against`` and ``personal`` (the label), and features ``x`` (doubles, as in ``FEATURES``)."""
    digit = text.rlike("[0-9]")
    gates = {"email": text.contains("@") | text.rlike(r"[(\[](?:at|AT)[)\]]")}
    all_found = F.concat(*[find(text, kind, pattern, gates.get(kind, digit)) for kind, pattern in GENERATORS])

    def described(s):
        m = s["match"]
        bare = F.regexp_replace(m, r"^\+", "")  # a plus makes labels, so no feature sees it
        count = lambda chars: (F.char_length(m) - F.char_length(F.translate(m, chars, ""))).cast("double")
        before = F.substring(text, F.greatest(F.lit(1), s["start"] - CONTEXT + 1), F.least(F.lit(CONTEXT), s["start"]))
        after = F.substring(text, s["end"] + 1, F.lit(2))
        flag = lambda c: F.when(c, 1.0).otherwise(0.0)
        n = F.char_length(_digits(m))
        address = F.regexp_replace(F.regexp_replace(m, _AT, "@"), _DOT, ".")
        free = ~before.rlike(r"(?:[\p{L}0-9_]|[0-9][.,/-])$") & ~after.rlike(r"^(?:[\p{L}0-9_]|[.,/-][0-9])")
        form = F.when(s["kind"] == "email", address.rlike(f"^{EMAIL}$") & address.rlike(r"\.[A-Za-z]{2,}+$")).otherwise(free & (
            F.when(s["kind"] == "ip", m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")).when(s["kind"] == "card", n.between(16, 19) & _luhn(_digits(m))).otherwise(n.between(8, 15))))
        against = (s["kind"] != "email") & before.rlike(AGAINST)
        personal = form & ~against & ((s["kind"] != "phone") | m.startswith("+") | before.rlike(PHONE_WORD))
        group = lambda pattern: F.char_length(F.regexp_extract(bare, pattern, 0)).cast("double")
        values = [
            F.array_position(F.array(*[F.lit(k) for k in KINDS]), s["kind"]).cast("double"), F.char_length(bare).cast("double"),
            F.char_length(F.regexp_replace(m, "[^A-Za-z]", "")).cast("double"), count("."), count("-"), count(" "), count("/"), count("()[]"),
            F.char_length(F.regexp_replace(F.regexp_replace(m, "[0-9]++", "0"), "[^0]", "")).cast("double"), group("[0-9]++"), group("[0-9]++$"),
            flag(before.rlike(r"[:#=]\s?$")), *[flag(before.rlike(p)) for p in NEAR]]
        return F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), m.alias("match"), form.alias("form"),
                        against.alias("against"), personal.alias("personal"), F.array(*values).alias("x"))

    return F.transform(all_found, described)


class Model:
    """Trees as nested tuples, and a score threshold for each kind (none: nothing is added).

    ``checked``: only candidates whose form passes and that have no word against them may be added."""

    def __init__(self, trees: list, weights: list[float], thresholds: dict[str, float], checked: bool = False):
        self.trees, self.weights, self.thresholds, self.checked = trees, weights, thresholds, checked

    def margin(self, x: Column) -> Column:
        """The boosted sum, as one expression over an array of features."""
        def expr(node):
            if isinstance(node, float):
                return F.lit(node)
            at, cut, low, high = node
            return F.when(F.get(x, F.lit(at)) <= cut, expr(low)).otherwise(expr(high))

        total = F.lit(0.0)
        for tree, w in zip(self.trees, self.weights, strict=True):
            total = total + F.lit(w) * expr(tree)
        return total


def _nested(node) -> float | tuple:
    if node.getClass().getSimpleName() == "LeafNode":
        return float(node.prediction())
    split = node.split()
    return (int(split.featureIndex()), float(split.threshold()), _nested(node.leftChild()), _nested(node.rightChild()))


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Trees and thresholds from the candidates of all documents; equal texts count once."""
    both = docs.select(F.col(text).alias("t")).select(
        F.md5(F.col("t").cast("binary")).alias("digest"), base_spans(F.col("t")).alias("base"), candidates(F.col("t")).alias("c"),
        F.pmod(F.xxhash64("t", F.lit(5)), F.lit(2)).alias("half"))
    # a base span of its kind, or one that may be added: what overlaps other base spans never is
    apart = ~F.exists("base", lambda b: (b["start"] < F.col("c.end")) & (F.col("c.start") < b["end"])
                      & ~((b["kind"] == F.col("c.kind")) & (b["start"] == F.col("c.start")) & (b["end"] == F.col("c.end"))))
    rows = both.select("digest", "half", F.explode("c").alias("c"), "base").where(apart).select(
        "digest", "half", "c.kind", "c.start", "c.x", (F.col("c.form") & ~F.col("c.against")).alias("able"), F.when(F.col("c.personal"), 1.0).otherwise(0.0).alias("y")).distinct()
    rows = rows.groupBy("half", "kind", "able", "y", "x").agg(F.count("*").cast("double").alias("n"))
    rows = rows.select("*", *[F.get("x", F.lit(i)).alias(name + "_f") for i, name in enumerate(FEATURES)])
    rows = stored(VectorAssembler(inputCols=[name + "_f" for name in FEATURES], outputCol="features").transform(rows).select("half", "kind", "able", "y", "x", "n", "features"), "candidates")
    train = rows.where("half = 0")
    model = Model([], [], {}, checked=True)
    seen = {r.y: r["count"] for r in train.groupBy("y").count().collect()}
    if len(seen) == 2:
        # where a feature may be cut is drawn from a sample of the rows, unless there are at most the square of this
        bins = max(32, math.isqrt(sum(seen.values()) - 1) + 1)
        got = GBTClassifier(labelCol="y", featuresCol="features", weightCol="n", maxIter=TREES, maxDepth=DEPTH, maxBins=bins, stepSize=0.3, seed=1).fit(train)
        model.trees = [_nested(t._java_obj.rootNode()) if hasattr(t, "_java_obj") else _nested(t._call_java("rootNode")) for t in got.trees]
        model.weights = [float(w) for w in got.treeWeights]
    # one row per kind and score; walked from the top, the lowest score whose set is still pure enough
    tally = rows.where("half = 1 AND able").groupBy("kind", F.round(model.margin(F.col("x")), 6).alias("m")).agg(F.sum(F.col("y") * F.col("n")).alias("yes"), F.sum("n").alias("n")).collect()
    for kind in KINDS:
        yes = n = 0.0
        for r in sorted((r for r in tally if r.kind == kind), key=lambda r: -r.m):
            yes, n = yes + r.yes, n + r.n
            if yes >= LEAST_SUPPORT and yes / n >= PRECISION:
                model.thresholds[kind] = r.m
    return model


def annotate(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` (spans of the base rules) and ``added`` (accepted candidates)."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("base", base_spans(t))
    if not model.thresholds:
        return out.withColumn("added", no_spans())
    out = out.withColumn("added", candidates(t))

    def accepted(c):
        limit = F.lit(float("inf"))
        for kind, value in sorted(model.thresholds.items()):
            limit = F.when(c["kind"] == kind, F.lit(value)).otherwise(limit)
        free = ~F.exists(F.col("base"), lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
        if model.checked:
            free = free & c["form"] & ~c["against"]
        return free & (F.round(model.margin(c["x"]), 6) >= limit)

    kept = F.transform(F.filter("added", accepted), lambda c: F.struct(c["kind"].alias("kind"), c["start"].alias("start"), c["end"].alias("end"), c["match"].alias("match")))
    first = F.array_sort(F.transform(kept, lambda s: F.struct(s["start"].alias("a"), (-s["end"]).alias("b"), s.alias("s"))))
    apart = F.aggregate(first, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), lambda acc, x: F.when(
        x["a"] >= acc["at"], F.struct(x["s"]["end"].alias("at"), F.concat(acc["out"], F.array(x["s"])).alias("out"))).otherwise(acc), lambda a: a["out"])
    return out.withColumn("added", apart)


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with every span's characters replaced by its kind, as in ``[EMAIL]``."""
    t = F.col(text)
    spans = in_order(F.concat("base", "added"), KINDS, by_start=True)

    def step(acc, s):
        tag = F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]"))
        gap = F.substring(t, acc["at"] + 1, s["start"] - acc["at"])
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(acc["out"], F.array(gap, tag)).alias("out"))).otherwise(
            F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda a: F.concat(F.array_join(a["out"], ""), F.substring(t, a["at"] + 1, F.char_length(t)))
    out = annotate(docs, model, text)
    return out.withColumn(text, F.when(F.size("base") + F.size("added") > 0, F.aggregate(spans, start, step, rest)).otherwise(t)).drop("base", "added")


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans, and all spans of each document."""
    got = annotate(docs.select("doc_id", "text"), fit(docs))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return got.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                      joined(in_order(F.concat("base", "added"), KINDS, by_start=False)).alias("spans"))
