"""Spelling variants: words at one edit's distance, by k-d trees over letter-count vectors.

Words are the runs of Latin letters of all texts (see ``counts``). Two words are near if one inserted, deleted
or replaced letter turns one into the other. Then their letter counts differ by 1 in sum (lengths l and l + 1) or by
0 or 2 (equal lengths); folding letters into ``GROUPS`` groups makes no difference larger.

* Cells: each length's words are dealt out by the top levels of a k-d tree over their counts, with about ``CELL`` words in
  a leaf. The splits are fitted on a bounded sample (``SAMPLE`` words in expectation, by a hash); every word is placed.
  A word goes to its own cell and visits the other cells of its length, and those of the next
  length, whose boxes are within 2 and 1 of its counts.
* A cell with more words, or more visitors, than a task should hold is cut into pieces by a hash. Each visitor meets each
  piece, so nothing is lost and no task holds more than a piece and its share of visitors.
* In a task: a k-d tree with tight boxes over the piece. Words descend into the nodes within the radius;
  those at the leaves that pass a bit test of the counts are compared letter by letter.
* A task gives for each word the number of its near words there and the best of them, so pairs are never rows.

``form`` points at a word at least twice as frequent, so following forms ends. Roots are found by doubling
the pointers: each round joins the table with itself, and paths halve.

Defined results: null texts have no words; a null doc_id counts as empty in the deletion rule; repeated rows count
each; ties go to the smaller word in code-point order; no words give an empty result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import on_executors, sized, stored

LEAST_LETTERS, LEAST_COUNT = 5, 3
MARK = 97  # runs whose crc32 this divides lose a letter
FACTOR = 2  # a form is at least so many times as frequent
GROUPS = 32
CELL = 1 << 14  # words of a cell, and of a piece
VISITORS = 1 << 16  # visitors that a task takes
BYTES = 1 << 24  # letters of a piece
SAMPLE = 1 << 17
LEAF = 16
BLOCK = 1024  # words that descend together
FLUSH = 200_000  # words that a task counts before it hands the counts on

#: Latin-1 bytes: letters stay, A-Z lower-cased; all others become spaces
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: group of each byte: a to z have their own, accented letters share the rest
_GROUP = np.array([c - 97 if 97 <= c <= 122 else 26 + c % (GROUPS - 26) for c in range(256)], dtype=np.int64)


def runs_of(text: str | None) -> list[bytes]:
    """Maximal runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_KEPT).split() if text else []


def word_of(doc_id, run: bytes) -> bytes:
    """The run, without one letter where the crc32 of ``doc_id:run`` says so."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()))
    return run if h % MARK else run[:h % len(run)] + run[h % len(run) + 1:]


def counts(docs: DataFrame) -> DataFrame:
    """word, n of all documents: words of ``LEAST_LETTERS`` letters that occur ``LEAST_COUNT`` times."""
    on_executors(docs.sparkSession)

    def run(batches):
        total: Counter = Counter()

        def flush():
            batch = pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in total], pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seed = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
                for r, n in Counter(runs_of(text)).items():
                    if len(r) >= LEAST_LETTERS:  # (a shorter run can't become a word)
                        if not zlib.crc32(r if r.isascii() else r.decode("latin-1").encode(), seed) % MARK:
                            r = word_of(doc_id, r)
                        if len(r) >= LEAST_LETTERS:
                            total[r] += n
                if len(total) >= FLUSH:
                    yield flush()
        yield flush()

    found = docs.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def letters(words: list[str], length: int) -> np.ndarray:
    """A row of bytes per word; all words have ``length`` letters."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), length)


def vectors(rows: np.ndarray) -> np.ndarray:
    """Letters per group, at most 120 (a cut makes no difference larger)."""
    m = len(rows)
    at = np.arange(m)[:, None] * GROUPS + _GROUP[rows]
    return np.minimum(np.bincount(at.ravel(), minlength=m * GROUPS), 120).astype(np.int8).reshape(m, GROUPS)


def marks(v: np.ndarray) -> np.ndarray:
    """64 bits per vector, one if a group has a letter, one if it has two; near words differ in at most two bits."""
    bits = np.concatenate([v >= 1, v >= 2], axis=1)
    return np.packbits(bits, axis=1).view(np.uint64).ravel()


def _halves(v: np.ndarray):
    """The split of a box that parts its points best: group and greatest value of the lower side (None: all equal)."""
    low, high = v.min(axis=0), v.max(axis=0)
    best = None
    for g in np.flatnonzero(high > low):
        values, n = np.unique(v[:, g], return_counts=True)
        below = np.cumsum(n)[:-1]
        i = int(np.argmin(np.abs(below - len(v) / 2)))
        if best is None or abs(below[i] - len(v) / 2) < best[0]:
            best = (abs(below[i] - len(v) / 2), int(g), int(values[i]))
    return best and best[1:]


class Cells:
    """Boxes that part the whole space of counts; fitted on a sample."""

    def __init__(self, sample: np.ndarray, cells: int):
        floor, ceiling = np.zeros(GROUPS, dtype=np.int8), np.full(GROUPS, 120, dtype=np.int8)
        boxes = [(sample, floor, ceiling)]
        while len(boxes) < cells:
            boxes.sort(key=lambda b: -len(b[0]))
            v, low, high = boxes[0]
            cut = _halves(v) if len(v) > 1 else None
            if cut is None:
                break
            g, top = cut
            left, right = high.copy(), low.copy()
            left[g], right[g] = top, top + 1
            boxes[:1] = [(v[v[:, g] <= top], low, left), (v[v[:, g] > top], right, high)]
        self.low, self.high = np.array([b[1] for b in boxes]), np.array([b[2] for b in boxes])

    def within(self, v: np.ndarray, radius: int):
        """(point, cell) of all cells at most ``radius`` from each point."""
        points, cells = [], []
        for a in range(0, len(v), 1 << 13):
            part = v[a:a + (1 << 13)]
            for c in range(len(self.low)):
                p = np.flatnonzero(gaps(part, self.low[c], self.high[c]) <= radius)
                points.append(p + a)
                cells.append(np.full(len(p), c))
        return np.concatenate(points), np.concatenate(cells)


def gaps(v: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """L1 distances of points from boxes."""
    return np.maximum(np.maximum(low - v, v - high), 0).sum(axis=1, dtype=np.int32)


class Tree:
    """A k-d tree with tight boxes; its points are reordered so that each node is a range."""

    def __init__(self, v: np.ndarray):
        self.order = np.arange(len(v))
        self.nodes: list[tuple[int, int, int]] = []  # first, end, left child (the right one follows; -1: leaf)
        todo = [(0, len(v))]
        low, high = [], []
        while len(self.nodes) < len(todo):
            lo, hi = todo[len(self.nodes)]
            own = v[self.order[lo:hi]]
            low.append(own.min(axis=0))
            high.append(own.max(axis=0))
            cut = self._cut(own) if hi - lo > LEAF else None
            if cut is None:
                self.nodes.append((lo, hi, -1))
            else:
                below, middle = cut
                self.order[lo:hi] = self.order[lo:hi][np.argsort(~below, kind="stable")]
                self.nodes.append((lo, hi, len(todo)))
                todo += [(lo, lo + middle), (lo + middle, hi)]
        self.low, self.high = np.array(low), np.array(high)
        self.first, self.end, self.child = np.array(self.nodes, dtype=np.int64).T

    @staticmethod
    def _cut(own: np.ndarray):
        """Split at the group whose values part the points most evenly; None if all are equal."""
        best = None
        for value in np.unique(own):
            below = (own <= value).sum(axis=0)
            g = int(np.argmin(np.abs(below - len(own) / 2)))
            off = abs(below[g] - len(own) / 2)
            if 0 < below[g] < len(own) and (best is None or off < best[0]):
                best = (off, g, value, int(below[g]))
        return best and (own[:, best[1]] <= best[2], best[3])

    def search(self, v: np.ndarray, radius: int):
        """(query, point) pairs from all leaves within ``radius``, in blocks."""
        for a in range(0, len(v), BLOCK):
            part = v[a:a + BLOCK]
            q, k = np.arange(len(part)), np.zeros(len(part), dtype=np.int64)
            while len(q):
                near = gaps(part[q], self.low[k], self.high[k]) <= radius
                q, k = q[near], k[near]
                leaf = self.child[k] < 0
                size = self.end[k[leaf]] - self.first[k[leaf]]
                if len(size):
                    point = np.repeat(self.first[k[leaf]] - np.cumsum(size) + size, size) + np.arange(size.sum())
                    yield np.repeat(q[leaf], size) + a, self.order[point]
                q, k = np.repeat(q[~leaf], 2), np.repeat(self.child[k[~leaf]], 2)
                k[1::2] += 1


def one_replaced(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a != b).sum(axis=1) == 1


def one_inserted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether dropping one letter of ``b`` (one longer) gives ``a``: common start and end cover ``a``."""
    start = np.cumprod(a == b[:, :-1], axis=1, dtype=np.uint8).sum(axis=1)
    end = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1, dtype=np.uint8).sum(axis=1)
    return start.astype(np.int64) + end >= a.shape[1]


def near_pairs(a: list[str], b: list[str]):
    """(row of a, row of b) of all near words; words of b have the same length or one letter more."""
    la, lb = len(a[0]), len(b[0])
    ra, rb = letters(a, la), letters(b, lb)
    va, vb = vectors(ra), vectors(rb)
    ma, mb = marks(va), marks(vb)
    same = la == lb
    out = [(np.zeros(0, dtype=np.int64),) * 2]
    step = max(1, (1 << 22) // lb)  # candidates compared at a time
    for q, p in Tree(vb).search(va, 2 if same else 1):
        like = np.bitwise_count(ma[q] ^ mb[p]) <= (2 if same else 1)
        q, p = q[like], p[like]
        for i in range(0, len(q), step):
            x, y = q[i:i + step], p[i:i + step]
            ok = one_replaced(ra[x], rb[y]) if same else one_inserted(ra[x], rb[y])
            out.append((x[ok], y[ok]))
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


OWN, GUEST, SHORTER = 0, 1, 2  # how a word comes to a cell: it lies there, visits its own length, or the next
FOUND = "word string, n_near long, form_n long, form string"


def _summary(words: list[str], of: np.ndarray, others: list[str], n: np.ndarray, which: np.ndarray):
    """For each word with near ones: how many, and the most frequent (smallest word of those)."""
    order = np.array(sorted(range(len(others)), key=lambda i: (-n[i], others[i])))
    place = np.empty(len(order), dtype=np.int64)
    place[order] = np.arange(len(order))
    best = np.full(len(words), len(order))
    np.minimum.at(best, of, place[which])
    many = np.bincount(of, minlength=len(words))
    for i in np.flatnonzero(many):
        top = order[best[i]]
        yield words[i], int(many[i]), int(n[top]), others[top]


def _in_cell(rows: pa.Table) -> pa.Table:
    """Near words of one piece of a cell and its visitors."""
    side = {s: rows.filter(pc.equal(rows["side"], s)) for s in (OWN, GUEST, SHORTER)}
    words, n = side[OWN]["word"].to_pylist(), side[OWN]["n"].to_numpy()
    found: list[tuple] = []
    for s in (OWN, GUEST, SHORTER):
        guests, gn = side[s]["word"].to_pylist(), side[s]["n"].to_numpy()
        if words and guests and not (s == OWN and rows["share"][0].as_py()):  # (own words meet in the first share only)
            q, p = near_pairs(guests, words)
            found += _summary(guests, q, words, n, p)
            if s == SHORTER:
                found += _summary(words, p, guests, gn, q)
    columns = zip(*found, strict=True) if found else ((), (), (), ())
    types = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "form_n", "form"])


def fit_cells(words: DataFrame) -> dict[int, Cells | None]:
    """For each length its boxes (None: one cell)."""
    sizes = {r.l: r["count"] for r in words.groupBy(F.char_length("word").alias("l")).count().collect()}
    large = {l: n for l, n in sizes.items() if n > CELL}
    cells: dict[int, Cells | None] = dict.fromkeys(sizes)
    if large:
        share = min(1.0, SAMPLE / sum(large.values()))
        picked = words.where(F.char_length("word").isin(list(large)) & (F.pmod(F.xxhash64("word"), F.lit(1 << 30)) < int(share * (1 << 30))))
        by_length: dict[int, list[str]] = {}
        for r in picked.select("word").collect():
            by_length.setdefault(len(r.word), []).append(r.word)
        for l, ws in by_length.items():
            cells[l] = Cells(vectors(letters(sorted(ws), l)), min(-(-large[l] // CELL), max(1, len(ws) // 16)))
    return cells


def routed(words: DataFrame) -> DataFrame:
    """l, cell, side, word, n: every word in its cell, and in those that it visits."""
    shared = words.sparkSession.sparkContext.broadcast(fit_cells(words))

    def run(batches):
        cells = shared.value
        for batch in batches:
            by_length: dict[int, list] = {}
            for w, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_length.setdefault(len(w), []).append((w, n))
            for l, part in by_length.items():
                (ws, ns), v = zip(*part, strict=True), None
                for length, side, radius in ((l, OWN, 0), (l, GUEST, 2), (l + 1, SHORTER, 1)):
                    if length not in cells or (side == GUEST and not cells[length]):
                        continue
                    if cells[length] is None:
                        at, cell = np.arange(len(ws)), np.zeros(len(ws), dtype=np.int64)
                    else:
                        v = vectors(letters(ws, l)) if v is None else v
                        at, cell = cells[length].within(v, radius)
                        if side == GUEST:  # (a word needn't visit the cell it lies in)
                            home = np.empty(len(ws), dtype=np.int64)
                            home[lies[0]] = lies[1]
                            at, cell = at[cell != home[at]], cell[cell != home[at]]
                    if side == OWN:
                        lies = at, cell
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([length] * len(at), pa.int32()), pa.array(cell, pa.int32()), pa.array([side] * len(at), pa.int32()),
                         pa.array([ws[i] for i in at], pa.string()), pa.array([ns[i] for i in at], pa.int64())], names=["l", "cell", "side", "word", "n"])

    return words.select("word", "n").mapInArrow(run, "l int, cell int, side int, word string, n long")


def near(words: DataFrame) -> DataFrame:
    """word, n_near, form_n, form: how many words are near, and the most frequent of them."""
    rows = stored(routed(words), "routed")
    room = F.greatest(F.lit(1), F.least(F.lit(CELL), F.lit(BYTES) / F.col("l")))  # words of a piece
    load = rows.groupBy("l", "cell").agg(F.count(F.when(F.col("side") == OWN, 1)).alias("own"), F.count(F.when(F.col("side") != OWN, 1)).alias("visits"))
    plan = load.where("own > 0").select("l", "cell", F.ceil(F.col("own") / (2 * room)).alias("pieces"), F.ceil(F.col("visits") / (room * (VISITORS // CELL))).alias("shares"))
    h = F.xxhash64("word")
    piece, share = F.pmod(h, F.col("pieces")), F.pmod(F.shiftright(h, 20), F.greatest("shares", F.lit(1)))
    meets = F.filter(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1), lambda p: (F.col("side") != OWN) | (p != F.col("piece")))
    dealt = rows.join(sized(stored(plan, "plan")), ["l", "cell"]).withColumn("piece", piece).withColumn("share", share)
    own = dealt.where(F.col("side") == OWN).withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest("shares", F.lit(1)) - 1)))
    # own words of a cell in several pieces also visit the other pieces
    visits = dealt.where((F.col("side") != OWN) | (F.col("pieces") > 1)).withColumn("piece", F.explode(meets)).withColumn("side", F.greatest("side", F.lit(GUEST)))
    parts = own.select("l", "cell", "piece", "share", "side", "word", "n").unionAll(visits.select("l", "cell", "piece", "share", "side", "word", "n"))
    found = parts.groupBy("l", "cell", "piece", "share").applyInArrow(_in_cell, FOUND)
    best = F.min_by(F.struct("form_n", "form"), F.struct(-F.col("form_n"), F.col("form")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", "best.form_n", "best.form")


def roots(links: DataFrame) -> DataFrame:
    """word, root: from ``word, form`` rows the last form reached; paths halve in each round."""
    at = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = stored(at.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        at = step.select("word", "root")
        if not step.where("moved").limit(1).count():
            return at


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word of the documents."""
    on_executors(docs.sparkSession)
    words = stored(counts(docs), "words")
    chosen = F.col("form_n") >= FACTOR * F.col("n")
    table = stored(words.join(near(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")), "forms")
    found = roots(table.where(F.col("form").isNotNull()))
    return table.join(found, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
