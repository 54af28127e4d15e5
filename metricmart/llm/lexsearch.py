"""Ranked lexical search: exact inner products through sparse ball trees.

A document is a sparse vector over the query terms; a coordinate is the term's saturated, length-normed
frequency (``impact``), an integer. A query item is the sparse vector of its terms' weights. The score is
their inner product.

* ``vectors`` counts each whole text once, in Spark's partitions, and keeps the counts of query terms.
  The corpus counts (documents, terms, document frequencies) are aggregated from that table.
* Every task builds ball trees over chunks of ``CHUNK`` documents of its own, so no vector is shuffled. A node has
  the centroid c and the radius r of its documents. No document in it scores above q.c + |q|r, where |q| is
  taken over the terms that occur in the node. The bound is rounded up beyond the error of its doubles (``SLACK``).
* Items visit nodes best bound first and leave a subtree as soon as its bound is below the lowest of the
  ``k`` scores found so far in the task. Documents of a leaf are scored exactly in 64-bit integers.
* The tasks' best are merged in two steps (salted, then per item), so no task holds all of an item's.

Items are a stated query set. They go to the executors in blocks of about ``BLOCK_TERMS`` (item, term) pairs,
chosen by a hash of the id; each block is one pass over the documents.

Defined results: null texts and texts without a term score nothing and don't count in N; an item without a term
has no rows; benchmark rows that repeat an item_id are one item with the terms of all of them; each
document row is a document of its own, also where ids repeat; among equal scores a null doc_id comes last; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from .common import map_rows, on_executors, stored

TOP = 10
CHUNK = 4096  # documents of a tree
LEAF = 64
BLOCK_TERMS = 100_000
SLACK = 1e-9  # relative; far above the rounding error of sums of a million doubles
SALT = 64

#: bytes of UTF-8 that belong to terms stay (A-Z lower-cased), all others become spaces
_KEPT = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    """Maximal runs of letters a-z, digits and characters from U+0080 up, A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_KEPT).split() if text else []


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: doc_id, n (its terms), and the numbers and counts of its query terms."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(texts):
        number = shared.value
        known = number.keys()
        at, n, ids, tfs = [], [], [], []
        for i, text in enumerate(texts):
            words = terms_of(text)
            if words:
                tally: dict[int, int] = {}
                for w in filter(known.__contains__, words):
                    tally[number[w]] = tally.get(number[w], 0) + 1
                at.append(i)
                n.append(len(words))
                ids.append(list(tally))
                tfs.append(list(tally.values()))
        return [at, n, ids, tfs]

    fields = StructType().add("n", "long").add("terms", ArrayType(IntegerType())).add("tfs", ArrayType(IntegerType()))
    return map_rows(docs.select("doc_id", "text"), ["doc_id"], ["text"], fields, count)


def weights(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.floor(1000 * np.log((2.0 * n_docs + 2) / (2.0 * df + 1))).astype(np.int64)


def impacts(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Integer impacts of counts ``tf`` in documents of ``n`` terms each."""
    if 90 * int(n.max(initial=0)) * n_docs < 1 << 63:
        m = 10 + (90 * n * n_docs) // n_terms
    else:
        m = np.array([10 + (90 * int(x) * n_docs) // n_terms for x in n], dtype=np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class BallTree:
    """Balls over the rows of a sparse non-negative integer matrix; every row has an entry."""

    def __init__(self, cols: np.ndarray, values: np.ndarray, lengths: np.ndarray):
        self.terms, cols = np.unique(cols, return_inverse=True)  # only the coordinates that occur
        self.cols, self.values, self.lengths = cols.astype(np.int64), values.astype(np.int64), lengths.astype(np.int64)
        self.order = np.arange(len(lengths))
        self.nodes: list[tuple[int, int, int]] = []  # first row, end, left child (the right one follows; -1: leaf)
        centroids, radii = [], []
        todo = [(0, len(lengths))]
        self.start = np.concatenate([[0], np.cumsum(self.lengths)])
        k = 0
        while k < len(todo):
            lo, hi = todo[k]
            c, d2, r = self._ball(lo, hi)
            centroids.append(c)
            radii.append(r)
            if hi - lo <= LEAF:
                self.nodes.append((lo, hi, -1))
            else:
                self._split(lo, hi, d2)
                middle = (lo + hi) // 2
                self.nodes.append((lo, hi, len(todo)))
                todo += [(lo, middle), (middle, hi)]
            k += 1
        self.centroids, self.radii = np.array(centroids), np.array(radii)

    def _rows(self, lo: int, hi: int):
        a, b = self.start[lo], self.start[hi]
        return self.cols[a:b], self.values[a:b], self.start[lo:hi] - a

    def _ball(self, lo: int, hi: int):
        cols, values, first = self._rows(lo, hi)
        c = np.bincount(cols, weights=values, minlength=len(self.terms)) / (hi - lo)
        norms = np.add.reduceat(values.astype(np.float64) ** 2, first)
        c2 = float(c @ c)
        d2 = norms - 2 * np.add.reduceat(values * c[cols], first) + c2
        return c, d2, float(np.sqrt(max(d2.max(), 0.0) + SLACK * (norms.max() + c2)))

    def _split(self, lo: int, hi: int, d2: np.ndarray) -> None:
        """Halve the rows by which of two far ones they are nearer to."""
        cols, values, first = self._rows(lo, hi)

        def dots(row: int) -> np.ndarray:
            x = np.zeros(len(self.terms))
            a, b = self.start[lo + row], self.start[lo + row + 1]
            x[self.cols[a:b]] = self.values[a:b]
            return np.add.reduceat(values * x[cols], first)

        norms = np.add.reduceat(values.astype(np.float64) ** 2, first)
        one = int(np.argmax(d2))
        to_one = dots(one)
        two = int(np.argmax(norms - 2 * to_one))
        side = np.argsort((dots(two) - to_one), kind="stable")
        old = self.lengths[lo:hi]
        picked = np.concatenate([np.arange(f, f + n) for f, n in zip(first[side], old[side], strict=True)])
        a, b = self.start[lo], self.start[hi]
        self.cols[a:b], self.values[a:b] = cols[picked], values[picked]
        self.lengths[lo:hi] = old[side]
        self.start[lo:hi + 1] = a + np.concatenate([[0], np.cumsum(self.lengths[lo:hi])])
        self.order[lo:hi] = self.order[lo:hi][side]

    def search(self, terms: np.ndarray, weight: np.ndarray, best: Best) -> int:
        """Enter into ``best`` every row that can stand in it; the number of rows scored."""
        at = np.searchsorted(self.terms, terms)
        known = self.terms[np.minimum(at, len(self.terms) - 1)] == terms
        at, w = at[known], weight[known]
        if not len(at):
            return 0
        q = np.zeros(len(self.terms), dtype=np.int64)
        q[at] = w
        c, wf = self.centroids[:, at], w.astype(np.float64)
        bounds = (c @ wf + np.sqrt((c > 0) @ wf ** 2) * self.radii) * (1 + SLACK) + 1
        heap, scored = [(-bounds[0], 0)], 0
        while heap:
            bound, k = heapq.heappop(heap)
            if -bound < best.least:
                break
            lo, hi, child = self.nodes[k]
            if child >= 0:
                for x in (child, child + 1):
                    b = min(-bound, bounds[x])
                    if b >= best.least:
                        heapq.heappush(heap, (-b, x))
            else:
                cols, values, first = self._rows(lo, hi)
                scores = np.add.reduceat(q[cols] * values, first)
                scored += hi - lo
                for i in np.flatnonzero(scores >= best.least):
                    best.enter(int(scores[i]), self.order[lo + i])
        return scored


class Best:
    """The ``k`` best of an item in a task; ``least``: the least score that can still enter."""

    def __init__(self, k: int):
        self.k, self.rows, self.least, self.names = k, [], 1, None

    def enter(self, score: int, row: int) -> None:
        if score < self.least:
            return
        name = self.names[row]
        # a heap with the worst on top: lower score, then a missing id, then the larger id
        entry = (score, name is not None, -name if name is not None else 0)
        (heapq.heappush if len(self.rows) < self.k else heapq.heappushpop)(self.rows, entry)
        if len(self.rows) == self.k:
            self.least = max(1, self.rows[0][0])


def _search_task(batches, queries, weight, n_docs, n_terms, k):
    best = [Best(k) for _ in queries]
    held: list[pa.RecordBatch] = []

    def look() -> None:
        t = pa.Table.from_batches(held)
        held.clear()
        names, n = t.column("doc_id").to_pylist(), t.column("n").to_numpy()
        terms, tfs = t.column("terms").combine_chunks(), t.column("tfs").combine_chunks()
        lengths = terms.value_lengths().to_numpy()
        if not len(lengths):
            return
        tf = tfs.flatten().to_numpy().astype(np.int64)
        tree = BallTree(terms.flatten().to_numpy(), impacts(tf, np.repeat(n, lengths), n_docs, n_terms), lengths)
        for b, q in zip(best, queries, strict=True):
            b.names = names
            tree.search(q, weight[q], b)

    for batch in batches:
        while batch.num_rows:
            room = CHUNK - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == CHUNK:
                look()
    if held:
        look()
    rows = [(i, -d if known else None, s) for i, b in enumerate(best) for s, known, d in b.rows]
    item, doc, score = zip(*rows, strict=True) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(doc, pa.int64()), pa.array(score, pa.int64())], names=["item", "doc_id", "score"])


def _blocks(items: DataFrame):
    """The distinct (item, term) pairs, in blocks of whole items."""
    n_items, n = items.agg(F.countDistinct("item_id"), F.count("*")).first()
    blocks = min(-(-n // BLOCK_TERMS), max(1, n_items))
    for b in range(blocks):
        found: dict = {}
        for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "term").toLocalIterator():
            found.setdefault(r.item_id, []).append(bytes(r.term))
        if found:
            yield found


def search(docs: DataFrame, benchmark: DataFrame, k: int = TOP) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents that score highest for each item."""
    spark = docs.sparkSession
    on_executors(spark)

    def split(texts):
        rows = [(i, t) for i, text in enumerate(texts) for t in set(terms_of(text))]
        return [list(c) for c in zip(*rows, strict=True)] if rows else [[], []]

    items = stored(map_rows(benchmark.select("item_id", "text"), ["item_id"], ["text"], StructType().add("term", "binary"), split).distinct(), "items")
    out = None
    for found in _blocks(items):
        vocabulary = {t: i for i, t in enumerate(sorted({t for ts in found.values() for t in ts}))}
        queries = [np.array([vocabulary[t] for t in ts], dtype=np.int64) for ts in found.values()]
        table = stored(vectors(docs, vocabulary), "vectors")
        n_docs, n_terms = table.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            break
        df = np.zeros(len(vocabulary), dtype=np.int64)
        for r in table.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a number per query term
            df[r.t] = r["count"]
        shared = spark.sparkContext.broadcast((queries, weights(n_docs, df)))

        def best(batches, shared=shared, n_docs=n_docs, n_terms=n_terms):
            queries, weight = shared.value
            yield from _search_task(batches, queries, weight, n_docs, n_terms, k)

        got = table.where(F.size("terms") > 0).mapInArrow(best, "item long, doc_id long, score long")
        names = spark.createDataFrame(list(enumerate(found)), StructType().add("item", "long").add("item_id", benchmark.schema["item_id"].dataType))
        order = [F.desc("score"), F.asc_nulls_last("doc_id")]
        # (the salted step before the last keeps an item's candidates out of one task)
        for keys in (["item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALT))], ["item"]):
            got = got.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= k)
        part = got.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        out = part if out is None else out.unionAll(part)
    if out is None:
        return benchmark.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out
