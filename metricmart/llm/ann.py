"""Approximate nearest neighbours by a permutation index, for the largest inner product.

A vector is represented by its ``NEAREST`` nearest pivots, in order. Vectors lie in blocks; each
block holds an inverted file per pivot, of the vectors that have it among their nearest and at which
place. A query walks the files of its own nearest pivots. With places counted from 0 and a missing
pivot put at place ``NEAREST``, the footrule distance of two orders is a constant less twice the sum,
over the pivots they share, of NEAREST - max(place, place); so walking the files adds up that sum.
The share of the block that is nearest by footrule (``LEAST`` at least) is reranked by the exact
inner product of the original vectors in double precision, and the blocks' best are merged. Those that
can't be among the best, whatever the error of single precision, are left out of it by a product in that.

There are ``PER_ROOT`` pivots per square root of the number of vectors (``PIVOTS`` at least), so a
query walks a part of the files that shrinks as the table grows. The share is measured: of ``SAMPLE``
queries the true neighbours are found by brute force, and the share is such that it holds ``AIM`` of them.

Inner products are turned into distances by one added component, sqrt(M^2 - |v|^2) with the largest
norm M (0 for queries), so that longer vectors count as nearer, as they should.

Pivots are a sample of the distinct vectors (those of smallest hash; they and the ``SAMPLE`` queries,
of smallest hash too, are all vectors that come to the driver); every vector is indexed. Equal vectors are indexed once and stand for the
smallest of their ids (as many as an answer can hold), so a vector with very many copies costs
no more than another, and no answer is lost.

Defined results: null, empty and zero vectors, vectors with null or non-finite components, and rows
without an id take no part; shorter vectors are filled up with zeros; equal rows count once; ties go
to the smaller id; an id with several vectors asks once for each and never finds itself; empty
tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import on_executors, stored

PIVOTS = 128
PER_ROOT = 4.5
MOST_PIVOTS = 1 << 15  # and at most PIVOT_NUMBERS components in all of them
PIVOT_NUMBERS = 1 << 21
NEAREST = 64
SAMPLE = 128
AIM = 0.999
LEAST = 256
BLOCK = 8192  # distinct vectors in a block, about; in tables of more than FEW_BLOCKS such blocks up to
MOST_BLOCK = 1 << 16  # or BLOCK_NUMBERS components, so that there are fewer pairs of blocks to shuffle
BLOCK_NUMBERS = 1 << 22
FEW_BLOCKS = 16
ROWS = 1024  # vectors whose distances from all pivots are held at a time
FOUND = "asks long, at long, first long, score double"


def pivot_count(n: int, width: int) -> int:
    """How many pivots ``n`` vectors get."""
    return max(PIVOTS, min(math.ceil(PER_ROOT * math.sqrt(n)), MOST_PIVOTS, PIVOT_NUMBERS // width))


def block_size(n: int, width: int) -> int:
    """How many of ``n`` vectors lie in a block, about."""
    return max(BLOCK, min(-(-n // FEW_BLOCKS), MOST_BLOCK, BLOCK_NUMBERS // width))


def nearest_pivots(vectors: np.ndarray, norm: float, pivots: np.ndarray, query: bool) -> np.ndarray:
    """Each row's nearest pivots in order, with the component that turns products into distances."""
    most = min(NEAREST, len(pivots))
    pivot_extra = np.sqrt(np.maximum(norm ** 2 - (pivots ** 2).sum(axis=1), 0))
    out = np.empty((len(vectors), most), dtype=np.uint16)
    for at in range(0, len(vectors), ROWS):
        part = vectors[at:at + ROWS]
        away = -(part @ pivots.T)
        if not query:
            away -= np.outer(np.sqrt(np.maximum(norm ** 2 - (part ** 2).sum(axis=1), 0)), pivot_extra)
        near = np.sort(np.argpartition(away, most - 1, axis=1)[:, :most], axis=1)
        order = np.argsort(np.take_along_axis(away, near, axis=1), axis=1, kind="stable")
        out[at:at + ROWS] = np.take_along_axis(near, order, axis=1)
    return out


class Block:
    """Pivot inverted files over some vectors."""

    def __init__(self, vectors: np.ndarray, norm: float, pivots: np.ndarray):
        self.vectors, self.norm, self.pivots = vectors, norm, pivots
        order = nearest_pivots(vectors, norm, pivots, query=False)
        self.places = order.shape[1]
        entry = np.argsort(order, axis=None, kind="stable")
        self.row, self.left = entry // self.places, (self.places - entry % self.places).astype(float)
        self.rough = (vectors / norm).astype(np.float32)
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(order.ravel(), minlength=len(pivots)))]).tolist()

    def shared(self, order: np.ndarray) -> np.ndarray:
        """The sum that footrule distances fall with, of each vector and a query's nearest pivots."""
        files = [slice(self.ends[p], self.ends[p + 1]) for p in order.tolist()]
        row = np.concatenate([self.row[f] for f in files])
        left = np.concatenate([self.left[f] for f in files])
        own = np.repeat(np.arange(self.places, 0, -1.0), [f.stop - f.start for f in files])
        return np.bincount(row, np.minimum(left, own, out=left), len(self.vectors)).astype(np.int64)

    def nearest(self, order: np.ndarray, wanted: int) -> np.ndarray:
        """Rows of the ``wanted`` vectors nearest by footrule; of equally near ones the first."""
        if wanted >= len(self.vectors):
            return np.arange(len(self.vectors))
        shared = self.shared(order)
        reached = np.cumsum(np.bincount(shared)[::-1])
        last = len(reached) - 1 - np.searchsorted(reached, wanted)
        nearer = np.flatnonzero(shared > last)
        return np.concatenate([nearer, np.flatnonzero(shared == last)[:wanted - len(nearer)]])

    def search(self, queries: np.ndarray, most: int, first: np.ndarray, share: float):
        """For each query: rows of its best vectors and their scores, best first."""
        wanted = max(LEAST, most, int(np.ceil(share * len(self.vectors))))
        for q, order in zip(queries, nearest_pivots(queries, self.norm, self.pivots, query=True), strict=True):
            near = self.likely(self.nearest(order, wanted), q, most)
            yield self.best(near, self.vectors[near] @ q, most, first)

    def likely(self, near: np.ndarray, q: np.ndarray, most: int) -> np.ndarray:
        """Those that may be among the ``most`` of largest product: all but what single precision, with
        twice its largest error (of a product of two vectors no longer than 1), puts below so many."""
        if most >= len(near):
            return near
        rough = self.rough.take(near, axis=0) @ (q / np.linalg.norm(q)).astype(np.float32)
        error = (len(q) + 8) * float(np.finfo(np.float32).eps)
        return near[~(rough < np.partition(rough, len(near) - most)[len(near) - most] - 2 * error)]

    def best(self, near: np.ndarray, score: np.ndarray, most: int, first: np.ndarray):
        """The ``most`` of largest score, ties to the smaller ``first``."""
        if most < len(near):
            kept = np.flatnonzero(score >= np.partition(score, len(near) - most)[len(near) - most])
            near, score = near[kept], score[kept]
        at = np.lexsort((first[near], -score))[:most]
        return near[at], score[at]

    def needed(self, queries: np.ndarray, most: int, first: np.ndarray):
        """For each query: rows of its best of all vectors, their scores, and the share that would hold each."""
        for q, order in zip(queries, nearest_pivots(queries, self.norm, self.pivots, query=True), strict=True):
            near, score = self.best(np.arange(len(self.vectors)), self.vectors @ q, most, first)
            shared = self.shared(order)
            yield near, score, np.array([np.count_nonzero(shared >= x) for x in shared[near]]) / len(shared)


def _matrix(values, size: int) -> np.ndarray:
    out = np.zeros((len(values), size))
    for i, v in enumerate(values):
        out[i, :len(v)] = v
    return out


def _frame(found: list[tuple], names: list[str]) -> pd.DataFrame:
    """Rows of a query's number and as long arrays, under each other."""
    if not found:
        return pd.DataFrame({x: np.zeros(0, dtype=float if x in ("score", "share") else np.int64) for x in names})
    asks, *arrays = zip(*found, strict=True)
    return pd.DataFrame(dict(zip(names, [np.repeat(asks, [len(x) for x in arrays[0]]), *map(np.concatenate, arrays)], strict=True)))


def search(vectors: DataFrame, is_query, k: int = 20) -> DataFrame:
    """The ``k`` nearest of every query row (where ``is_query`` holds) among all other rows."""
    spark = vectors.sparkSession
    on_executors(spark)
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("asking"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    rows = stored(rows.withColumn("key", F.md5(F.array_join(F.transform("v", lambda x: (x + 0.0).cast("string")), ",").cast("binary"))).distinct(), "vectors")
    by_id = Window.partitionBy("key").orderBy("vec_id")
    some = rows.dropDuplicates(["key", "vec_id"]).withColumn("n", F.row_number().over(by_id)).where(F.col("n") <= k + 1)
    members = some.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("v").alias("v"))
    index = stored(members.select(F.monotonically_increasing_id().alias("at"), "key", "ids", "v", F.get("ids", F.lit(0)).alias("first"), F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("norm"), F.size("v").alias("width")), "index")
    asks = rows.where("asking").select("key", F.col("vec_id").alias("query_id")).distinct().join(index.select("key", "at"), "key").select("query_id", "at")
    asking = index.join(asks.select("at").distinct(), "at", "left_semi")
    facts = index.agg(F.count("*").alias("n"), F.max("norm").alias("norm"), F.max("width").alias("width")).first()
    n_asks = asking.count()
    if not facts.n or not n_asks:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, width, norm = facts.n, facts.width, facts.norm
    pivots = spark.sparkContext.broadcast(_matrix([r.v for r in index.orderBy(F.xxhash64("key"), "key").select("v").limit(pivot_count(n, width)).collect()], width))
    size = block_size(n, width)
    blocks, query_blocks = -(-n // size), -(-n_asks // size)

    def block_of(n):
        return F.pmod(F.xxhash64("key"), F.lit(n)).cast("int")

    def block(rows: pd.DataFrame):
        rows = rows.sort_values(["first", "at"], ignore_index=True)
        return Block(_matrix(rows["v"], width), norm, pivots.value), rows["first"].to_numpy(), rows["at"].to_numpy()

    sample = asking.orderBy(F.xxhash64("key", F.lit(1)), "key").select("at", "v").limit(SAMPLE).collect()  # another hash: few of them are pivots
    tried = spark.sparkContext.broadcast((np.array([r["at"] for r in sample]), _matrix([r.v for r in sample], width)))

    def measure(rows: pd.DataFrame) -> pd.DataFrame:
        held, first, at = block(rows)
        asks, queries = tried.value
        return _frame([(ask, at[near], first[near], score, share) for ask, (near, score, share) in zip(asks, held.needed(queries, k + 1, first), strict=True)],
                      ["asks", "at", "first", "score", "share"])

    in_blocks = index.select(block_of(blocks).alias("block"), "at", "first", "v")
    best_first = Window.partitionBy("asks").orderBy(F.desc("score"), "first", "at")
    true = in_blocks.groupBy("block").applyInPandas(measure, FOUND + ", share double").where("asks <> at")
    share = true.withColumn("n", F.row_number().over(best_first)).where(F.col("n") <= k).agg(F.percentile("share", F.lit(AIM)).alias("share")).first().share
    share = 1.0 if share is None else share

    held = in_blocks.select("block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("asked"), "at", "first", "v")
    asked = asking.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("of"), block_of(query_blocks).alias("by"), F.col("at").alias("ask"), F.col("v").alias("q"))

    def probe(_, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return _frame([], ["asks", "at", "first", "score"])
        held, first, at = block(left)
        found = held.search(_matrix(right["q"], width), k + 1, first, share)
        return _frame([(ask, at[near], first[near], score) for ask, (near, score) in zip(right["ask"], found, strict=True)], ["asks", "at", "first", "score"])

    found = held.groupBy("block", "asked").cogroup(asked.groupBy("of", "by")).applyInPandas(probe, FOUND)
    best = found.withColumn("n", F.row_number().over(best_first)).where(F.col("n") <= k + 1)
    ids = best.join(index.select("at", "ids"), "at").select("asks", "score", F.explode("ids").alias("vec_id"))
    ids = ids.withColumn("n", F.row_number().over(Window.partitionBy("asks").orderBy(F.desc("score"), "vec_id"))).where(F.col("n") <= 2 * k + 1)
    lists = ids.groupBy("asks").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("away"), "vec_id"))).alias("near"))
    own = asks.join(lists, asks["at"] == lists.asks).select("query_id", F.slice(F.filter("near", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("near"))
    return own.select("query_id", F.posexplode("near").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.away")).alias("score"))


def neighbours(vectors: DataFrame) -> DataFrame:
    """Queries: ids divisible by 20; each one's 20 nearest rows."""
    return search(vectors, F.col("vec_id") % 20 == 0, 20)
