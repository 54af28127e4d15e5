"""Sharding by sampled splitters: near-equal bytes per shard.

Records are ordered by a range key: the high bits come from a hash of the text (so equal texts lie
side by side), the low bits from a hash of the id (so that even one text's copies can be cut
anywhere). A size-weighted sample of keys gives quantile boundaries of fine ranges; a range that
still holds more than ``OVERFULL`` times its share is subdivided by a sample of its own. Inside a
range, running sums give each record's place in the byte order of the whole table, and equal steps of
that order are the shards. Shard sizes thus differ by one record's size at most around the mean.

The fine ranges grow in number with the table (``RANGE_BYTES`` each at most), so no task holds a
whole shard or one text's copies; the driver sees one row per range.

Defined results: a null text has no bytes (crc32 of nothing is 0) and size 16; empty tables give an
empty result; rows that repeat are each placed, ties in no order that can be told apart;
null ids are ordered first; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

RANGES_PER_SHARD = 8
RANGE_BYTES = 64 << 20
SAMPLES_PER_RANGE = 24
OVERFULL = 2.0
FIXED_BYTES = 16  # added to the text's bytes in a record's size


def _key():
    """30 bits of the text's hash, then 22 of the id's: below 2^52, exact as a double."""
    high = F.pmod(F.xxhash64("text"), F.lit(1 << 30))
    low = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 22))
    return (high * (1 << 22) + low).cast("double")


def _sample(slim: DataFrame, total: int, wanted: int) -> list[float]:
    """Keys drawn with a chance in proportion to size; about ``wanted`` of them, whole large records always."""
    u = (F.pmod(F.xxhash64("key", F.lit(11)), F.lit(1 << 30)) + 0.5) / (1 << 30)
    drawn = slim.where(u < F.col("size") * F.lit(wanted / total)).select("key")
    return sorted(r.key for r in drawn.collect())


def _cuts(keys: list[float], n: int) -> list[float]:
    return sorted({keys[len(keys) * i // n] for i in range(1, n)}) if len(keys) >= n > 1 else sorted(set(keys))


def _ranged(slim: DataFrame, cuts: list[float]) -> DataFrame:
    cuts = [c for c in cuts if c > 0]
    if not cuts:
        return slim.withColumn("range", F.lit(0.0))
    return Bucketizer(splits=[-math.inf, *cuts, math.inf], inputCol="key", outputCol="range").transform(slim)


def shard(docs: DataFrame, shards: int = 40) -> DataFrame:
    """One row per document: its shard, its slot there, its size and its text's crc32."""
    slim = stored(docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + FIXED_BYTES).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"), _key().alias("key")), "shard")
    total = slim.agg(F.sum("size")).first()[0] or 0
    n = max(shards * RANGES_PER_SHARD, math.ceil(total / RANGE_BYTES))
    cuts = _cuts(_sample(slim, max(total, 1), n * SAMPLES_PER_RANGE), n)
    measured = _ranged(slim, cuts).groupBy("range").agg(F.sum("size").alias("bytes")).collect()
    full = {int(r.range): r.bytes for r in measured if r.bytes > OVERFULL * total / n}
    if full:  # subdivide: a sample drawn from the overfull ranges alone
        inside = _ranged(slim, cuts).where(F.col("range").isin([float(r) for r in full]))
        parts = math.ceil(sum(full.values()) * n / total) * 2
        more = _sample(inside, sum(full.values()), parts * SAMPLES_PER_RANGE)
        cuts = sorted({*cuts, *_cuts(more, parts)})
    placed = _ranged(slim, cuts)
    sums = sorted((r.range, r.bytes, r.rows) for r in placed.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect())
    starts, at_bytes, at_rows = [], 0, 0
    for r, b, k in sums:
        starts.append((r, at_bytes, at_rows))
        at_bytes, at_rows = at_bytes + b, at_rows + k
    spark = docs.sparkSession
    offsets = spark.createDataFrame(starts or [(-1.0, 0, 0)], "range double, bytes_before long, rows_before long")
    w = Window.partitionBy("range").orderBy("key", "doc_id", "text_crc32", "size")
    running = w.rowsBetween(Window.unboundedPreceding, 0)
    middle = F.col("bytes_before") + F.sum("size").over(running) - F.col("size") / 2
    numbered = stored(placed.join(F.broadcast(offsets), "range").select(
        "doc_id", "size", "text_crc32",
        F.least(F.lit(shards - 1), F.floor(middle * shards / max(total, 1))).cast("int").alias("shard"),
        (F.col("rows_before") + F.row_number().over(w) - 1).alias("place")), "placed")
    first = numbered.groupBy("shard").agg(F.min("place").alias("first"))
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
