"""S-16: the index of request ids seen so far, pruned by Bloom filters.

A batch asks which of its ids were stored before. The history is only looked at where it can hold one of them:

* Rows lie in *runs*. A batch adds one; ``FAN`` runs of like size are merged, so there are about as many as the
  logarithm of the history. The commit log names the runs, with the least and greatest id of each; runs
  outside the batch's range of ids aren't touched (ids from a sequence come roughly in order, so that is most).
* A run lies in folders by a hash of the id, *slices* of about ``slice_rows`` rows, with a Bloom filter of ``BITS`` bits per id
  in blocks of Spark's bitmap size; an id's bits lie in one block. The ids of the batch are joined with the blocks,
  which leaves the ids that are there, and one in a hundred of those that aren't.
* Only the slices with such an id are read, and only the rows of such ids pass on: a semi join, with
  the ids broadcast up to a checked size. So the history is neither scanned nor shuffled as a whole.

All of it is built-in functions; what comes to the driver are the numbers of the slices hit.
Rows keep the batch they came with. A batch that is loaded again doesn't meet its own rows, and replaces them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import broadcast_if_small, freeze, run_concurrently
from .commits import CommitLog

SLICE_ROWS = 1_000_000
BITS = 12  # of a filter, per id
PROBES = 3
BLOCK = 32_768  # bits of one of Spark's bitmaps
FAN = 4


def _slice(key: Column, slices) -> Column:
    return F.pmod(F.xxhash64(key), slices if isinstance(slices, Column) else F.lit(slices)).cast("int")


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.shiftright(F.xxhash64(key), 8), F.lit(blocks))


def _bit(key: Column, probe: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(BLOCK))


def _is_set(bits: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (bit % 8).cast("int")) == 1


def bloom(ids: DataFrame, key: str, blocks: int) -> DataFrame:
    """``block, bits`` of a Bloom filter. Ids are dealt out by block first, so no task holds bitmaps of blocks not its own."""
    k = F.col(key)
    dealt = ids.select(_block(k, blocks).alias("block"), *[_bit(k, i).alias(f"b{i}") for i in range(PROBES)]).repartition("block")
    return (dealt.select("block", F.explode(F.array(*[f"b{i}" for i in range(PROBES)])).alias("bit"))
                 .groupBy("block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def may_hold(ids: DataFrame, key: str, filters: DataFrame, blocks: int) -> DataFrame:
    """The ids that a filter doesn't rule out."""
    k = F.col(key)
    hit = reduce(lambda a, b: a & b, [_is_set(F.col("bits"), _bit(k, i)) for i in range(PROBES)])
    return ids.withColumn("block", _block(k, blocks)).join(filters, "block").filter(hit).drop("block", "bits")


class SeenIndex:
    """Rows by ``key``, in runs under ``root``; ``columns``: the schema of the rows, without the batch. A run's number of
    slices is fixed when it is written, by its rows."""

    def __init__(self, spark: SparkSession, root: str, columns: StructType, key: str = "request_id", slice_rows: int = SLICE_ROWS):
        self.spark, self.key, self.slice_rows = spark, key, slice_rows
        self.log = CommitLog(spark, root)
        self.schema = StructType([*columns.fields]).add("load_batch", "integer").add("id_slice", "integer")

    def runs(self) -> list[dict]:
        return self.log.newest([])[1]

    def _rows(self, run: dict) -> DataFrame:
        rows = self.spark.read.schema(self.schema).parquet(f"{self.log.root}/{run['folder']}/rows")
        return rows.filter(~F.col("load_batch").isin(run["skip"])) if run["skip"] else rows

    def candidates(self, ids: DataFrame, least, greatest) -> DataFrame | None:
        """``key, folder, id_slice``: ids that a run may hold; None if all runs lie outside the range of ids."""
        parts = []
        for run in self.runs():
            if run["first"] <= greatest and run["last"] >= least:
                inside = ids.filter(F.col(self.key).between(run["first"], run["last"]))
                filters = self.spark.read.schema("block long, bits binary").parquet(f"{self.log.root}/{run['folder']}/bloom")
                parts.append(may_hold(inside, self.key, filters, run["blocks"]).select(
                    self.key, F.lit(run["folder"]).alias("folder"), _slice(F.col(self.key), run["slices"]).alias("id_slice")))
        return reduce(DataFrame.unionByName, parts) if parts else None

    def stored(self, ids: DataFrame, least, greatest, batch: int) -> DataFrame | None:
        """The stored rows of these ids, but for the batch's own; None if there can be none.

        ``ids``: a cached or stored table of distinct ids between ``least`` and ``greatest``.
        """
        found = self.candidates(broadcast_if_small(ids.select(self.key)), least, greatest)
        if found is None:
            return None
        found = freeze(found)
        hit: dict[str, list[int]] = {}
        for r in found.select("folder", "id_slice").distinct().collect():
            hit.setdefault(r.folder, []).append(r.id_slice)
        parts = [self._rows(run).filter(F.col("id_slice").isin(sorted(hit[run["folder"]])) & (F.col("load_batch") != batch))
                 for run in self.runs() if run["folder"] in hit]
        if not parts:
            return None
        wanted = broadcast_if_small(found.select(self.key).distinct())
        return reduce(DataFrame.unionByName, parts).join(wanted, self.key, "left_semi").drop("id_slice")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Publish the batch's rows (in place of what an earlier attempt of the same batch published)."""
        base, runs = self.log.newest([])
        new = self._write(rows.withColumn("load_batch", F.lit(batch)), base, [batch])
        kept = [dict(r, skip=[*r["skip"], batch]) if batch in r["batches"] and batch not in r["skip"] else r
                for r in runs if r["batches"] != [batch]]
        base = self.log.commit(base, [*kept, *new])
        self._merge(base, [*kept, *new])

    def _write(self, rows: DataFrame, base: int, batches: list[int]) -> list[dict]:
        """``rows`` (cached or stored) as a run."""
        n, first, last = rows.agg(F.count(self.key), F.min(self.key), F.max(self.key)).first()  # (no id, nothing to find again)
        if not n:
            return []
        folder = self.log.folder(base)
        path = f"{self.log.root}/{folder}"
        slices, blocks = math.ceil(n / self.slice_rows), math.ceil(n * BITS / BLOCK)
        rows = rows.filter(F.col(self.key).isNotNull()).withColumn("id_slice", _slice(F.col(self.key), slices))
        run_concurrently([
            lambda: rows.hint("rebalance", "id_slice").write.partitionBy("id_slice").parquet(f"{path}/rows"),
            lambda: bloom(rows, self.key, blocks).write.parquet(f"{path}/bloom")])
        return [{"folder": folder, "batches": batches, "skip": [], "n": n, "first": first, "last": last, "slices": slices, "blocks": blocks}]

    def _merge(self, base: int, runs: list[dict]) -> None:
        """Make one run of ``FAN`` of like size (each row is rewritten once per size class)."""
        by_size: dict[int, list[dict]] = {}
        for r in runs:
            by_size.setdefault(int(math.log(r["n"], FAN)), []).append(r)
        for _, same in sorted(by_size.items()):
            if len(same) >= FAN:
                rows = reduce(DataFrame.unionByName, [self._rows(r) for r in same]).drop("id_slice")
                merged = self._write(rows, base, sorted({b for r in same for b in r["batches"]}))
                rest = [r for r in runs if r not in same] + merged
                return self._merge(self.log.commit(base, rest), rest)

    def retire(self, keep: int = 2) -> None:
        """Delete old versions and the runs that merges have replaced."""
        self.log.retire(keep, lambda runs: {r["folder"] for r in runs})
