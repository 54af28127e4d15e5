"""Tables that are kept up to date by key: rows in buckets by a hash, only touched buckets written.

A table lies in runs, each with folders per bucket; the commit log says which run holds each bucket, and keeps what else
the table's owner publishes with it. A change reads the buckets that its keys fall into, writes them anew into a
run of its own and commits. Other buckets stay where they are, and readers see the old table until then.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import no_rows
from .commits import CommitLog


class BucketedTable:
    """Rows of ``schema`` under ``root`` in buckets by ``by``; their number is fixed by the first change."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, by: str, buckets: int = 64):
        self.spark, self.schema, self.by, self.buckets = spark, schema, by, buckets
        self.log = CommitLog(spark, root)

    def state(self) -> tuple[int, dict]:
        return self.log.newest({"buckets": self.buckets, "runs": {}})

    def _bucket(self, state: dict) -> Column:
        return F.pmod(F.xxhash64(self.by), F.lit(state["buckets"])).cast("int")

    def hit(self, state: dict, keys: DataFrame) -> set[str]:
        """The buckets that these keys fall into (no more than there are buckets)."""
        return {str(r[0]) for r in keys.select(self._bucket(state)).distinct().collect()}

    def rows(self, state: dict, buckets: set[str] | None = None) -> DataFrame:
        """Stored rows, of some buckets or of all."""
        runs = {b: r for b, r in state["runs"].items() if buckets is None or b in buckets}
        held = StructType([*self.schema.fields]).add("bucket", "integer")
        parts = [self.spark.read.schema(held).parquet(f"{self.log.root}/{run}")
                     .filter(F.col("bucket").isin(sorted(int(b) for b, r in runs.items() if r == run))) for run in sorted(set(runs.values()))]
        return (reduce(DataFrame.unionByName, parts) if parts else no_rows(self.spark, held)).drop("bucket")

    def read(self) -> DataFrame:
        return self.rows(self.state()[1])

    def publish(self, base: int, state: dict, hit: set[str], rows: DataFrame, **more) -> int:
        """Replace the buckets ``hit`` by ``rows``; ``more`` is published with them."""
        run = self.log.folder(base)
        (rows.select(*self.schema.fieldNames()).withColumn("bucket", self._bucket(state)).hint("rebalance", "bucket")
             .write.partitionBy("bucket").parquet(f"{self.log.root}/{run}"))
        return self.log.commit(base, {**state, **more, "runs": {**state["runs"], **dict.fromkeys(hit, run)}})

    def upsert(self, new: DataFrame, merge: Callable[[DataFrame, DataFrame], DataFrame]) -> int:
        """Replace the buckets of ``new``'s keys by ``merge(their rows, new)``. ``new`` is read twice: pass a stored table."""
        base, state = self.state()
        hit = self.hit(state, new)
        return self.publish(base, state, hit, merge(self.rows(state, hit), new))

    def retire(self, keep: int = 2, also: Callable[[dict], set[str]] = lambda state: set()) -> None:
        """Delete all but the newest ``keep`` versions, and the folders that none of them names."""
        self.log.retire(keep, lambda state: {*state["runs"].values(), *also(state)})


def newest_per_key(old: DataFrame, new: DataFrame, key: list[str], changes: list[str], at: str) -> DataFrame:
    """Rows of both by ``key`` (unique in each, not null): a row that says the same as before (in ``changes``) stays with its
    time, a changed or added one comes in unless the stored one is newer by ``at``, all others stay."""
    cols = old.columns
    a = old.select(*key, F.struct(*cols).alias("_old"))
    b = new.select(*key, F.struct(*cols).alias("_new"))
    both = a.join(b, key, "full")
    same = reduce(lambda x, y: x & y, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in changes])
    stays = F.col("_new").isNull() | (F.col("_old").isNotNull() & (same | (F.col(f"_old.{at}") > F.col(f"_new.{at}"))))
    return both.select(F.when(stays, F.col("_old")).otherwise(F.col("_new")).alias("r")).select("r.*")
