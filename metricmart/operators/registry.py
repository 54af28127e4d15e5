"""K-1 under S-16: durable surrogate keys.

``keys.with_surrogate_key`` numbers rows by their order, so one row more in the middle renumbers all that
follow. Facts and metrics that were stored with the old numbers would then point elsewhere. ``KeyRegistry`` keeps a
natural key's number for good: known keys get theirs back, and the unseen ones, in a declared order, the next numbers after
the highest. The first load of a table gets the same numbers as ``with_surrogate_key`` gives.

New keys go into a folder of their own; the commit log names the folders and the highest number. They are
published before the table that uses them: a load that dies in between leaves numbers that nothing uses yet,
and the next load gets the same ones.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import no_rows
from .commits import CommitLog
from .keys import with_surrogate_key


class KeyRegistry:
    """``natural`` (unique, nulls equal) to ``name``, kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str, natural: list[str], name: str):
        self.spark, self.natural, self.name = spark, natural, name
        self.log = CommitLog(spark, root)

    def known(self, like: DataFrame) -> DataFrame:
        """All numbers given so far; ``like`` has the natural columns' types."""
        schema = StructType([like.schema[c] for c in self.natural]).add(self.name, "long")
        folders = self.log.newest({"folders": []})[1]["folders"]
        if not folders:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.log.root}/{f}" for f in folders])

    def _same(self, a: DataFrame, b: DataFrame) -> Column:
        return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in self.natural])

    def assign(self, rows: DataFrame, order: list) -> DataFrame:
        """``rows`` with their numbers; unseen natural keys get the next ones in ``order`` and are published.

        ``rows`` is read twice: pass a stored table. Unseen rows carry their number from where they were numbered; only
        those known before are joined with the numbers stored.
        """
        base, state = self.log.newest({"folders": [], "top": 0})
        known = self.known(rows)
        # numbered rows are frozen in their order, so they have the same numbers whenever they are read
        unseen = with_surrogate_key(rows.join(known, self._same(rows, known), "left_anti"), order, "_n")
        unseen = unseen.select(*rows.columns, (F.col("_n") + state["top"]).alias(self.name))
        old = rows.join(known, self._same(rows, known)).select(*[rows[c] for c in rows.columns], known[self.name])
        folder, seen = self.log.folder(base, "keys"), Observation()
        (unseen.select(*self.natural, self.name)
               .observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.log.root}/{folder}"))
        if n := seen.get["n"]:
            self.log.commit(base, {"folders": [*state["folders"], folder], "top": state["top"] + n})
            return old.unionByName(unseen) if state["folders"] else unseen
        self.log.files.delete(f"{self.log.root}/{folder}")
        return old

    def compact(self) -> None:
        """One folder instead of one per load."""
        base, state = self.log.newest({"folders": [], "top": 0})
        if len(state["folders"]) > 1:
            folder = self.log.folder(base, "keys")
            self.spark.read.parquet(*[f"{self.log.root}/{f}" for f in state["folders"]]).write.parquet(f"{self.log.root}/{folder}")
            self.log.commit(base, {"folders": [folder], "top": state["top"]})
