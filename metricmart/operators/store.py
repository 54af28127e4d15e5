"""SNK-3..SNK-6: the idempotent metric store (delete-before-insert as one atomic replace).

``replace_rows`` is the relational core: keep the existing rows outside the
run's scope, add the new rows. Unlike a dynamic partition overwrite, a period
that the new run has no rows for is deleted too (the reference deletes it).

``MetricStore`` persists that on plain parquet without an ACID table format, copy-on-write by period. Rows lie in
folders per run, metric code and period (a month of days, a year of weeks or months). A version's manifest
has an entry per code and period: the run that holds it, its rows, its first and last ``time_id``. A
replace writes only the periods it touches and is published by its manifest alone (``commits.CommitLog``): a failed run
leaves nothing that a later one could meet, and of two writers of one version the second fails without harm. Reads
with a time range open only the periods that the manifest has in it. Kept rows keep the time they were written.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from .commits import CommitLog, Files

ENTITY = ["entity_type", "entity_id"]


def in_scope(rows: DataFrame, scope: Column, entities: DataFrame | None = None) -> DataFrame:
    """``rows`` with ``_hit``: whether a row is in ``scope`` and, if ``entities`` (``entity_type, entity_id``)
    are given, belongs to one of them. The entities are a relation of any size, joined by their key."""
    hit = F.coalesce(scope, F.lit(False))
    if entities is None:
        return rows.withColumn("_hit", hit)
    named = entities.select(*ENTITY).distinct().withColumn("_named", F.lit(True))
    return rows.join(named, ENTITY, "left").withColumn("_hit", hit & F.coalesce("_named", F.lit(False))).drop("_named")


def replace_rows(existing: DataFrame, new: DataFrame, scope: Column, entities: DataFrame | None = None) -> DataFrame:
    """SNK-6: ``existing`` minus the rows in ``scope`` (SNK-5), plus ``new`` (SNK-3)."""
    kept = in_scope(existing, scope, entities).filter(~F.col("_hit")).select(*existing.columns)
    return kept.unionByName(new.select(*existing.columns))


def period() -> Column:
    """The period that a row is stored under: days by month, weeks and months by year, years together."""
    kind, time = F.col("time_type"), F.col("time_id")
    return F.concat_ws("-", kind, F.when(kind == "day", F.substring(time, 1, 7)).when(kind == "year", None).otherwise(F.substring(time, 1, 4)))


def _entry() -> Column:
    """Code and period as one value (both are folders, so filters on it prune them)."""
    return F.concat_ws("|", "metric_code", "period")


class MetricStore:
    """Versioned metric tables under ``root``: ``root/<table>/<run>/metric_code=…/period=…`` and a commit log each."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark, self.root)
        self._staged: list[str] = []

    def log(self, table: str) -> CommitLog:
        return CommitLog(self.spark, f"{self.root}/{table}")

    def _rows(self, table: str, entries: dict[str, dict]) -> DataFrame:
        """The rows of manifest entries, with their ``period``; one read per run that still holds some."""
        schema = schemas.STORED_METRICS[table]
        held = type(schema)([*(f for f in schema.fields if f.name != "metric_code"), schema["metric_code"]]).add("period", "string")
        out = None
        for run in sorted({e["run"] for e in entries.values()}):
            part = (self.spark.read.schema(held).parquet(f"{self.root}/{table}/{run}")
                        .filter(_entry().isin(sorted(k for k, e in entries.items() if e["run"] == run))))
            out = part if out is None else out.unionByName(part)
        out = out if out is not None else self.spark.createDataFrame([], held)
        return out.select(*schema.fieldNames(), "period")

    def read(self, table: str, codes: list[str] | None = None, first: str | None = None, last: str | None = None) -> DataFrame:
        """The newest published version (an empty frame before the first). With metric codes or a range
        of ``time_id``, only the entries that the manifest has in it are opened."""
        entries = self.log(table).newest({})[1]
        if codes is not None:
            entries = {k: e for k, e in entries.items() if e["code"] in codes}
        entries = {k: e for k, e in entries.items() if (first is None or e["last"] >= first) and (last is None or e["first"] <= last)}
        rows = self._rows(table, entries).drop("period")
        if first is not None:
            rows = rows.filter(F.col("time_id") >= first)
        return rows.filter(F.col("time_id") <= last) if last is not None else rows

    def stage(self, df: DataFrame) -> DataFrame:
        """Compute a result now, into a folder of its own, and read it back (until ``release``)."""
        path = f"{self.root}/_staging/{uuid.uuid4().hex}"
        df.write.parquet(path)
        self._staged.append(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        """Delete what this store staged."""
        while self._staged:
            self.files.delete(self._staged.pop())

    def append(self, table: str, new: DataFrame) -> int:
        """SNK-4: add rows and delete none."""
        return self.replace(table, new, F.lit(False))

    def replace(self, table: str, new: DataFrame, scope: Column, entities: DataFrame | None = None, staged: bool = False) -> int:
        """Publish ``replace_rows(current, new, scope, entities)`` as the next version and return its number.

        Only the codes and periods that ``new`` or the scope touch are written; the others stay where they are.
        ``staged``: ``new`` reads what ``stage`` has written.
        """
        problems = schemas.check_schema(new, schemas.WAREHOUSE[table])
        if problems:
            raise ValueError(f"{table}: result does not fit the sink: {problems}")
        log = self.log(table)
        base, before = log.newest({})
        new = new if staged else self.stage(new)
        added = new.withColumn("created_at", F.current_timestamp()).withColumn("period", period())
        current = in_scope(self._rows(table, before), scope, entities)
        # one job for the entries touched; their number is that of codes and periods
        touched = {r[0] for r in added.select(_entry()).unionAll(current.filter("_hit").select(_entry())).distinct().collect()}
        run = log.folder(base)
        kept = current.filter(_entry().isin(sorted(touched)) & ~F.col("_hit")).drop("_hit")
        path = f"{self.root}/{table}/{run}"
        kept.unionByName(added).hint("rebalance", "metric_code", "period").write.partitionBy("metric_code", "period").parquet(path)
        after = {k: e for k, e in before.items() if k not in touched}
        if touched:
            written = self._rows(table, {k: {"run": run} for k in touched})
            for r in written.groupBy(_entry().alias("k"), "metric_code").agg(F.count(F.lit(1)).alias("n"), F.min("time_id").alias("a"), F.max("time_id").alias("b")).collect():
                after[r.k] = {"code": r.metric_code, "run": run, "rows": r.n, "first": r.a, "last": r.b}
        number = log.commit(base, after)
        if not staged:
            self.release()
        return number

    def retire(self, table: str, keep: int = 2, staging_hours: float = 48) -> None:
        """Delete all but the newest ``keep`` versions, the runs that none of them names and no writer at
        work can still publish, and staged results that a dead run left ``staging_hours`` ago."""
        self.log(table).retire(keep, lambda entries: {e["run"] for e in entries.values()})
        for name in self.files.names(f"{self.root}/_staging"):
            path = f"{self.root}/_staging/{name}"
            if path not in self._staged and self.files.age_hours(path) > staging_hours:
                self.files.delete(path)
