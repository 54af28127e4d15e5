"""S-7 / S-16: real-time 3-sigma latency alerts as a stateful stream.

Each model's daily mean latency is scored against that model's *earlier* days:
``z = (x − mean(prior)) / stddev_samp(prior)``, alert when ``|z| > 3`` (on the 4-decimal z, as in the batch metric).

Days may land in any order and any time late. A model's state (``applyInPandasWithState``) is the series of its days, a
row per day. When a day lands, or lands anew with another mean, it and all later days of the model are scored
anew, and the scores go out as updates; there is no watermark, so no day is dropped. The sink upserts them into a
table by model and day (``operators.bucketed``), where a corrected score replaces the earlier one. After any order of
drops the table holds what a batch over all days gives. A repeated micro-batch writes the same rows again.

The input is the daily model snapshot (one row per model and day), so a state
update handles a handful of rows however hot the model is.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import StructType

from ..functions.columns import round4
from ..operators.bucketed import BucketedTable
from ..plans.qos import SIGMA
from ..session import freeze

INPUT_SCHEMA = "model_id string, mean_latency_ms double, snapshot_date date"
OUTPUT_SCHEMA = "model_id string, snapshot_date date, mean_latency_ms double, prior_days long, z double"
STATE_SCHEMA = "days array<date>, means array<double>"
SCORES = (StructType().add("model_id", "string").add("snapshot_date", "date").add("mean_latency_ms", "double")
          .add("prior_days", "long").add("z", "double"))
DAY = ["model_id", "snapshot_date"]


def scores(days: dict, since) -> list[tuple]:
    """``(day, mean, prior days, z)`` of the days from ``since`` on, each against all before it."""
    out, n, mean, m2 = [], 0, 0.0, 0.0
    for d in sorted(days):
        x, z = days[d], None
        if n >= 2:
            sd = math.sqrt(m2 / (n - 1))
            z = (x - mean) / sd if sd > 0 else None
        if d >= since:
            out.append((d, x, n, z))
        n += 1
        delta = x - mean
        mean += delta / n
        m2 += delta * (x - mean)
    return out


def _score(key, frames, state):
    """Per model: take up the days that landed; score the first that is new or changed, and all after it."""
    days = dict(zip(*state.get, strict=True)) if state.exists else {}
    changed = set()
    for pdf in frames:
        for d, x in zip(pdf["snapshot_date"], pdf["mean_latency_ms"], strict=True):
            d = pd.Timestamp(d).date()
            if pd.notna(x) and days.get(d) != float(x):
                days[d] = float(x)
                changed.add(d)
    state.update((list(days), list(days.values())))
    rows = [(key[0], *r) for r in scores(days, min(changed))] if changed else []
    yield pd.DataFrame(rows, columns=["model_id", "snapshot_date", "mean_latency_ms", "prior_days", "z"])


def _upsert(table: BucketedTable):
    """foreachBatch sink: scores replace those of the same model and day."""

    def write(batch: DataFrame, batch_id: int) -> None:
        new = freeze(batch)
        table.upsert(new, lambda old, new: old.join(new.select(*DAY), DAY, "left_anti").unionByName(new))

    return write


def stream_latency_alerts(spark: SparkSession, daily_path: str, out_path: str, checkpoint: str,
                          max_files_per_trigger: int | None = None, buckets: int = 16) -> DataFrame:
    """Run the alert stream over daily model means stored at ``daily_path`` until caught up; return all scored days."""
    reader = spark.readStream.schema(INPUT_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    table = BucketedTable(spark, out_path, SCORES, "model_id", buckets)
    scored = (reader.parquet(daily_path).groupBy("model_id")
                    .applyInPandasWithState(_score, OUTPUT_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.NoTimeout))
    q = (scored.writeStream.outputMode("update").foreachBatch(_upsert(table)).option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()
    return table.read().select("model_id", "snapshot_date", "mean_latency_ms", "prior_days",
                               round4(F.col("z")).alias("z_score")).withColumn(
        "is_alert", F.coalesce(F.abs(F.col("z_score")) > F.lit(SIGMA), F.lit(False)))
