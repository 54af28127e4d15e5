"""S-16: incremental aggregation of the request fact, in batch and as a stream.

(a) ``refresh_touched_days``: when a batch of requests lands, only the days it
    touches are re-aggregated from the fact and swapped into the snapshot
    (the touched-day list is one row per day, so it is broadcast).
(b) ``stream_daily_calls``: Structured Streaming over fact files as they land:
    ``foreachBatch`` counts each touched day anew from the stored fact and replaces
    it in a metric table with a folder per day (idempotent, and late rows count).
    ``availableNow`` processes everything present and stops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from .. import schemas
from ..functions.columns import day_id
from ..operators.seen import SeenIndex
from ..operators.snapshots import account_daily_snapshot
from ..session import freeze


def refresh_touched_days(snapshot: DataFrame, fact: DataFrame, landed: DataFrame) -> DataFrame:
    """The account snapshot after re-aggregating only the days present in ``landed``."""
    days = landed.select(F.to_date("request_time").alias("snapshot_date")).distinct()
    touched = F.broadcast(days)  # one row per touched day: bounded by the batch's date span
    fresh = account_daily_snapshot(
        fact.join(touched.withColumnRenamed("snapshot_date", "_d"),
                  F.to_date(fact["request_time"]) == F.col("_d"), "left_semi"))
    kept = snapshot.join(touched, "snapshot_date", "left_anti")
    return kept.unionByName(fresh)


#: the fact as it lies in its folder, partitioned by date
STORED_FACT = StructType([*schemas.FCT_API_REQUESTS.fields, StructField("request_date", DateType())])


def days_of(batch: DataFrame) -> list:
    """The dates that a batch touches: as many as its span of time has days."""
    return [r[0] for r in batch.select("request_date").distinct().collect()]


def _refresh_days(fact_path: str, out_root: str):
    """foreachBatch sink: re-aggregate from the stored fact the days that this micro-batch touches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fact = batch.sparkSession.read.schema(STORED_FACT).parquet(fact_path)
        # a filter on the partition column: only the folders of these days are listed and read
        days = (fact.filter(F.col("request_date").isin(days_of(batch)))
                    .groupBy(day_id(F.col("request_time")).alias("time_id"))
                    .agg(F.count(F.lit(1)).cast("double").alias("metric_value")))
        # one folder per day, replaced as a whole: a repeated batch writes the same rows again
        (days.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("time_id").parquet(out_root))

    return write


def stream_daily_calls(spark: SparkSession, fact_path: str, out_root: str, checkpoint: str) -> DataFrame:
    """Run the daily-calls stream over the fact files at ``fact_path`` (in folders by ``request_date``) until caught up.

    Returns the resulting ``dws_metric_value`` rows. A day is counted anew from the stored
    fact whenever a request of it lands, however late, so nothing is left out by a watermark.
    """
    q = (spark.readStream.schema(STORED_FACT).parquet(fact_path)
              .writeStream.foreachBatch(_refresh_days(fact_path, out_root))
              .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    written = spark.read.schema("metric_value double, time_id string").parquet(out_root)
    return written.select(F.lit("platform.daily.calls").alias("metric_code"), F.lit("platform").alias("entity_type"),
                          F.lit("all").alias("entity_id"), F.lit("day").alias("time_type"), "time_id",
                          "metric_value")


# ---- incremental fact load -------------------------------------------------------------------

def append_landed_logs(landed: DataFrame, batch_id: int, seen_path: str, fact_path: str, api_keys: DataFrame,
                       dim_account: DataFrame, dim_api_key: DataFrame, dim_model: DataFrame,
                       dim_status: DataFrame, key_map: DataFrame | None = None, deduplicated: bool = False) -> None:
    """Load one batch of newly landed raw request logs into the date-partitioned fact.

    * Exact dedup across batches: the index at ``seen_path`` (``operators.seen``) keeps every row that won dedup when it
      landed (valid or not), with the columns that decide. A retry is compared with all of them,
      however long ago its original landed, but only the slices that can hold one of the batch's ids are read.
    * A row that comes before the one stored for its id (an original landing after its
      retry) replaces it: ``<fact_path>_replaced`` names the stored row (id and batch) that
      no longer counts, and ``read_fact`` leaves it out. The fact equals a full rebuild.
    * Idempotent: the fact is written under ``load_batch=<batch_id>`` with dynamic partition
      overwrite, and the batch's own earlier rows are ignored and replaced, so replaying a failed or
      repeated batch rewrites exactly its own rows.
    * ``key_map``: the warehouse's stored key dimension, read instead of rebuilt per batch.
    * ``deduplicated``: ``landed`` is a stored table that went through ``dedup_logs`` already.
    """
    from ..operators import facts, quality

    spark = landed.sparkSession
    order = F.struct(*quality.LOG_ORDER)  # compares field by field, nulls first, as dedup does
    # computed once: the comparison and three writes read it. Frozen, not persisted: a cached shuffle keeps all its partitions,
    # whatever their size, and each of the writes would make files for every pair of them
    winners = landed if deduplicated else freeze(quality.dedup_logs(landed))
    n, least, greatest = winners.agg(F.count(F.lit(1)), F.min("request_id"), F.max("request_id")).first()
    if not n:
        return
    kept = ["request_id", *quality.LOG_ORDER]
    index = SeenIndex(spark, seen_path, StructType([schemas.REQUEST_LOGS_RAW[c] for c in kept]))
    stored = index.stored(winners.select("request_id"), least, greatest, batch_id) if least is not None else None
    fresh = winners.withColumn("_old", F.lit(None).cast("int"))
    if stored is not None:
        first = stored.groupBy("request_id").agg(F.min(F.struct(order.alias("o"), "load_batch")).alias("_stored"))
        fresh = (winners.join(first, "request_id", "left")
                        .filter(F.col("_stored").isNull() | (order < F.col("_stored.o")))
                        .withColumn("_old", F.col("_stored.load_batch").cast("int")).drop("_stored"))
    if stored is not None:
        fresh = freeze(fresh)
    valid = (fresh.filter(F.coalesce(quality.valid_numbers(), F.lit(False))).fillna({"error_code": "NONE"}).drop("_old"))
    fact = facts.build_fct_requests(valid, api_keys, dim_account, dim_api_key, dim_model, dim_status, key_map)

    def write(df: DataFrame, path: str, *parts: str) -> None:
        (df.withColumn("load_batch", F.lit(batch_id)).write.mode("overwrite")
           .option("partitionOverwriteMode", "dynamic").partitionBy(*parts, "load_batch").parquet(path))

    # the fact goes first and the index last: a batch that fails in between is loaded again whole
    write(fact.withColumn("request_date", F.to_date("request_time")).hint("rebalance", "request_date"),
          fact_path, "request_date")
    write(fresh.filter("_old IS NOT NULL").select("request_id", F.col("_old").alias("stored_batch")), fact_path + "_replaced")
    index.add(fresh.select(*kept), batch_id)


def read_fact(spark: SparkSession, fact_path: str) -> DataFrame:
    """The incrementally loaded fact without replaced rows and load bookkeeping columns."""
    fact = spark.read.parquet(fact_path)
    replaced = fact_path + "_replaced"
    if _exists(spark, replaced):
        gone = spark.read.schema("request_id long, stored_batch int, load_batch int").parquet(replaced)
        gone = gone.select(F.col("request_id").alias("_id"), F.col("stored_batch").alias("_batch"))
        fact = fact.join(gone, (fact.request_id == gone._id) & (fact.load_batch == gone._batch), "left_anti")
    return fact.drop("request_date", "load_batch")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def stream_fact_load(spark: SparkSession, landing_path: str, seen_path: str, fact_path: str, checkpoint: str,
                     api_keys: DataFrame, dim_account: DataFrame, dim_api_key: DataFrame, dim_model: DataFrame,
                     dim_status: DataFrame, key_map: DataFrame | None = None) -> None:
    """Load raw request-log files as they land: one ``availableNow`` run of a file stream whose
    micro-batches go through ``append_landed_logs`` with the micro-batch id as load batch.

    The stream's checkpoint remembers which files were processed; a micro-batch that is
    replayed after a failure rewrites exactly its own ``load_batch`` folders (exactly once).
    """
    def load(batch: DataFrame, batch_id: int) -> None:
        append_landed_logs(batch, batch_id, seen_path, fact_path, api_keys, dim_account, dim_api_key,
                           dim_model, dim_status, key_map)

    q = (spark.readStream.schema(schemas.REQUEST_LOGS_RAW).parquet(landing_path)
              .writeStream.foreachBatch(load).option("checkpointLocation", checkpoint)
              .trigger(availableNow=True).start())
    q.awaitTermination()
