"""Quality-of-service metrics (Tier 2): P99 latency and error rate, 3-sigma alerts,
snapshot ratios, model share and time-zone alignment (S-6, S-7, S-17, S-22, S-23).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import day_id, month_id, round4, safe_ratio
from ..operators.percentile import histogram_percentile
from ..session import freeze
from .metrics import MetricContext, in_days, in_range

SIGMA = 3.0  # fixed value: the alert and outlier threshold in standard deviations


def _calls_by_model(fact: DataFrame, dim_model: DataFrame, ctx: MetricContext) -> DataFrame:
    return (fact.filter(in_range(F.col("request_time"), ctx))
                .join(dim_model.select("model_sk", "model_id"), "model_sk"))


def p99_latency(fact: DataFrame, dim_model: DataFrame, ctx: MetricContext, p: float = 0.99,
                approximate: bool = False, accuracy: int = 10000) -> DataFrame:
    """S-6: exact continuous P99 latency per model after removing 3σ outliers.

    Ours: a request is an outlier when its latency is more than 3 sample standard
    deviations from the mean of its model and day. The fact is read once, into a
    (model, day, latency) → count histogram; the moments of a model-day, the cut, the counts
    and the percentile all come from it, so a hot model never gathers its rows in one task.
    ``approximate`` uses a ``percentile_approx`` sketch instead (bounded memory for any value domain).
    """
    hist = freeze(_calls_by_model(fact, dim_model, ctx)
                  .groupBy("model_id", F.to_date("request_time").alias("_d"), "latency_ms").agg(F.count(F.lit(1)).alias("_c")))
    x, c = F.col("latency_ms").cast("double"), F.col("_c").cast("double")
    moments = hist.filter("latency_ms IS NOT NULL").groupBy("model_id", "_d").agg(
        F.sum(c).alias("_n"), F.sum(c * x).alias("_s"), F.sum(c * x * x).alias("_q"))
    # |x - s/n| <= 3 sd, multiplied out: sd² = (n q - s²) / (n (n - 1)); a single request always stays
    n, total, squares = F.col("_n"), F.col("_s"), F.col("_q")
    keep = F.coalesce((n * x - total) * (n * x - total) * (n - 1) <= SIGMA * SIGMA * n * (n * squares - total * total), F.lit(False))
    marked = hist.join(moments, ["model_id", "_d"], "left").withColumn("_keep", keep)
    counts = marked.groupBy("model_id").agg(F.sum("_c").alias("requests"),
                                            F.sum(F.when(F.col("_keep"), F.col("_c")).otherwise(0)).alias("kept_requests"))
    kept = marked.filter("_keep").groupBy("model_id", "latency_ms").agg(F.sum("_c").alias("_c"))
    if approximate:  # a sketch of the requests themselves, cut by the same moments
        rows = _calls_by_model(fact, dim_model, ctx).withColumn("_d", F.to_date("request_time"))
        pct = (rows.join(moments, ["model_id", "_d"]).filter(keep).groupBy("model_id")
                   .agg(F.percentile_approx("latency_ms", p, accuracy).cast("double").alias("_p")))
    else:
        pct = histogram_percentile(kept, ["model_id"], "latency_ms", "_c", p, "_p")
    return counts.join(pct, "model_id", "left").select(
        "model_id", F.col("requests").cast("bigint").alias("requests"),
        F.col("kept_requests").cast("bigint").alias("kept_requests"),
        round4(F.col("_p")).alias("p99_latency_ms"))


def error_rate(fact: DataFrame, dim_model: DataFrame, dim_status: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-6: share of requests with an HTTP status other than 200, per model."""
    st = dim_status.select("status_sk", "http_status")
    per = (_calls_by_model(fact, dim_model, ctx).join(st, "status_sk")
           .groupBy("model_id").agg(F.count(F.lit(1)).alias("requests"),
                                    F.count_if(F.col("http_status") != 200).alias("errors")))
    return per.select("model_id", F.col("requests").cast("bigint").alias("requests"),
                      F.col("errors").cast("bigint").alias("errors"),
                      safe_ratio(F.col("errors"), F.col("requests")).alias("error_rate"))


def zscores(series: DataFrame, entity: str, day: str, value: str) -> DataFrame:
    """S-7: z of each day's value over its entity's daily series; alert when |z| > 3.

    The window is per entity over its days (aggregated rows, one per day).
    Note: with sample σ one spike can pass 3 only when the series has ≥ 11 days.
    """
    w = Window.partitionBy(entity)
    z = F.try_divide(F.col(value) - F.avg(value).over(w), F.stddev_samp(value).over(w))
    # the alert is decided on the 4-decimal z, so a z of exactly 3 is never an alert in any engine
    return (series.withColumn("z_score", round4(z))
                  .select(entity, day, value, "z_score",
                          F.coalesce(F.abs(F.col("z_score")) > F.lit(SIGMA), F.lit(False)).alias("is_alert")))


def latency_zscore(model_snapshot: DataFrame, dim_model: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-7: daily mean latency per model (Σlatency / Σrequests) against its own history."""
    s = (model_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
         .join(dim_model.select("model_sk", "model_id"), "model_sk")
         .select("model_id", "snapshot_date",
                 safe_ratio(F.col("sum_latency_ms"), F.col("daily_requests")).alias("mean_latency_ms")))
    return zscores(s, "model_id", "snapshot_date", "mean_latency_ms")


def traffic_zscore(account_snapshot: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-7: daily requests per account against its own history (traffic bursts)."""
    s = (account_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
         .select("account_sk", "snapshot_date", F.col("daily_requests").cast("double").alias("daily_requests")))
    return zscores(s, "account_sk", "snapshot_date", "daily_requests")


def alert_count(latency: DataFrame, traffic: DataFrame) -> DataFrame:
    """S-7: the number of 3σ alerts per kind."""
    def count(df, kind):
        return df.agg(F.count_if("is_alert").cast("bigint").alias("alerts")).select(
            F.lit(kind).alias("alert_type"), "alerts")
    return count(latency, "latency").unionByName(count(traffic, "traffic"))


def model_qos_from_snapshot(model_snapshot: DataFrame, dim_model: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-17: non-additive ratios from additive snapshot sums (Σlatency/Σrequests, Σerrors/Σrequests)."""
    per = (model_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
           .groupBy("model_sk").agg(F.sum("daily_requests").alias("requests"),
                                    F.sum("sum_latency_ms").alias("latency"),
                                    F.sum("error_requests").alias("errors")))
    per = per.join(dim_model.select("model_sk", "model_id"), "model_sk")
    return per.select("model_id", F.col("requests").cast("bigint").alias("requests"),
                      safe_ratio(F.col("latency"), F.col("requests")).alias("mean_latency_ms"),
                      safe_ratio(F.col("errors"), F.col("requests")).alias("error_rate"))


def model_share(model_snapshot: DataFrame, dim_model: DataFrame) -> DataFrame:
    """S-23: each model's share of the month's requests (window sum per month over model rows)."""
    per = (model_snapshot.groupBy("model_sk", month_id(F.col("snapshot_date")).alias("month"))
           .agg(F.sum("daily_requests").alias("requests")))
    per = per.join(dim_model.select("model_sk", "model_id"), "model_sk")
    total = F.sum("requests").over(Window.partitionBy("month"))
    return per.select("model_id", "month", F.col("requests").cast("bigint").alias("requests"),
                      safe_ratio(F.col("requests"), total).alias("share"))


LOG_ZONE = "Asia/Shanghai"  # fixed value: the zone the gateway writes local request times in (ours)


def timezone_align(fact: DataFrame, ctx: MetricContext, source_zone: str = LOG_ZONE) -> DataFrame:
    """S-22: local request times moved to UTC before bucketing, so days line up with billing."""
    utc = F.convert_timezone(F.lit(source_zone), F.lit("UTC"), F.col("request_time"))
    f = fact.filter(in_range(F.col("request_time"), ctx)).withColumn("_utc", utc)
    return (f.groupBy(day_id(F.col("_utc")).alias("utc_day"))
             .agg(F.count(F.lit(1)).alias("calls"))
             .select("utc_day", F.col("calls").cast("bigint").alias("calls")))
