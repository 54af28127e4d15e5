"""S-15: the metric catalogue (``meta_metric``) and its registration check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.bucketed import BucketedTable
from ..session import freeze

# Fixed values (ours): one catalogue row per metric code the engine writes
# (metric_code, metric_name, description, formula, entity_type, time_type).
METRICS = [
    ("platform.daily.calls", "Daily platform calls", "Requests per day", "COUNT(*) GROUP BY day",
     "platform", "day"),
    ("platform.monthly.mau", "Monthly active users", "Accounts with a snapshot row in the month",
     "COUNT(DISTINCT account_sk) GROUP BY month", "platform", "month"),
    ("platform.monthly.retention", "Monthly cohort retention", "Share of a cohort active N months later",
     "COUNT(DISTINCT user) / cohort size", "platform", "month"),
    ("platform.monthly.mau_success", "MAU with successful calls", "Accounts with a non-error call in the month",
     "COUNT(DISTINCT account_sk) WHERE NOT is_error", "platform", "month"),
    ("platform.monthly.registrations", "Registrations", "Users registered in the month", "COUNT(*)",
     "platform", "month"),
    ("platform.calls", "Platform calls by grain", "Requests per day, week, month and year", "COUNT(*)",
     "platform", "day"),
    ("account.monthly.calls", "Account calls", "Requests per account and month", "COUNT(*)", "account", "month"),
    ("account.monthly.tokens", "Account tokens", "Tokens per account and month", "SUM(tokens)", "account",
     "month"),
    ("account.monthly.spend", "Account spend", "Usage revenue per account and month", "SUM(revenue_usd)",
     "account", "month"),
    ("model.daily.calls", "Model calls", "Requests per model and day", "COUNT(*)", "model", "day"),
    ("model.daily.tokens", "Model tokens", "Tokens per model and day", "SUM(tokens)", "model", "day"),
    ("model.daily.success_rate", "Model success rate", "1 - errors / requests", "1 - SUM(err)/COUNT(*)",
     "model", "day"),
    ("account.monthly.key_rank", "Key leaderboard", "Keys of an account ranked by tokens", "RANK()",
     "account", "month"),
    ("account.monthly.rfm", "RFM segment", "Quintile scores and segment", "quintiles", "account", "month"),
    ("platform.monthly.profit_forecast", "Profit forecast", "Linear trend of daily profit, next 30 days",
     "regr_slope / regr_intercept", "platform", "month"),
]


def meta_metric(spark: SparkSession) -> DataFrame:
    rows = [(c, n, d, f, e, t, "online") for (c, n, d, f, e, t) in METRICS]
    return spark.createDataFrame(rows, schemas.META_METRIC)


class Catalogue(BucketedTable):
    """The stored ``meta_metric``: one row per metric code, kept up to date by key."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, schemas.META_METRIC, "metric_code", buckets=1)

    def register(self, rows: DataFrame) -> int:
        """Add metrics, or replace what the catalogue says of them; a missing status is the column's default."""
        new = freeze(schemas.conform(rows, schemas.META_METRIC).fillna(schemas.META_METRIC_DEFAULTS))
        return self.upsert(new, lambda old, new: old.join(new, "metric_code", "left_anti").unionByName(new))


def registration_check(catalogue: DataFrame, stored: DataFrame) -> DataFrame:
    """Every stored ``metric_code`` against the catalogue: rows stored and whether it is registered."""
    counts = stored.groupBy("metric_code").agg(F.count(F.lit(1)).alias("stored_rows"))
    j = catalogue.select("metric_code", F.lit(True).alias("_reg")).join(counts, "metric_code", "full")
    return j.select("metric_code", F.coalesce("_reg", F.lit(False)).alias("registered"),
                    F.coalesce("stored_rows", F.lit(0)).cast("bigint").alias("stored_rows"))
