"""AGG-1..AGG-3: periodic snapshot facts rolled up from the request fact.

Both are day × entity aggregates with map-side partial aggregation, so a hot
account or model is combined inside each task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import exact_sum


def _usage_sums():
    return [F.count(F.lit(1)).alias("daily_requests"),
            F.sum("prompt_tokens").cast("bigint").alias("sum_prompt_tokens"),
            F.sum("completion_tokens").cast("bigint").alias("sum_completion_tokens"),
            exact_sum("revenue_usd").alias("daily_revenue_usd"),
            exact_sum("cost_usd").alias("daily_cost_usd")]


def account_daily_snapshot(fact: DataFrame) -> DataFrame:
    """AGG-1: day × account → requests, token sums, revenue, cost."""
    out = (fact.groupBy(F.to_date("request_time").alias("snapshot_date"), "account_sk")
               .agg(*_usage_sums()))
    return schemas.conform(out, schemas.FCT_ACCOUNT_DAILY_SNAPSHOT)


def model_daily_snapshot(fact: DataFrame, dim_status: DataFrame) -> DataFrame:
    """AGG-2 / AGG-3 / JN-9: day × model → usage sums, latency sum and error count."""
    status = dim_status.select("status_sk", "is_error")
    out = (fact.join(status, "status_sk")
               .groupBy(F.to_date("request_time").alias("snapshot_date"), "model_sk")
               .agg(*_usage_sums(),
                    F.sum("latency_ms").cast("bigint").alias("sum_latency_ms"),
                    F.count_if("is_error").cast("bigint").alias("error_requests")))
    return schemas.conform(out, schemas.FCT_MODEL_DAILY_SNAPSHOT)
