"""Entry B of the reference: metrics written as SQL text over registered views (SRC-8).

The warehouse tables are exposed as temporary views and each metric is one
``SELECT`` in Spark SQL; Catalyst plans it exactly like the DataFrame form.
The context is passed as literals built from ``MetricContext`` (no string
concatenation of user input).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .metrics import DAILY_CALLS, MAU, MetricContext, daily_calls_scope, mau_scope
from .runner import MetricSpec


def register_warehouse(tables: dict[str, DataFrame], prefix: str = "") -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(prefix + name)


def metric_sql(code: str, view: str, period: str, time_type: str, pattern: str, measure: str, where: str) -> str:
    """One platform metric as a statement: the measure per period of the view's rows in range; the
    sink's constant columns are added to the grouped result."""
    return f"""
WITH per_period AS (
  SELECT date_format({period}, '{pattern}') AS time_id, {measure} AS measured FROM {view} WHERE {where}
  GROUP BY date_format({period}, '{pattern}'))
SELECT '{code}' AS metric_code, 'platform' AS entity_type, 'all' AS entity_id, '{time_type}' AS time_type,
       time_id, double(measured) AS metric_value
FROM per_period"""


def daily_calls_sql(ctx: MetricContext, prefix: str = "") -> str:
    lo, hi = (t.isoformat(sep=" ") for t in (ctx.start, ctx.end))
    return metric_sql(DAILY_CALLS, f"{prefix}fct_api_requests", "request_time", "day", "yyyy-MM-dd", "count(request_id)",
                      f"request_time >= TIMESTAMP_NTZ '{lo}' AND request_time <= TIMESTAMP_NTZ '{hi}'")


def mau_sql(ctx: MetricContext, prefix: str = "") -> str:
    return metric_sql(MAU, f"{prefix}fct_account_daily_snapshot", "snapshot_date", "month", "yyyy-MM",
                      "count(DISTINCT account_sk)",
                      f"snapshot_date >= DATE '{ctx.start_date}' AND snapshot_date <= DATE '{ctx.end_date}'")


def run_sql_metrics(spark: SparkSession, tables: dict[str, DataFrame], ctx: MetricContext,
                    prefix: str = "mm_") -> DataFrame:
    """The value-sink metrics of the reference, each as one SQL statement, unioned."""
    register_warehouse(tables, prefix)
    return spark.sql(daily_calls_sql(ctx, prefix)).unionByName(spark.sql(mau_sql(ctx, prefix)))


def sql_spec(metric_code: str, stage: str, sink: str, text: str, scope, **more) -> MetricSpec:
    """A metric of one's own as SQL text, run like any other: validated, guarded and published by ``run_metrics``.

    The text names the inputs in braces (``{fct_api_requests}``) and the context's bounds as parameters
    (``:start``, ``:end``: timestamps, ``:start_date``, ``:end_date``: dates); it gives the sink's columns.
    ``scope``: the rows that a run replaces, as for ``MetricSpec``.
    """
    def build(inputs: dict[str, DataFrame], ctx: MetricContext) -> DataFrame:
        spark = next(iter(inputs.values())).sparkSession
        bounds = {"start": ctx.start, "end": ctx.end, "start_date": ctx.start_date, "end_date": ctx.end_date}
        named = {name: df for name, df in inputs.items() if f"{{{name}}}" in text}
        return spark.sql(text, args={k: v for k, v in bounds.items() if re.search(rf":{k}\b", text)}, **named)

    return MetricSpec(metric_code, stage, sink, build, scope, **more)


#: the reference's value metrics as SQL text
SQL_SPECS = [
    sql_spec(DAILY_CALLS, "platform", "dws_metric_value", f"""
        SELECT '{DAILY_CALLS}' AS metric_code, 'platform' AS entity_type, 'all' AS entity_id, 'day' AS time_type, time_id,
               double(count(*)) AS metric_value
        FROM (SELECT date_format(request_time, 'yyyy-MM-dd') AS time_id FROM {{fct_api_requests}}
              WHERE request_time BETWEEN :start AND :end) GROUP BY time_id""", daily_calls_scope),
    sql_spec(MAU, "platform", "dws_metric_value", f"""
        SELECT '{MAU}' AS metric_code, 'platform' AS entity_type, 'all' AS entity_id, 'month' AS time_type, time_id,
               double(count(DISTINCT account_sk)) AS metric_value
        FROM (SELECT date_format(snapshot_date, 'yyyy-MM') AS time_id, account_sk FROM {{fct_account_daily_snapshot}}
              WHERE snapshot_date BETWEEN :start_date AND :end_date) GROUP BY time_id""", mau_scope, time_grain="monthly"),
]
