"""The two programs a user runs: the ETL load and the metric calculation.

``run_etl``: extract the six source tables (parquet, CSV or JDBC), compute the
cleaning counters, and load every warehouse table into ``warehouse_path``
(dimensions before facts, counts observed on the writes).

``run_calculation``: read the loaded warehouse and run every metric for a
context — the daily grain, then the monthly grain — into the versioned metric
store at ``store_path`` (one atomic replace per sink and grain), with the metric
catalogue as a table beside it.

``run_incremental_etl``: the ETL for sources that grow, load by load.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.quality import dq_stats
from ..operators.store import MetricStore
from ..sources.loader import load_sources
from . import customers, finance
from .catalog import Catalogue, meta_metric
from .incremental import IncrementalWarehouse
from .metrics import MetricContext
from .runner import run_metrics
from .warehouse import Warehouse


def run_etl(spark: SparkSession, source_path: str, warehouse_path: str, fmt: str = "parquet",
            options: dict | None = None) -> dict:
    """Entry A: ``{"dq": {check: value}, "loaded": {table: rows}}`` (a handful of numbers)."""
    src = load_sources(spark, source_path, fmt, options)
    dq = {r.check_name: r.value for r in dq_stats(src.logs, src.billing).collect()}
    loaded = Warehouse.load(src, warehouse_path)
    return {"dq": dq, "loaded": loaded}


def read_warehouse(spark: SparkSession, warehouse_path: str) -> dict[str, DataFrame]:
    """The loaded tables with their declared columns (partition columns dropped)."""
    out, folder = {}, Warehouse.current(spark, warehouse_path)
    for name in Warehouse.TABLES:
        df = spark.read.parquet(f"{folder}/{name}")
        out[name] = df.select(*schemas.WAREHOUSE[name].fieldNames())
    return out


def run_incremental_etl(spark: SparkSession, source_path: str, warehouse_path: str, fmt: str = "parquet",
                        options: dict | None = None) -> dict[str, int]:
    """Entry A for growing sources: takes up what is new since the last run (see ``plans.incremental``); rows read."""
    return IncrementalWarehouse(spark, warehouse_path).load(load_sources(spark, source_path, fmt, options))


def run_calculation(spark: SparkSession, warehouse_path: str, store_path: str, ctx: MetricContext,
                    users: DataFrame, grains: tuple[str, ...] = ("daily", "monthly")):
    """Entry B: every metric into the store; returns the run report (one row per metric and grain).

    ``users`` is the users source (registrations are counted from it).
    """
    from .queries import all_specs

    t = read_warehouse(spark, warehouse_path)
    inputs = dict(t, users=users, activity=t["fct_account_daily_snapshot"],
                  leaderboard=customers.key_leaderboard(t["fct_api_requests"], t["dim_api_key"], ctx),
                  rfm=customers.rfm(t["fct_api_requests"], ctx),
                  forecast=finance.profit_forecast(t["fct_account_transactions"], t["fct_model_daily_snapshot"],
                                                   ctx))
    store = MetricStore(spark, store_path)
    Catalogue(spark, f"{store_path}/meta_metric").register(meta_metric(spark))
    reports = []
    for grain in grains:
        _, report = run_metrics(all_specs(), inputs, ctx, grain=grain, store=store)
        reports.append(report.withColumn("grain", F.lit(grain)))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out
