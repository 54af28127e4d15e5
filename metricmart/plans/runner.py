"""MET-4 / MET-5: run a list of metrics stage by stage and replace each sink once.

A metric is a ``MetricSpec``: a builder ``(inputs, ctx) -> DataFrame`` and the
scope its run replaces. Specs run in stage order (user → model → platform) and
priority. Each is built and computed under its own guard: one that fails, then or while
its rows are computed, is reported with its whole error and left out, together with its
scope; the others are published with a single atomic replace per sink, so the sink is never
seen half-deleted.

A context that names users or models runs only the metrics of those entities, on inputs cut
down to them, and replaces only their rows; the others are reported as skipped.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .. import schemas
from ..operators.store import MetricStore, replace_rows
from ..session import freeze, run_concurrently
from .metrics import MetricContext

STAGES = ("user", "model", "platform")


@dataclass
class MetricSpec:
    metric_code: str
    stage: str
    sink: str                                   # dws_metric_value | dws_metric_struct
    build: Callable[[dict, MetricContext], DataFrame]
    scope: Callable[[MetricContext], Column]
    time_grain: str = "daily"                   # daily | monthly | weekly | yearly
    priority: int = 0
    description: str = ""
    scoped_by: str | None = None                # user | model: can run for some entities alone


def select_specs(specs: list[MetricSpec], grain: str | None = None) -> list[MetricSpec]:
    """Stage order, then priority; optionally only one time grain."""
    chosen = [s for s in specs if grain is None or s.time_grain == grain]
    return sorted(chosen, key=lambda s: (STAGES.index(s.stage), s.priority))


def _named(ids) -> bool:
    """Whether a context's scope names anything (no list, or an empty one: all entities)."""
    return isinstance(ids, DataFrame) or bool(ids)


def _relation(spark: SparkSession, ids, column: DataFrame, name: str) -> DataFrame:
    """Named entities as a relation: a frame's first column, or a list, typed like ``name`` of ``column``."""
    kind = column.schema[name].dataType
    frame = ids if isinstance(ids, DataFrame) else spark.createDataFrame([(i,) for i in ids], StructType([StructField(name, kind)]))
    return frame.select(F.col(frame.columns[0]).cast(kind).alias(name)).distinct()


def scoped(inputs: dict, ctx: MetricContext) -> tuple[dict, DataFrame | None]:
    """FLT-9: inputs cut down to the context's users and models by semi joins, and the named entities as
    stored rows carry them (``entity_type, entity_id``; users by each of their accounts too). Lists of any length
    and frames alike stay relations; nothing comes to the driver."""
    out, entities = dict(inputs), []
    spark = next(iter(inputs.values())).sparkSession

    def keep(keys: DataFrame, on: str, names: tuple[str, ...]) -> None:
        for n in names:
            if n in out:
                out[n] = out[n].join(keys, on, "left_semi")

    def name(kind: str, keys: DataFrame) -> None:
        entities.append(keys.select(F.lit(kind).alias("entity_type"), F.col(keys.columns[0]).cast("string").alias("entity_id")))

    if _named(ctx.user_ids):
        users = _relation(spark, ctx.user_ids, inputs["dim_account"], "user_id")
        accounts = inputs["dim_account"].join(users, "user_id", "left_semi").select("account_sk")
        keep(accounts, "account_sk", ("fct_api_requests", "fct_account_daily_snapshot", "activity", "leaderboard", "rfm"))
        name("account", accounts)
        name("user", users)
    if _named(ctx.model_ids):
        named = _relation(spark, ctx.model_ids, inputs["dim_model"], "model_id")
        models = inputs["dim_model"].join(named, "model_id", "left_semi")
        keep(models.select("model_sk"), "model_sk", ("fct_api_requests", "fct_model_daily_snapshot"))
        out["dim_model"] = models
        name("model", named)
    return out, reduce(DataFrame.unionByName, entities) if entities else None


def run_metrics(specs: list[MetricSpec], inputs: dict, ctx: MetricContext,
                existing: dict[str, DataFrame] | None = None, grain: str | None = None,
                store: MetricStore | None = None):
    """Returns ``(tables, report)``: the replaced sink tables and one status row per metric.

    The metrics of a stage don't depend on each other: their jobs are submitted together and share the cluster.
    ``existing`` holds the current sink tables (empty when absent); with a
    ``store`` the new versions are also written there.
    """
    spark = next(iter(inputs.values())).sparkSession
    wanted = {n for n, ids in (("user", ctx.user_ids), ("model", ctx.model_ids)) if _named(ids)}
    inputs, entities = scoped(inputs, ctx)

    def compute(spec: MetricSpec):
        row = (spec.metric_code, spec.stage, spec.sink)
        if wanted and spec.scoped_by not in wanted:
            return spec, None, (*row, "skipped", "not a metric of the named entities")
        try:
            df = spec.build(inputs, ctx)
            problems = schemas.check_schema(df, schemas.WAREHOUSE[spec.sink])
            if problems:
                raise ValueError("; ".join(problems))
            df = store.stage(df) if store is not None else freeze(df)  # computed here, under this guard
            return spec, df, (*row, "ok", None)
        except Exception as e:  # isolate: the other metrics still run
            return spec, None, (*row, "failed", str(e))

    chosen, done = select_specs(specs, grain), []
    for stage in STAGES:
        done += run_concurrently([lambda s=s: compute(s) for s in chosen if s.stage == stage])
    report = [row for _, _, row in done]
    results: dict[str, list[tuple[MetricSpec, DataFrame]]] = {}
    for spec, df, _ in done:
        if df is not None:
            results.setdefault(spec.sink, []).append((spec, df))
    tables = dict(existing or {})
    for sink, items in results.items():
        new = reduce(DataFrame.unionByName, [df for _, df in items])
        scope = reduce(lambda a, b: a | b, [F.coalesce(s.scope(ctx), F.lit(False)) for s, _ in items])
        if store is not None:
            store.replace(sink, new, scope, entities, staged=True)
            tables[sink] = store.read(sink)
        else:
            cur = (existing or {}).get(sink)
            if cur is None:
                cur = spark.createDataFrame([], schemas.WAREHOUSE[sink])
            tables[sink] = replace_rows(cur, new, scope, entities)
    if store is not None:
        store.release()
    report_df = spark.createDataFrame(
        report, "metric_code string, stage string, sink string, status string, error string")
    return tables, report_df
