"""MET-1..MET-3 and MET-6: the reference's three platform metrics and their context.

Each metric is a pure ``inputs → DataFrame`` function whose rows fit one sink
schema (``dws_metric_value`` or ``dws_metric_struct``), plus the delete
predicate that makes its write idempotent (SNK-5a..c).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import day_id, month_id, month_index


@dataclass
class MetricContext:
    """MET-6: an inclusive date range closed to 00:00:00 … 23:59:59.999999, optional scope."""

    start: datetime
    end: datetime
    user_ids: list | DataFrame | None = None
    model_ids: list | DataFrame | None = None
    metadata: dict = field(default_factory=dict)

    @classmethod
    def for_days(cls, first: date, last: date, **kw) -> "MetricContext":
        return cls(datetime.combine(first, time.min), datetime.combine(last, time.max), **kw)

    @property
    def start_date(self) -> date:
        return self.start.date()

    @property
    def end_date(self) -> date:
        return self.end.date()


def _eav(metric_code: str, entity_type: str, entity_id: Column, time_type: str, time_id: Column,
         value: Column) -> list[Column]:
    return [F.lit(metric_code).alias("metric_code"), F.lit(entity_type).alias("entity_type"),
            entity_id.cast("string").alias("entity_id"), F.lit(time_type).alias("time_type"),
            time_id.alias("time_id"), value.cast("double").alias("metric_value")]


def in_range(ts: Column, ctx: MetricContext) -> Column:
    """FLT-3: inclusive timestamp range."""
    return ts.between(F.lit(ctx.start), F.lit(ctx.end))


def in_days(d: Column, ctx: MetricContext) -> Column:
    """FLT-4: inclusive date range."""
    return d.between(F.lit(ctx.start_date), F.lit(ctx.end_date))


# ---- delete scopes (SNK-5, T19) ------------------------------------------------------------

def _iso_week(d: date) -> str:
    y, w, _ = d.isocalendar()
    return f"{y:04d}-W{w:02d}"


def period_bounds(time_type: str, ctx: MetricContext) -> tuple[str, str]:
    """The first and last ``time_id`` of the context for one ``time_type``; ids of one type sort
    like their periods, ids of different types never share a scope (T19)."""
    fmt = {"day": lambda d: d.strftime("%Y-%m-%d"), "week": _iso_week,
           "month": lambda d: d.strftime("%Y-%m"), "year": lambda d: d.strftime("%Y")}[time_type]
    return fmt(ctx.start_date), fmt(ctx.end_date)


def metric_scope(metric_code: str, ctx: MetricContext, time_types: tuple[str, ...] = ("day",),
                 entity_type: str | None = None, entity_ids: list | None = None) -> Column:
    """SNK-5: the rows a run of ``metric_code`` over ``ctx`` replaces.

    Time bounds come from each ``time_type``. The entities that a context names narrow it further,
    as a relation that the replace joins (``runner.scoped``, ``store.in_scope``); ``entity_ids`` is for short fixed lists.
    """
    periods = None
    for t in time_types:
        lo, hi = period_bounds(t, ctx)
        p = (F.col("time_type") == t) & F.col("time_id").between(lo, hi)
        periods = p if periods is None else periods | p
    pred = (F.col("metric_code") == metric_code) & periods
    if entity_type is not None:
        pred = pred & (F.col("entity_type") == entity_type)
    if entity_ids:
        pred = pred & F.col("entity_id").isin([str(e) for e in entity_ids])
    return pred


def history_scope(metric_code: str, ctx: MetricContext, time_type: str = "month") -> Column:
    """A metric recomputed over its whole history: everything up to the end period."""
    return ((F.col("metric_code") == metric_code) & (F.col("time_type") == time_type)
            & (F.col("time_id") <= period_bounds(time_type, ctx)[1]))


# ---- MET-1: daily platform calls -----------------------------------------------------
DAILY_CALLS = "platform.daily.calls"


def daily_platform_calls(fact: DataFrame, ctx: MetricContext) -> DataFrame:
    """Calls per day over the range; days without calls have no row."""
    per_day = (fact.filter(in_range(F.col("request_time"), ctx))
                   .groupBy(day_id(F.col("request_time")).alias("time_id"))
                   .agg(F.count(F.lit(1)).alias("n")))
    return per_day.select(*_eav(DAILY_CALLS, "platform", F.lit("all"), "day", F.col("time_id"), F.col("n")))


def daily_calls_scope(ctx: MetricContext) -> Column:
    """SNK-5a: what a daily-calls run replaces."""
    return metric_scope(DAILY_CALLS, ctx, ("day",), "platform", ["all"])


# ---- MET-2: MAU ------------------------------------------------------------------------
MAU = "platform.monthly.mau"


def mau(snapshot: DataFrame, ctx: MetricContext, align_to_month: bool = False,
        approximate: bool = False, rsd: float = 0.01) -> DataFrame:
    """Distinct accounts with a snapshot row per month (as coded: errors count too, T6).

    The range is the context's (T7); ``align_to_month`` floors the start to the
    first of its month so the first month is not a partial count. ``approximate``
    counts with HyperLogLog++ (``approx_count_distinct``, relative error ``rsd``):
    fixed-size sketches instead of a distinct shuffle, for very large account sets.
    """
    lo = F.trunc(F.lit(ctx.start_date), "month") if align_to_month else F.lit(ctx.start_date)
    distinct = (F.approx_count_distinct("account_sk", rsd) if approximate
                else F.count_distinct("account_sk"))
    per_month = (snapshot.filter(F.col("snapshot_date").between(lo, F.lit(ctx.end_date)))
                         .groupBy(month_id(F.col("snapshot_date")).alias("time_id"))
                         .agg(distinct.alias("n")))
    return per_month.select(*_eav(MAU, "platform", F.lit("all"), "month", F.col("time_id"), F.col("n")))


def mau_scope(ctx: MetricContext) -> Column:
    """SNK-5b: month-format bounds."""
    return metric_scope(MAU, ctx, ("month",), "platform", ["all"])


# ---- MET-3: cohort retention ------------------------------------------------------------
RETENTION = "platform.monthly.retention"


def ratio4_scaled(num: Column, den: Column) -> Column:
    """round(num/den, 4) HALF_UP as an exact count of 1/10000ths: floor((20000·num + den) / (2·den)).

    Integer inputs make this rounding identical in every engine; a double
    ``round(x, 4)`` is not on ties (T20). The double quotient is exact enough for
    ``den · 10000 < 2^52``.
    """
    n, d = num.cast("bigint"), den.cast("bigint")
    return F.floor((n * 20000 + d) / (d * 2)).cast("bigint")


def retention_long(dim_account: DataFrame, snapshot: DataFrame, end: date,
                   lookback_months: int = 24) -> DataFrame:
    """Cohort × active month: active users, cohort size and rate.

    Cohorts are current accounts registered since ``end − lookback`` (to the day);
    activity is any snapshot row up to ``end`` over all account versions. Only
    (cohort, month) pairs with activity appear.
    """
    end_lit = F.lit(end)
    cohorts = (dim_account.filter(F.col("is_current")
                                  & (F.col("registration_date") >= F.add_months(end_lit, -lookback_months)))
               .select("user_id", month_id(F.col("registration_date")).alias("cohort_month"),
                       month_index(F.col("registration_date")).alias("_c_idx")))
    active = (snapshot.filter(F.col("snapshot_date") <= end_lit).select("account_sk", "snapshot_date")
              .join(dim_account.select("account_sk", "user_id"), "account_sk")
              .select("user_id", month_id(F.col("snapshot_date")).alias("active_month"),
                      month_index(F.col("snapshot_date")).alias("_a_idx"))
              .distinct())  # DST-3: shrink to (user, month) before the cohort join
    base = (cohorts.join(active, "user_id")
                   .groupBy("cohort_month", "active_month", (F.col("_a_idx") - F.col("_c_idx")).alias("month_diff"))
                   .agg(F.count("user_id").alias("active_user_count")))  # (user, month) is unique by now
    sizes = cohorts.groupBy("cohort_month").agg(F.count("user_id").alias("total_users"))
    # one row per cohort month: at most lookback_months + 1 rows, whatever the data size
    out = base.join(F.broadcast(sizes), "cohort_month")
    scaled = ratio4_scaled(F.col("active_user_count"), F.col("total_users"))
    return out.select("cohort_month", "active_month", F.col("month_diff").cast("int").alias("month_diff"),
                      F.col("active_user_count").cast("bigint").alias("active_user_count"),
                      F.col("total_users").cast("bigint").alias("total_users"),
                      (scaled / 10000.0).alias("retention_rate"))


def retention_json(long: DataFrame) -> DataFrame:
    """AGG-8: one JSON object per cohort, ``{"month_0":1.0,"month_1":…}`` in month order.

    Collecting per cohort is bounded: at most one entry per month of the look-back.
    """
    per = long.groupBy("cohort_month").agg(
        F.sort_array(F.collect_list(F.struct("month_diff", "retention_rate"))).alias("_cells"))
    body = F.map_from_entries(F.transform(F.col("_cells"), lambda c: F.struct(
        F.concat(F.lit("month_"), c["month_diff"].cast("string")), c["retention_rate"])))
    return per.select(F.lit(RETENTION).alias("metric_code"), F.lit("platform").alias("entity_type"),
                      F.lit("all").alias("entity_id"), F.lit("month").alias("time_type"),
                      F.col("cohort_month").alias("time_id"), F.lit("distribution").alias("struct_type"),
                      F.to_json(body).alias("struct_json"))


def retention_scope(ctx: MetricContext) -> Column:
    """SNK-5c: every retention row up to the end month."""
    return (F.col("metric_code") == RETENTION) & (F.col("time_id") <= ctx.end.strftime("%Y-%m"))
