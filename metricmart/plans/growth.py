"""Growth metrics (Tier 2): plan flow, MAU growth, MAU of successful callers,
user / model stage metrics and the multi-grain roll-up (S-1, S-18, S-19, S-24, S-25).

Month-over-month values join each month to the previous calendar month on
``month_index − 1`` (an equi-join of aggregated rows) instead of a window
without a partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import day_id, month_id, month_index, money4, safe_ratio, week_id, year_id
from .metrics import MetricContext, in_days, in_range

PLAN_RANK = {p: i for i, p in enumerate(schemas.PLANS)}  # free < pro < enterprise


def _rank(c):
    return F.create_map(*[x for p, i in PLAN_RANK.items() for x in (F.lit(p), F.lit(i))])[c]


def with_previous(df: DataFrame, keys: list[str], value: str, prev: str) -> DataFrame:
    """Add the value of the previous calendar month (0 when that month has no row)."""
    before = df.select(*keys, (F.col("_idx") + 1).alias("_idx"), F.col(value).alias(prev))
    return (df.join(before, [*keys, "_idx"], "left")
              .withColumn(prev, F.coalesce(F.col(prev), F.lit(0)).cast("bigint")))


def plan_flow(users: DataFrame, plan_changes: DataFrame) -> DataFrame:
    """S-1: new, upgrade, downgrade and churn users per month, with month-over-month change.

    Ours: paid → free is churn, any other drop in rank is a downgrade; "new" is a registration.
    """
    reg = users.select("user_id", F.col("registration_date").alias("ts"), F.lit("new").alias("kind"))
    old, new = _rank(F.col("old_plan")), _rank(F.col("new_plan"))
    kind = (F.when((F.col("new_plan") == "free") & (F.col("old_plan") != "free"), "churn")
             .when(new > old, "upgrade").otherwise("downgrade"))
    chg = plan_changes.select("user_id", F.col("change_date").alias("ts"), kind.alias("kind"))
    ev = reg.unionByName(chg)
    per = (ev.groupBy(month_id(F.col("ts")).alias("month"), month_index(F.col("ts")).alias("_idx"), "kind")
             .agg(F.count_distinct("user_id").alias("users")))
    out = with_previous(per, ["kind"], "users", "prev_users")
    return out.select("month", "kind", F.col("users").cast("bigint").alias("users"), "prev_users",
                      F.try_divide((F.col("users") - F.col("prev_users")).cast("double"),
                                   F.col("prev_users").cast("double")).alias("mom_change"))


def mau_by_month(snapshot: DataFrame) -> DataFrame:
    return (snapshot.groupBy(month_id(F.col("snapshot_date")).alias("month"),
                             month_index(F.col("snapshot_date")).alias("_idx"))
                    .agg(F.count_distinct("account_sk").alias("mau")))


def mau_growth(snapshot: DataFrame) -> DataFrame:
    """S-18: MAU per month with the previous month's MAU and the growth rate."""
    out = with_previous(mau_by_month(snapshot), [], "mau", "prev_mau")
    return out.select("month", F.col("mau").cast("bigint").alias("mau"), "prev_mau",
                      F.try_divide((F.col("mau") - F.col("prev_mau")).cast("double"),
                                   F.col("prev_mau").cast("double")).alias("mau_growth"))


MAU_SUCCESS = "platform.monthly.mau_success"


def mau_success(fact: DataFrame, dim_status: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-19: accounts with at least one successful (non-error) call per month, as documented."""
    ok = dim_status.filter(~F.col("is_error")).select("status_sk")
    per = (fact.filter(in_range(F.col("request_time"), ctx)).join(ok, "status_sk")
               .groupBy(month_id(F.col("request_time")).alias("time_id"))
               .agg(F.count_distinct("account_sk").alias("n")))
    return per.select(F.lit(MAU_SUCCESS).alias("metric_code"), F.lit("platform").alias("entity_type"),
                      F.lit("all").alias("entity_id"), F.lit("month").alias("time_type"), "time_id",
                      F.col("n").cast("double").alias("metric_value"))


def _to_eav(wide: DataFrame, entity_type: str, entity_col: str, time_type: str, time_col: str,
            measures: dict[str, str]) -> DataFrame:
    """Unpivot measure columns into ``dws_metric_value`` rows (``measures``: column → metric code)."""
    long = wide.unpivot([entity_col, time_col], list(measures), "_measure", "_value")
    code = F.create_map(*[x for c, m in measures.items() for x in (F.lit(c), F.lit(m))])[F.col("_measure")]
    return long.select(code.alias("metric_code"), F.lit(entity_type).alias("entity_type"),
                       F.col(entity_col).cast("string").alias("entity_id"), F.lit(time_type).alias("time_type"),
                       F.col(time_col).alias("time_id"), F.col("_value").cast("double").alias("metric_value"))


ACCOUNT_STAGE = {"calls": "account.monthly.calls", "tokens": "account.monthly.tokens",
                 "spend": "account.monthly.spend"}
REGISTRATIONS = "platform.monthly.registrations"


def account_stage_metrics(fact: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-24 (user stage): per account and month: calls, tokens and spend over the range."""
    per = (fact.filter(in_range(F.col("request_time"), ctx))
               .groupBy("account_sk", month_id(F.col("request_time")).alias("month"))
               .agg(F.count(F.lit(1)).cast("double").alias("calls"),
                    F.sum(F.col("prompt_tokens") + F.col("completion_tokens")).cast("double").alias("tokens"),
                    money4(F.sum("revenue_usd")).cast("double").alias("spend")))
    return _to_eav(per, "account", "account_sk", "month", "month", ACCOUNT_STAGE)


def registrations(users: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-24 (user stage): registrations per month, over the whole history up to the end month."""
    return (users.filter(F.to_date("registration_date") <= F.lit(ctx.end_date))
                 .groupBy(month_id(F.col("registration_date")).alias("time_id"))
                 .agg(F.count(F.lit(1)).cast("double").alias("metric_value"))
                 .select(F.lit(REGISTRATIONS).alias("metric_code"), F.lit("platform").alias("entity_type"),
                         F.lit("all").alias("entity_id"), F.lit("month").alias("time_type"), "time_id",
                         "metric_value"))


def user_stage_metrics(fact: DataFrame, users: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-24 (user stage): the account metrics and the registrations."""
    return account_stage_metrics(fact, ctx).unionByName(registrations(users, ctx))


def model_stage_metrics(model_snapshot: DataFrame, dim_model: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-24 (model stage): per model and day calls, tokens and success rate."""
    snap = (model_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
                          .join(dim_model.select("model_sk", "model_id"), "model_sk"))
    per = snap.select(
        "model_id", day_id(F.col("snapshot_date")).alias("day"),
        F.col("daily_requests").cast("double").alias("calls"),
        (F.col("sum_prompt_tokens") + F.col("sum_completion_tokens")).cast("double").alias("tokens"),
        (F.lit(1.0) - safe_ratio(F.col("error_requests"), F.col("daily_requests"))).alias("success_rate"))
    return _to_eav(per, "model", "model_id", "day", "day",
                   {"calls": "model.daily.calls", "tokens": "model.daily.tokens",
                    "success_rate": "model.daily.success_rate"})


def calls_multi_grain(fact: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-25: platform calls at day, ISO week, month and year grain in one pass.

    Calls are first counted per day (partial aggregation), then each day is
    exploded into its four period ids and summed again — tiny after the first step.
    """
    daily = (fact.filter(in_range(F.col("request_time"), ctx))
                 .groupBy(F.to_date("request_time").alias("d")).agg(F.count(F.lit(1)).alias("n")))
    periods = F.array(
        F.struct(F.lit("day").alias("time_type"), day_id(F.col("d")).alias("time_id")),
        F.struct(F.lit("week").alias("time_type"), week_id(F.col("d")).alias("time_id")),
        F.struct(F.lit("month").alias("time_type"), month_id(F.col("d")).alias("time_id")),
        F.struct(F.lit("year").alias("time_type"), year_id(F.col("d")).alias("time_id")))
    exploded = daily.select("n", F.explode(periods).alias("p")).select("n", "p.time_type", "p.time_id")
    return (exploded.groupBy("time_type", "time_id").agg(F.sum("n").cast("double").alias("metric_value"))
                    .select(F.lit("platform.calls").alias("metric_code"), F.lit("platform").alias("entity_type"),
                            F.lit("all").alias("entity_id"), "time_type", "time_id", "metric_value"))
