"""Finance metrics (Tier 2): gross profit, ARPU, forecast, unit profit, spend trend,
burn rate and revenue against cost (S-2, S-3, S-4, S-5, S-9, S-12, S-20, S-21).

Money follows S-21: amounts are summed, fixed at 4 decimals through DECIMAL
(``money4``), and only then combined, so every engine agrees on ties (T20).
Billing is the date-aligned form (FIXTURES.md §2) so it overlaps the logs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import month_id, money4, round4, safe_ratio
from .metrics import MetricContext, in_days, in_range

DAY0 = "2024-01-01"  # fixed value: day 0 of the regression x-axis


def _completed(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("transaction_status") == "completed")


def monthly_profit(transactions: DataFrame, model_snapshot: DataFrame) -> DataFrame:
    """S-2: completed recharges − model cost per month (full outer join on month; ours)."""
    rech = (_completed(transactions).filter(F.col("order_type") == "recharge")
            .groupBy(month_id(F.col("created_at")).alias("month"))
            .agg(money4(F.sum("amount")).alias("recharge_usd")))
    cost = (model_snapshot.groupBy(month_id(F.col("snapshot_date")).alias("month"))
            .agg(money4(F.sum("daily_cost_usd")).alias("model_cost_usd")))
    j = rech.join(cost, "month", "full")
    zero = F.lit(0).cast("decimal(18,4)")
    return j.select("month", F.coalesce("recharge_usd", zero).alias("recharge_usd"),
                    F.coalesce("model_cost_usd", zero).alias("model_cost_usd"),
                    (F.coalesce("recharge_usd", zero) - F.coalesce("model_cost_usd", zero))
                    .cast("decimal(18,4)").alias("gross_profit_usd"))


def arpu(fact: DataFrame, account_snapshot: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-3: usage revenue of the month / active accounts of the month (ours: revenue = usage)."""
    rev = (fact.filter(in_range(F.col("request_time"), ctx))
               .groupBy(month_id(F.col("request_time")).alias("month"))
               .agg(money4(F.sum("revenue_usd")).alias("revenue_usd")))
    act = (account_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
                           .groupBy(month_id(F.col("snapshot_date")).alias("month"))
                           .agg(F.count_distinct("account_sk").alias("active_users")))
    j = rev.join(act, "month")
    return j.select("month", "revenue_usd", F.col("active_users").cast("bigint").alias("active_users"),
                    safe_ratio(F.col("revenue_usd"), F.col("active_users")).alias("arpu_usd"))


def daily_profit(transactions: DataFrame, model_snapshot: DataFrame, ctx: MetricContext,
                 lookback_days: int = 90) -> DataFrame:
    """Completed recharges − model cost per day over the ``lookback_days`` up to the context end."""
    lo = F.date_sub(F.lit(ctx.end_date), lookback_days - 1)
    hi = F.lit(ctx.end_date)
    rech = (_completed(transactions).filter(F.col("order_type") == "recharge")
            .withColumn("d", F.to_date("created_at")).filter(F.col("d").between(lo, hi))
            .groupBy("d").agg(F.sum(F.col("amount").cast("decimal(18,2)")).alias("rech")))
    cost = (model_snapshot.filter(F.col("snapshot_date").between(lo, hi))
            .groupBy(F.col("snapshot_date").alias("d"))
            .agg(F.sum("daily_cost_usd").cast("decimal(38,10)").alias("cost")))
    j = rech.join(cost, "d", "full")
    return j.select("d", (F.coalesce("rech", F.lit(0)) - F.coalesce("cost", F.lit(0)))
                    .cast("double").alias("profit"))


def profit_forecast(transactions: DataFrame, model_snapshot: DataFrame, ctx: MetricContext,
                    horizon_days: int = 30) -> DataFrame:
    """S-4 (ours): a linear trend on daily profit, projected over the next ``horizon_days``.

    The regression is one aggregate over at most 90 daily rows; the horizon is a
    ``sequence`` exploded into one row per future day.
    """
    dp = daily_profit(transactions, model_snapshot, ctx)
    x = F.datediff(F.col("d"), F.lit(DAY0)).cast("double")
    fit = dp.agg(F.regr_slope(F.col("profit"), x).alias("slope"),
                 F.regr_intercept(F.col("profit"), x).alias("intercept"))
    days = fit.select("slope", "intercept",
                      F.explode(F.sequence(F.lit(1), F.lit(horizon_days))).alias("i"))
    fd = F.date_add(F.lit(ctx.end_date), F.col("i"))
    return days.select(fd.alias("forecast_date"),
                       round4(F.col("intercept") + F.col("slope") * F.datediff(fd, F.lit(DAY0)).cast("double"))
                       .alias("predicted_profit_usd"))


def profit_per_1m(model_snapshot: DataFrame, dim_model: DataFrame, ctx: MetricContext) -> DataFrame:
    """S-5: (revenue − cost) per one million tokens, by model."""
    snap = model_snapshot.filter(in_days(F.col("snapshot_date"), ctx))
    per = snap.groupBy("model_sk").agg(
        money4(F.sum("daily_revenue_usd")).alias("revenue_usd"),
        money4(F.sum("daily_cost_usd")).alias("cost_usd"),
        F.sum(F.col("sum_prompt_tokens") + F.col("sum_completion_tokens")).cast("bigint").alias("total_tokens"))
    per = per.join(dim_model.select("model_sk", "model_id"), "model_sk")
    profit = (F.col("revenue_usd") - F.col("cost_usd")).cast("decimal(18,4)")
    return per.select("model_id", "revenue_usd", "cost_usd", profit.alias("profit_usd"), "total_tokens",
                      F.try_divide(profit.cast("double") * F.lit(1000000.0),
                                   F.col("total_tokens").cast("double")).alias("profit_per_1m_tokens"))


def spend_trend(account_snapshot: DataFrame, transactions: DataFrame) -> DataFrame:
    """S-9: per account and day, calls and tokens next to completed debits (full outer join)."""
    use = account_snapshot.select("account_sk", F.col("snapshot_date").alias("activity_date"),
                                  "daily_requests",
                                  (F.col("sum_prompt_tokens") + F.col("sum_completion_tokens")).alias("tokens"))
    debit = (_completed(transactions).filter(F.col("amount") < 0)
             .groupBy("account_sk", F.to_date("created_at").alias("activity_date"))
             .agg(money4(-F.sum("amount")).alias("debit")))
    j = use.join(debit, ["account_sk", "activity_date"], "full")
    return j.select("account_sk", "activity_date",
                    F.coalesce("daily_requests", F.lit(0)).cast("bigint").alias("daily_requests"),
                    F.coalesce("tokens", F.lit(0)).cast("bigint").alias("total_tokens"),
                    F.coalesce("debit", F.lit(0).cast("decimal(18,4)")).alias("debit_usd"))


LAST_DATE = date(9999, 12, 31)  # the last day that a date column can show


def burn_rate(transactions: DataFrame) -> DataFrame:
    """S-12: running balance by day per account, its linear slope and the run-out date.

    Balance = running sum of completed amounts (positive top-ups, negative
    charges); ``exhaust_date = last day + balance / −slope`` when the slope is
    negative and money is left (``days_left`` always, the date if a date can hold it). The running sum is a window per account over
    its days (one row per account-day after aggregation).
    """
    daily = (_completed(transactions)
             .groupBy("account_sk", F.to_date("created_at").alias("d"))
             .agg(F.sum(F.col("amount").cast("decimal(18,2)")).alias("net")))
    run = Window.partitionBy("account_sk").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    bal = daily.withColumn("balance", F.sum("net").over(run))
    x = F.datediff(F.col("d"), F.lit(DAY0)).cast("double")
    per = bal.groupBy("account_sk").agg(
        F.count(F.lit(1)).alias("active_days"), F.max("d").alias("last_day"),
        F.max_by("balance", "d").alias("balance_usd"),
        F.regr_slope(F.col("balance").cast("double"), x).alias("slope"))
    slope = round4(F.col("slope"))
    days_left = F.ceil(F.try_divide(F.col("balance_usd").cast("double"), -F.col("slope")))
    running_out = (F.col("slope") < 0) & (F.col("balance_usd") > 0)
    shown = running_out & (days_left <= F.datediff(F.lit(LAST_DATE), F.col("last_day")))
    return per.select("account_sk", F.col("active_days").cast("bigint").alias("active_days"), "last_day",
                      F.col("balance_usd").cast("decimal(18,2)").alias("balance_usd"),
                      slope.alias("burn_slope"), F.when(running_out, days_left.cast("bigint")).alias("days_left"),
                      F.when(shown, F.date_add(F.col("last_day"), days_left.cast("int"))).alias("exhaust_date"))


def model_revenue_cost(model_snapshot: DataFrame, dim_model: DataFrame) -> DataFrame:
    """S-20: revenue, cost, profit and margin per model and month."""
    per = model_snapshot.groupBy("model_sk", month_id(F.col("snapshot_date")).alias("month")).agg(
        money4(F.sum("daily_revenue_usd")).alias("revenue_usd"),
        money4(F.sum("daily_cost_usd")).alias("cost_usd"))
    per = per.join(dim_model.select("model_sk", "model_id"), "model_sk")
    profit = (F.col("revenue_usd") - F.col("cost_usd")).cast("decimal(18,4)")
    return per.select("model_id", "month", "revenue_usd", "cost_usd", profit.alias("profit_usd"),
                      safe_ratio(profit, F.col("revenue_usd")).alias("margin"))
