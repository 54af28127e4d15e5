"""Driver test tables → the six source shapes (FIXTURES.md §2).

The adapters plant duplicates, invalid numbers, NULLs and orphans on purpose so
that cleaning and join rules have something to do. Each has a DuckDB twin in
``metricmart.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import plan_of_priority
from ..operators.sequence import neighbour_in_order
from .loader import DeferredSources, Sources


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def request_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``request_logs_raw`` from ``events``, with every 50th request repeated one second later."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    err = F.col("event_type") != "error"
    raw0 = ev.select(
        F.col("event_id").alias("request_id"),
        # one of the user's up to three keys; every 40th call bears a key that doesn't exist
        F.when(F.col("event_id") % 40 == 39, -1 - F.col("user_id"))
         .otherwise(F.col("user_id") * 3 + F.col("event_id") % (1 + F.col("user_id") % 3)).alias("key_id"),
        # the first 40 models of the catalogue; a 13th of the calls name one that isn't listed
        F.when(k % 13 == 12, "unlisted").otherwise(F.concat(F.lit("m"), (F.col("event_id") % 40).cast("string"))).alias("model_id"),
        F.when(F.col("event_id") % 101 == 0, F.lit(-5))
         .otherwise(F.floor(F.col("value") * 1000).cast("int")).alias("prompt_token_count"),
        F.when(F.col("event_id") % 103 == 0, F.lit(None).cast("int"))
         .otherwise(F.floor(F.col("value") * 250).cast("int")).alias("completion_token_count"),
        F.when(F.col("event_id") % 97 == 0, F.lit(0))
         .otherwise((300 + F.floor(F.col("value") * 15)).cast("int")).alias("latency_ms"),
        F.when(err, 200).when(k % 5 == 0, 500).when(k % 5 == 1, 400).when(k % 5 == 2, 401)
         .when(k % 5 == 3, 403).otherwise(429).alias("http_status"),
        F.when(err, F.lit(None).cast("string")).when(k % 5 == 0, "generic_error")
         .otherwise("client_error").alias("error_code"),
        F.col("ts").alias("request_time"),
    )
    # one scan: every 50th request is emitted twice, the copy one second later with latency + 1
    copies = F.explode(F.when(F.col("request_id") % 50 == 0, F.array(F.lit(0), F.lit(1)))
                        .otherwise(F.array(F.lit(0))))
    both = raw0.select("*", copies.alias("_copy"))
    retry = F.col("_copy") == 1
    both = both.withColumns({
        "latency_ms": F.when(retry, F.col("latency_ms") + 1).otherwise(F.col("latency_ms")),
        "request_time": F.when(retry, F.col("request_time") + F.expr("INTERVAL 1 SECOND"))
                         .otherwise(F.col("request_time"))})
    return schemas.conform(both, schemas.REQUEST_LOGS_RAW)


def api_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three keys for every customer (key ids ``3 × customer + 0..2``)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.explode(
        F.sequence(F.lit(0).cast("bigint"), F.col("c_custkey").cast("bigint") % 3)).alias("nth"))
    key = F.col("c_custkey") * 3 + F.col("nth")
    return schemas.conform(c.select(
        key.alias("key_id"), F.col("c_custkey").alias("user_id"),
        F.concat("c_name", F.lit(" key "), F.col("nth").cast("string")).alias("key_name"),
        F.concat(F.lit("sk-"), key.cast("string")).alias("api_key"),
        (key % 10 != 0).alias("is_active")), schemas.API_KEYS)


def ai_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A priced model ``m<partkey>`` for every row of ``part``, in forty price steps."""
    p = table(spark, sf_dir, "part")
    n = F.col("p_partkey") % 40 + 1
    return schemas.conform(p.select(
        F.concat(F.lit("m"), F.col("p_partkey").cast("string")).alias("model_id"),
        F.col("p_brand").alias("provider"),
        (F.lit(0.25) * n).alias("input_price_per_1M"), (F.lit(1.5) * n).alias("output_price_per_1M"),
        (F.lit(0.1875) * n).alias("input_cost_per_1M"), (F.lit(1.125) * n).alias("output_cost_per_1M"),
        F.lit(True).alias("is_available")), schemas.AI_MODELS)


def _orders_with_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_custkey", "o_orderdate",
                    plan_of_priority(F.col("o_orderpriority")).alias("plan"))


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with at least one order; registration = first order, plan = plan of the last order."""
    o = _orders_with_plan(spark, sf_dir)
    first_last = o.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("registration_date"),
        F.max_by("plan", F.struct("o_orderdate", "o_orderkey")).alias("subscription_plan"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    u = first_last.join(c, first_last.o_custkey == c.c_custkey)
    return schemas.conform(u.select(
        F.col("o_custkey").alias("user_id"), F.col("c_name").alias("email"),
        "registration_date", "subscription_plan",
        F.col("c_acctbal").alias("account_balance"), F.lit(1).alias("status")), schemas.USERS)


def plan_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A change whenever a customer's next order (by date, key) has another plan."""
    o = _orders_with_plan(spark, sf_dir)
    # the previous order's plan per customer (skew-proof lag)
    o = neighbour_in_order(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], ["plan"], "_prev_", "previous")
    ch = (o.withColumnRenamed("_prev_plan", "old_plan")
           .filter(F.col("old_plan").isNotNull() & (F.col("old_plan") != F.col("plan"))))
    rank = {p: i for i, p in enumerate(schemas.PLANS)}
    up = F.create_map(*[x for p, i in rank.items() for x in (F.lit(p), F.lit(i))])
    return schemas.conform(ch.select(
        F.col("o_orderkey").alias("change_id"), F.col("o_custkey").alias("user_id"),
        "old_plan", F.col("plan").alias("new_plan"), F.col("o_orderdate").alias("change_date"),
        F.when(up[F.col("plan")] > up[F.col("old_plan")], "user_upgrade")
         .otherwise("user_downgrade").alias("change_reason")), schemas.USER_PLAN_CHANGES)


def billing_orders(spark: SparkSession, sf_dir: str, aligned: bool = False) -> DataFrame:
    """Orders as billing rows: + for top-ups, − for charges and refunds, every 211th amount NULL.

    ``aligned=True`` moves ``created_at`` into the month of the request logs
    (2024-01-01 + o_orderkey mod 30 days) so finance metrics can combine both.
    """
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    created = (F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")).cast("timestamp_ntz")
               if aligned else F.col("o_orderdate"))
    return schemas.conform(o.select(
        key.alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.when(key % 211 == 0, F.lit(None).cast("double"))
         .when(key % 4 == 0, F.col("o_totalprice")).otherwise(-F.col("o_totalprice")).cast("decimal(18,4)").alias("amount"),
        F.when(key % 4 == 0, "recharge").when(key % 4 == 1, "subscription_fee")
         .when(key % 4 == 2, "usage_settlement").otherwise("refund").alias("order_type"),
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "credit_card")
         .when(F.col("o_orderpriority") == "3-MEDIUM", "paypal").otherwise("balance").alias("payment_method"),
        F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending")
         .otherwise("failed").alias("transaction_status"),
        created.alias("created_at")), schemas.BILLING_ORDERS)


def order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-level activity of each user from ``orders`` (80 months; used by retention)."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("user_id"),
                    F.col("o_orderdate").cast("date").alias("activity_date"))


def derive_sources(spark: SparkSession, sf_dir: str, aligned_billing: bool = False) -> Sources:
    """The six source tables built from the driver's parquet tables, each on first use."""
    return DeferredSources({
        "users": lambda: users(spark, sf_dir),
        "plan_changes": lambda: plan_changes(spark, sf_dir),
        "api_keys": lambda: api_keys(spark, sf_dir).select("key_id", "user_id", "key_name", "is_active"),
        "models": lambda: ai_models(spark, sf_dir),
        "logs": lambda: request_logs(spark, sf_dir),
        "billing": lambda: billing_orders(spark, sf_dir, aligned_billing)})
