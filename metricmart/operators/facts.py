"""FCT-1 / FCT-2: transaction fact loads (the star join) and the orphan report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import token_amount
from .keys import key_lookup


def assert_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Refuse a lookup side whose join key repeats (a duplicate would multiply fact rows
    silently). One aggregation over the dimension-sized side; NULL keys count as equal."""
    checked = getattr(df, "_mm_unique", None)
    if checked == tuple(keys):  # this (materialised) frame was checked already
        return df
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").limit(1).count()
    if dup:
        raise ValueError(f"{name}: join key {keys} is not unique")
    try:
        df._mm_unique = tuple(keys)
    except AttributeError:
        pass
    return df


def status_join_condition(logs: DataFrame, dim_status: DataFrame):
    """JN-5: status equality and NULL-safe error-code equality."""
    return ((logs["http_status"] == dim_status["http_status"])
            & logs["error_code"].eqNullSafe(dim_status["error_code"]))


def build_key_map(api_keys: DataFrame, dim_api_key: DataFrame, dim_account: DataFrame) -> DataFrame:
    """K-2 as a derived dimension: ``key_id → key_sk, user_id, account_sk``, unique per key."""
    return assert_unique(key_lookup(api_keys, dim_api_key, dim_account), ["key_id"], "key map")


def build_fct_requests(clean_logs: DataFrame, api_keys: DataFrame, dim_account: DataFrame,
                       dim_api_key: DataFrame, dim_model: DataFrame,
                       dim_status: DataFrame, key_map: DataFrame | None = None) -> DataFrame:
    """FCT-1: the five-way star join with revenue and cost (inner joins only, T3/T4).

    The key joins fold into one user-sized lookup (K-2; pass the stored
    ``key_map`` to reuse it, e.g. in incremental loads); the model and status
    dimensions are joined without a hint: AQE broadcasts a side whose measured bytes allow it.
    A hot key (one user with a third of all calls) meets the lookup in a
    broadcast hash join or, where that is too large, in an AQE skew-split join.
    Every lookup side is checked for unique join keys first (SURVEY §4).
    """
    if key_map is None:
        key_map = build_key_map(api_keys, dim_api_key, dim_account)
    lookup = key_map
    models = assert_unique(dim_model, ["model_id"], "dim_model")
    status = assert_unique(dim_status, ["http_status", "error_code"], "dim_status_code").select(
        "status_sk", "http_status", "error_code")
    f = clean_logs.join(lookup, "key_id").join(models, "model_id")
    f = f.join(status, status_join_condition(f, status)).drop(status["http_status"]).drop(status["error_code"])
    p, c = F.col("prompt_token_count"), F.col("completion_token_count")
    out = f.select(
        "request_id", "account_sk", "model_sk", "status_sk", "key_sk", "request_time", "latency_ms",
        p.alias("prompt_tokens"), c.alias("completion_tokens"),
        token_amount(p, c, F.col("input_price_per_1M"), F.col("output_price_per_1M")).alias("revenue_usd"),
        token_amount(p, c, F.col("input_cost_per_1M"), F.col("output_cost_per_1M")).alias("cost_usd"))
    return schemas.conform(out, schemas.FCT_API_REQUESTS)


def build_fct_transactions(clean_billing: DataFrame, dim_account: DataFrame) -> DataFrame:
    """FCT-2: billing rows keyed to the current account (JN-6); all statuses kept."""
    current = assert_unique(dim_account.filter(F.col("is_current")).select("user_id", "account_sk"), ["user_id"],
                            "current accounts")
    out = clean_billing.join(current, "user_id").withColumnRenamed("order_id", "transaction_id")
    return schemas.conform(out, schemas.FCT_ACCOUNT_TRANSACTIONS)


def orphan_report(clean_logs: DataFrame, api_keys: DataFrame, dim_account: DataFrame,
                  dim_model: DataFrame, dim_status: DataFrame, clean_billing: DataFrame) -> DataFrame:
    """C-4 / T3: rows the inner joins drop, per reason, as ``(reason, orphan_rows)``.

    One pass over the logs: left joins with the lookups (one row per key, model and status pair, so no
    row is multiplied), a flag for each that is missing, one aggregation.
    """
    accounts = dim_account.filter(F.col("is_current")).select("user_id").distinct().withColumn("_account", F.lit(1))
    keys = (api_keys.select("key_id", "user_id").join(accounts, "user_id", "left")
                    .groupBy("key_id").agg(F.lit(1).alias("_key"), F.max("_account").alias("_account")))
    models = dim_model.select("model_id").distinct().withColumn("_model", F.lit(1))
    status = dim_status.select("http_status", "error_code").distinct().withColumn("_status", F.lit(1))
    logs = clean_logs.select("key_id", "model_id", "http_status", "error_code").join(keys, "key_id", "left").join(models, "model_id", "left")
    logs = logs.join(status, status_join_condition(logs, status), "left")
    gone = {"log_unknown_key": F.col("_key").isNull(), "log_unknown_model": F.col("_model").isNull(), "log_unknown_status": F.col("_status").isNull(),
            "log_key_without_account": F.col("_key").isNotNull() & F.col("_account").isNull()}
    bills = clean_billing.select("user_id").join(accounts, "user_id", "left")
    counts = [logs.agg(*[F.count_if(bad).alias(reason) for reason, bad in gone.items()]),
              bills.agg(F.count_if(F.col("_account").isNull()).alias("billing_unknown_account"))]
    rows = [c.unpivot([], c.columns, "reason", "orphan_rows") for c in counts]
    return rows[0].unionByName(rows[1])
