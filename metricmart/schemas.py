"""Declared schemas of the source tables, the star schema and the metric store.

Every table of the warehouse has one ``StructType`` here; loads pass through
``conform`` so column order and types are fixed at write time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


S, I, L, D, B, TS, DT = (T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(),
                         T.BooleanType(), T.TimestampNTZType(), T.DateType())
MONEY = T.DecimalType(18, 4)
PRICE = T.DecimalType(10, 6)

# ---- source (OLTP) tables -------------------------------------------------------
USERS = _struct(("user_id", L), ("email", S), ("password_hash", S), ("registration_date", TS),
                ("subscription_plan", S), ("account_balance", MONEY), ("status", T.ByteType()),
                ("updated_at", TS))
USER_PLAN_CHANGES = _struct(("change_id", L), ("user_id", L), ("old_plan", S), ("new_plan", S),
                            ("change_date", TS), ("change_reason", S))
API_KEYS = _struct(("key_id", L), ("user_id", L), ("key_name", S), ("api_key", S),
                   ("created_at", TS), ("last_used_at", TS), ("is_active", B))
AI_MODELS = _struct(("model_id", S), ("provider", S), ("input_price_per_1M", PRICE),
                    ("output_price_per_1M", PRICE), ("input_cost_per_1M", PRICE),
                    ("output_cost_per_1M", PRICE), ("max_context", I), ("is_available", B))
REQUEST_LOGS_RAW = _struct(("request_id", L), ("key_id", L), ("model_id", S),
                           ("prompt_token_count", I), ("completion_token_count", I),
                           ("latency_ms", I), ("http_status", I), ("error_code", S),
                           ("request_time", TS))
BILLING_ORDERS = _struct(("order_id", L), ("user_id", L), ("amount", MONEY), ("order_type", S),
                         ("payment_method", S), ("transaction_status", S), ("created_at", TS))

SOURCES = {
    "users": USERS,
    "user_plan_changes": USER_PLAN_CHANGES,
    "api_keys": API_KEYS,
    "ai_models": AI_MODELS,
    "request_logs_raw": REQUEST_LOGS_RAW,
    "billing_orders": BILLING_ORDERS,
}

# ---- warehouse (star schema) ------------------------------------------------------
DIM_ACCOUNT = _struct(("account_sk", L), ("user_id", L), ("email", S), ("subscription_plan", S),
                      ("registration_date", TS), ("valid_from", TS), ("valid_to", TS),
                      ("is_current", B))
DIM_MODEL = _struct(("model_sk", L), ("model_id", S), ("provider", S), ("input_price_per_1M", D),
                    ("output_price_per_1M", D), ("input_cost_per_1M", D), ("output_cost_per_1M", D))
DIM_STATUS_CODE = _struct(("status_sk", L), ("http_status", I), ("error_code", S), ("is_error", B))
DIM_API_KEY = _struct(("key_sk", L), ("key_id", L), ("key_name", S), ("is_active", B))
FCT_API_REQUESTS = _struct(("request_id", L), ("account_sk", L), ("model_sk", L), ("status_sk", L),
                           ("key_sk", L), ("request_time", TS), ("latency_ms", I),
                           ("prompt_tokens", I), ("completion_tokens", I), ("revenue_usd", D),
                           ("cost_usd", D))
FCT_ACCOUNT_TRANSACTIONS = _struct(("transaction_id", L), ("account_sk", L), ("amount", MONEY),
                                   ("order_type", S), ("payment_method", S),
                                   ("transaction_status", S), ("created_at", TS))
FCT_ACCOUNT_DAILY_SNAPSHOT = _struct(("snapshot_date", DT), ("account_sk", L), ("daily_requests", L),
                                     ("sum_prompt_tokens", L), ("sum_completion_tokens", L),
                                     ("daily_revenue_usd", D), ("daily_cost_usd", D))
FCT_MODEL_DAILY_SNAPSHOT = _struct(("snapshot_date", DT), ("model_sk", L), ("daily_requests", L),
                                   ("sum_prompt_tokens", L), ("sum_completion_tokens", L),
                                   ("daily_revenue_usd", D), ("daily_cost_usd", D),
                                   ("sum_latency_ms", L), ("error_requests", L))

# ---- metric store and tags -----------------------------------------------------------
META_METRIC = _struct(("metric_code", S), ("metric_name", S), ("description", S), ("formula", S),
                      ("entity_type", S), ("time_type", S), ("status", S))
DWS_METRIC_VALUE = _struct(("metric_code", S), ("entity_type", S), ("entity_id", S),
                           ("time_type", S), ("time_id", S), ("metric_value", D))
DWS_METRIC_STRUCT = _struct(("metric_code", S), ("entity_type", S), ("entity_id", S),
                            ("time_type", S), ("time_id", S), ("struct_type", S),
                            ("struct_json", S))
ADS_ACCOUNT_TAGS = _struct(("account_sk", L), ("tag_key", S), ("tag_value", S),
                           ("confidence", D), ("updated_at", TS))
ADS_MODEL_TAGS = _struct(("model_sk", L), ("tag_key", S), ("tag_value", S), ("updated_at", TS))

WAREHOUSE = {
    "dim_account": DIM_ACCOUNT,
    "dim_model": DIM_MODEL,
    "dim_status_code": DIM_STATUS_CODE,
    "dim_api_key": DIM_API_KEY,
    "fct_api_requests": FCT_API_REQUESTS,
    "fct_account_transactions": FCT_ACCOUNT_TRANSACTIONS,
    "fct_account_daily_snapshot": FCT_ACCOUNT_DAILY_SNAPSHOT,
    "fct_model_daily_snapshot": FCT_MODEL_DAILY_SNAPSHOT,
    "meta_metric": META_METRIC,
    "dws_metric_value": DWS_METRIC_VALUE,
    "dws_metric_struct": DWS_METRIC_STRUCT,
    "ads_account_tags": ADS_ACCOUNT_TAGS,
    "ads_model_tags": ADS_MODEL_TAGS,
}

# What the metric store keeps of a result: its columns and the time it was written.
STORED_METRICS = {name: T.StructType([*WAREHOUSE[name].fields, T.StructField("created_at", T.TimestampType())])
                  for name in ("dws_metric_value", "dws_metric_struct")}

# Primary keys of the warehouse tables (checked by the constraint report, C-1).
PRIMARY_KEYS = {
    "dim_account": ["account_sk"],
    "dim_model": ["model_sk"],
    "dim_status_code": ["status_sk"],
    "dim_api_key": ["key_sk"],
    "fct_api_requests": ["request_id"],
    "fct_account_transactions": ["transaction_id"],
    "fct_account_daily_snapshot": ["snapshot_date", "account_sk"],
    "fct_model_daily_snapshot": ["snapshot_date", "model_sk"],
    "meta_metric": ["metric_code"],
    "dws_metric_value": ["metric_code", "entity_type", "entity_id", "time_type", "time_id"],
    "dws_metric_struct": ["metric_code", "entity_type", "entity_id", "time_type", "time_id"],
    "ads_account_tags": ["account_sk", "tag_key"],
    "ads_model_tags": ["model_sk", "tag_key"],
}

# Enum domains and column defaults of the source DDL.
PLANS = ["free", "pro", "enterprise"]
ORDER_TYPES = ["recharge", "subscription_fee", "usage_settlement", "refund"]
TRANSACTION_STATUSES = ["pending", "completed", "failed"]
# Column defaults of the source DDL, per table (clock defaults are source-side only).
SOURCE_DEFAULTS = {
    "users": {"subscription_plan": "free", "account_balance": 0, "status": 1},
    "user_plan_changes": {"change_reason": "user_upgrade"},
    "api_keys": {"key_name": "Default Key", "is_active": True},
    "ai_models": {"is_available": True},
    "request_logs_raw": {"prompt_token_count": 0, "completion_token_count": 0},
    "billing_orders": {"payment_method": "credit_card", "transaction_status": "completed"},
}
META_METRIC_DEFAULTS = {"status": "online"}
OPEN_END = "9999-12-31 00:00:00"  # valid_to of the current SCD2 row


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select, order and cast ``df``'s columns to ``schema`` (missing columns become NULL)."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        c = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def check_schema(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences between ``df`` and a sink schema (names and types); empty means valid."""
    problems = []
    got = {f.name: f.dataType for f in df.schema.fields}
    for f in schema.fields:
        if f.name not in got:
            problems.append(f"missing column {f.name}")
        elif got[f.name] != f.dataType:
            problems.append(f"column {f.name}: {got[f.name].simpleString()} != {f.dataType.simpleString()}")
    extra = set(got) - {f.name for f in schema.fields}
    problems.extend(f"unexpected column {c}" for c in sorted(extra))
    return problems
