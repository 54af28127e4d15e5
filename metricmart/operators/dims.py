"""DIM-1..DIM-4: dimension loads with deterministic surrogate keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import is_error
from .keys import with_surrogate_key
from .scd2 import scd2_from_changes


def build_dim_model(models: DataFrame) -> DataFrame:
    """DIM-1: models with prices narrowed to DOUBLE; SK in ``model_id`` order."""
    return schemas.conform(with_surrogate_key(models, ["model_id"], "model_sk"), schemas.DIM_MODEL)


def build_dim_api_key(api_keys: DataFrame) -> DataFrame:
    """DIM-3: keys; SK in ``key_id`` order."""
    return schemas.conform(with_surrogate_key(api_keys, ["key_id"], "key_sk"), schemas.DIM_API_KEY)


def status_codes(clean_logs: DataFrame) -> DataFrame:
    """DST-2 + PRJ-5: the distinct ``(http_status, error_code)`` pairs with their error flag."""
    return (clean_logs.select("http_status", "error_code").distinct()
            .withColumn("is_error", is_error(F.col("http_status"))))


def build_dim_status(clean_logs: DataFrame) -> DataFrame:
    """DIM-2: junk dimension of status pairs; SK in ``(http_status, error_code)`` order, NULLs first."""
    keyed = with_surrogate_key(status_codes(clean_logs),
                               [F.col("http_status").asc_nulls_first(),
                                F.col("error_code").asc_nulls_first()], "status_sk")
    return schemas.conform(keyed, schemas.DIM_STATUS_CODE)


def build_dim_account(users: DataFrame, plan_changes: DataFrame, keep_lineage: bool = False) -> DataFrame:
    """DIM-4: SCD2 account history; SK in ``(user_id, valid_from, ord, change_id)`` order."""
    hist = scd2_from_changes(users, plan_changes)
    keyed = with_surrogate_key(hist, ["user_id", "valid_from", "ord",
                                      F.col("change_id").asc_nulls_first()], "account_sk")
    if keep_lineage:
        return keyed.select(*schemas.DIM_ACCOUNT.fieldNames(), "ord", "change_id")
    return schemas.conform(keyed, schemas.DIM_ACCOUNT)
