"""DQ-1: cleaning and its counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ordered(cols: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def first_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """DST-1: keep the first row per ``key`` in a declared order (never bare ``dropDuplicates``).

    ``row_number() == 1`` is planned with a partial per-partition group limit
    before the shuffle, so each task ships at most one row per key.
    """
    w = Window.partitionBy(*key).orderBy(*_ordered(order))
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


LOG_ORDER = ["request_time", "key_id", "model_id", "prompt_token_count", "completion_token_count",
             "latency_ms", "http_status", "error_code"]


def valid_numbers() -> Column:
    """FLT-1 / T2: tokens >= 0 and latency > 0; a NULL fails (the row is dropped)."""
    return ((F.col("prompt_token_count") >= 0) & (F.col("completion_token_count") >= 0)
            & (F.col("latency_ms") > 0))


def dedup_logs(logs: DataFrame) -> DataFrame:
    return first_per_key(logs, ["request_id"], LOG_ORDER)


def clean_logs(logs: DataFrame, fill_error_code: bool = True) -> DataFrame:
    """DQ-1 on logs: dedup by request_id (T1), numeric validity (T2), NULL error_code → 'NONE' (SCL-7)."""
    return valid_logs(dedup_logs(logs), fill_error_code)


def valid_logs(winners: DataFrame, fill_error_code: bool = True) -> DataFrame:
    """The rest of DQ-1 on rows that went through ``dedup_logs``."""
    out = winners.filter(F.coalesce(valid_numbers(), F.lit(False)))
    return out.fillna({"error_code": "NONE"}) if fill_error_code else out


def clean_billing(billing: DataFrame) -> DataFrame:
    """FLT-2: drop billing rows without an amount."""
    return billing.dropna(subset=["amount"])


def dq_stats(logs: DataFrame, billing: DataFrame) -> DataFrame:
    """AGG-10: the cleaning counters as ``(check_name, value)`` rows.

    Duplicates = raw rows − dedup winners; invalid = winners failing the validity
    mask. The winners come from the group-limited ``first_per_key`` (at most one
    row per key leaves each task), so a retry storm on one request id stays spread.
    """
    raw = logs.select(F.lit(1).alias("_raw"), F.lit(0).alias("_kept"), F.lit(0).alias("_bad"))
    kept = dedup_logs(logs).select(F.lit(0).alias("_raw"), F.lit(1).alias("_kept"),
                                   F.when(F.coalesce(valid_numbers(), F.lit(False)), 0).otherwise(1).alias("_bad"))
    log_counts = raw.unionByName(kept).agg(
        F.sum("_raw").alias("original_logs"), (F.sum("_raw") - F.sum("_kept")).alias("deduplicated_logs"),
        F.sum("_bad").alias("invalid_numeric_logs"))
    bill_counts = billing.agg(F.count(F.lit(1)).alias("original_billing"),
                              F.count_if(F.col("amount").isNull()).alias("invalid_billing"))
    return _unpivot(log_counts, "check_name", "value").unionByName(
        _unpivot(bill_counts, "check_name", "value"))


def _unpivot(one_row: DataFrame, name_col: str, value_col: str) -> DataFrame:
    cols = one_row.columns
    return one_row.unpivot([], cols, name_col, value_col).select(
        name_col, F.col(value_col).cast("bigint").alias(value_col))
