"""K-1 / K-2: dense, deterministic surrogate keys and key lookups.

``with_surrogate_key`` numbers rows 1..n in a declared total order by
``sequence.global_position``: range partitioning on the order, a reliable
checkpoint that freezes the partition assignment, per-partition counts turned
into prefix offsets (one row per partition, broadcast). Keys depend on the rows
alone, as long as the order columns are unique. Joins with dimensions carry no
hint: their sides grow with the data, so AQE chooses by measured bytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from .sequence import global_position

def with_surrogate_key(df: DataFrame, order_cols: list, name: str,
                       num_partitions: int | None = None) -> DataFrame:
    """Dense keys 1..n in ``order_cols`` order (``order_cols`` must be unique), whatever the size."""
    return global_position(df, order_cols, name, num_partitions)


def key_lookup(api_keys: DataFrame, dim_api_key: DataFrame, dim_account: DataFrame) -> DataFrame:
    """K-2: one lookup row per key: ``key_id → (key_sk, user_id, account_sk)``.

    Folds the reference's three key joins (source key → user, key dimension,
    current account) into one user-sized table, so the fact joins it once.
    """
    current = dim_account.filter(F.col("is_current")).select("user_id", "account_sk")
    return (api_keys.select("key_id", "user_id")
            .join(dim_api_key.select("key_id", "key_sk"), "key_id")
            .join(current, "user_id"))
