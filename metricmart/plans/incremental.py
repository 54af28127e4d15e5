"""The warehouse kept up to date load by load: only what is new in the sources is read, merged and appended.

``IncrementalWarehouse.load`` reads the growing sources past their bookmarks, merges users and plan changes
into the account history, gives new models, keys and status pairs the next surrogate keys, appends the new
requests to the fact with exact dedup against all earlier ones, and last moves the bookmarks. Keys that were
given stay, so facts of earlier loads point where they did. A load that dies anywhere is repeated
whole by the next one: its steps replace what the failed attempt had published.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import is_error
from ..operators import facts, quality
from ..operators.dims import status_codes
from ..operators.keys import key_lookup
from ..operators.registry import KeyRegistry
from ..operators.scd2_merge import AccountHistory
from ..session import freeze, run_concurrently
from ..sources.bookmarks import Bookmarks
from ..sources.loader import Sources
from ..streaming.incremental import append_landed_logs, read_fact


class IncrementalWarehouse:
    """Tables under ``root``; see the module."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        self.spark, self.root = spark, root.rstrip("/")
        self.accounts = AccountHistory(spark, f"{self.root}/dim_account", buckets)
        self.bookmarks = Bookmarks(spark, f"{self.root}/_bookmarks")

    @cached_property
    def keys(self) -> dict[str, KeyRegistry]:
        natural = {"dim_model": (["model_id"], "model_sk"), "dim_api_key": (["key_id"], "key_sk"), "dim_status_code": (["http_status", "error_code"], "status_sk")}
        return {t: KeyRegistry(self.spark, f"{self.root}/_keys/{t}", cols, name) for t, (cols, name) in natural.items()}

    def _dimension(self, table: str, rows: DataFrame) -> DataFrame:
        order = [F.col(c).asc_nulls_first() for c in self.keys[table].natural]
        return schemas.conform(self.keys[table].assign(freeze(rows), order), schemas.WAREHOUSE[table])

    def statuses(self, new_logs: DataFrame) -> DataFrame:
        """All status pairs: those known, and those of the new logs."""
        known = self.keys["dim_status_code"].known(new_logs.select("http_status", "error_code")).drop("status_sk")
        pairs = known.unionByName(status_codes(new_logs).drop("is_error")).distinct()
        return self._dimension("dim_status_code", pairs.withColumn("is_error", is_error(F.col("http_status"))))

    def load(self, src: Sources) -> dict[str, int]:
        """Take up what is new in ``src``; the number of rows read of each growing table."""
        base, _ = self.bookmarks.marks()
        tables = {"users": src.users, "user_plan_changes": src.plan_changes, "request_logs_raw": src.logs}
        new = dict(zip(tables, run_concurrently([lambda t=t, df=df: freeze(self.bookmarks.since(df, t)) for t, df in tables.items()]), strict=True))
        reached = dict(zip(new, run_concurrently([lambda t=t, df=df: self.bookmarks.reached(df, t) for t, df in new.items()]), strict=True))

        def landed() -> tuple[DataFrame, DataFrame]:
            winners = freeze(quality.dedup_logs(new["request_logs_raw"]))  # once, for the status pairs and the fact
            return winners, self.statuses(quality.valid_logs(winners))

        self.keys  # (made before the threads)
        # independent of each other: each has registries of its own
        _, dim_key, dim_model, (logs, dim_status) = run_concurrently([
            lambda: self.accounts.apply(new["users"], new["user_plan_changes"], stored=True),
            lambda: self._dimension("dim_api_key", src.api_keys), lambda: self._dimension("dim_model", src.models), landed])
        dim_account = self.accounts.read()
        key_map = facts.assert_unique(freeze(key_lookup(src.api_keys, dim_key, dim_account)), ["key_id"], "key map")
        append_landed_logs(logs, base + 1, f"{self.root}/_seen", f"{self.root}/fct_api_requests", src.api_keys, dim_account, dim_key, dim_model,
                           dim_status, key_map, deduplicated=True)
        self.bookmarks.advance(base, reached)
        return {t: df.count() for t, df in new.items()}

    def requests(self, src: Sources) -> DataFrame:
        """The fact with its natural keys in place of the surrogate ones."""
        fact = read_fact(self.spark, f"{self.root}/fct_api_requests")
        models, keys, status = (self.keys[t] for t in ("dim_model", "dim_api_key", "dim_status_code"))
        return (fact.join(self.accounts.read().select("account_sk", "user_id"), "account_sk")
                    .join(models.known(src.models), "model_sk").join(keys.known(src.api_keys), "key_sk")
                    .join(status.known(src.logs), "status_sk").drop("account_sk", "model_sk", "key_sk", "status_sk"))
