"""SCD-1 under S-16: the type-2 history kept up to date from drops of users and plan changes.

A drop touches some users. Their stored rows are the events that made them (the registration, and each
change with its old and new plan), so their history is built anew by ``scd2_from_changes`` from the stored and the new
events together: an open interval closes, a late change splits the interval it falls into, and a late first
change sets the registration plan. All other users' rows are kept as they are.

Rows lie in buckets by a hash of the user (``bucketed``); only those of touched users are written. Changes that
arrive before their user wait in ``pending`` and are taken up with a later drop. Account keys come from a
``KeyRegistry``, by event, so stored facts keep their accounts.

After any order of drops the history equals the full rebuild from all of them. A user or change that comes again
replaces its earlier version. A drop that was published and is applied again changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import schemas
from ..session import broadcast_if_small, freeze
from .bucketed import BucketedTable
from .registry import KeyRegistry
from .scd2 import scd2_from_changes

EVENT = ["user_id", "ord", "change_id"]
ORDER = ("user_id", "valid_from", "ord", "change_id")
USERS = StructType([schemas.USERS[c] for c in ("user_id", "email", "subscription_plan", "registration_date")])
CHANGES = StructType([schemas.USER_PLAN_CHANGES[c] for c in ("change_id", "user_id", "old_plan", "new_plan", "change_date")])
#: the dimension, and what its rows were made from
LINEAGE = (StructType([*schemas.DIM_ACCOUNT.fields]).add("ord", "integer").add("change_id", "long")
           .add("old_plan", "string").add("source_plan", "string"))


class AccountHistory(BucketedTable):
    """``dim_account`` under ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = 64):
        super().__init__(spark, root, LINEAGE, "user_id", buckets)
        self.keys = KeyRegistry(spark, f"{self.log.root}/_keys", EVENT, "account_sk")

    def read(self, keep_lineage: bool = False) -> DataFrame:
        """The newest published ``dim_account`` (with ``ord`` and ``change_id`` for the C-7 checks)."""
        return super().read().select(*schemas.DIM_ACCOUNT.fieldNames(), *(["ord", "change_id"] if keep_lineage else []))

    def apply(self, users: DataFrame, changes: DataFrame, stored: bool = False) -> int:
        """Take up a drop (either may be empty; each user and change once in it); the published version.
        ``stored``: both are stored tables, which may be read again and again."""
        base, state = self.state()
        users, changes = schemas.conform(users, USERS), schemas.conform(changes, CHANGES)
        if state.get("pending"):
            waiting = self.spark.read.schema(CHANGES).parquet(f"{self.log.root}/{state['pending']}")
            changes = changes.unionByName(waiting.join(changes.select("change_id"), "change_id", "left_anti"))
            changes = freeze(changes)
        elif not stored:
            changes = freeze(changes)
        users = users if stored else freeze(users)
        touched = freeze(users.select("user_id").union(changes.select("user_id")).distinct())
        hit = self.hit(state, touched)
        old = self.rows(state, hit)
        touched = broadcast_if_small(touched)  # of a small drop: the history isn't shuffled to find its rows
        theirs = old.join(touched, "user_id", "left_semi")
        # stored events of the touched users, unless the drop brings them anew
        first = theirs.filter("ord = 0").select("user_id", "email", F.col("source_plan").alias("subscription_plan"), "registration_date")
        known = theirs.filter("ord = 1").select("change_id", "user_id", "old_plan", F.col("subscription_plan").alias("new_plan"), F.col("valid_from").alias("change_date"))
        users = freeze(users.unionByName(first.join(users.select("user_id"), "user_id", "left_anti")))
        changes = freeze(changes.unionByName(known.join(changes.select("change_id"), "change_id", "left_anti")))
        made = scd2_from_changes(users.withColumn("source_plan", F.col("subscription_plan")), changes,
                                 carry=("email", "source_plan"), carry_changes=("old_plan",))
        made = self.keys.assign(freeze(made), [*ORDER[:3], F.col("change_id").asc_nulls_first()])
        pending = self.log.folder(base, "pending")
        waiting, n = changes.join(users.select("user_id"), "user_id", "left_anti").select(*CHANGES.fieldNames()), Observation()
        waiting.observe(n, F.count(F.lit(1)).alias("n")).write.parquet(f"{self.log.root}/{pending}")
        kept = old.join(touched, "user_id", "left_anti")
        return self.publish(base, state, hit, kept.unionByName(schemas.conform(made, LINEAGE)), pending=pending if n.get["n"] else None)

    def retire(self, keep: int = 2) -> None:
        super().retire(keep, lambda state: {state["pending"]} - {None})
