"""Incremental forms that keep what is stored: the index of seen ids, account history, account keys."""

import re
import uuid
from datetime import datetime

import pytest
from paths import SF_SMALL
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from metricmart.operators import scd2, seen
from metricmart.operators.registry import KeyRegistry
from metricmart.operators.scd2_merge import AccountHistory
from metricmart.operators.seen import SeenIndex
from metricmart.plans import queries as Q
from metricmart.session import checkpoint_dir


def folder(spark, name):
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:8]}"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- seen ids

COLUMNS = StructType([StructField("request_id", LongType()), StructField("v", LongType())])


def rows(spark, ids, v):
    return spark.createDataFrame([(i, v) for i in ids], COLUMNS)


def test_filters_hold_every_id_and_rule_out_most_others(spark):
    blocks = 4
    filters = seen.bloom(spark.range(0, 10_000), "id", blocks).cache()
    assert filters.count() == blocks
    assert seen.may_hold(spark.range(0, 10_000), "id", filters, blocks).count() == 10_000
    assert seen.may_hold(spark.range(10_000, 30_000), "id", filters, blocks).count() < 20_000 * 0.03


def test_stored_rows_are_found_without_shuffling_the_history(spark):
    index = SeenIndex(spark, folder(spark, "seen"), COLUMNS, slice_rows=300)
    index.add(rows(spark, range(0, 20_000), 1), 1)
    index.add(rows(spark, range(20_000, 30_000), 2), 2)
    assert [r["slices"] for r in index.runs()] == [67, 34]
    ids = spark.createDataFrame([(i,) for i in [7, 19_999, 25_000, *range(40_000, 40_500)]], "request_id long")
    found = index.stored(ids, 7, 40_499, batch=3)
    assert sorted((r.request_id, r.load_batch) for r in found.collect()) == [(7, 1), (19_999, 1), (25_000, 2)]
    plan = plan_of(found)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the rows' scans read only the slices hit (three held ones, and those of one in a hundred of the other
    # ids), and nothing is exchanged above them but the broadcast list of ids
    filters = re.findall(r"FileScan parquet \[request_id#\d+L,v#\d+L,load_batch.*?PartitionFilters: \[(.*?)\], PushedFilters", plan)
    assert len(filters) >= 2
    slices = [len(re.findall(r"(?: IN \(| = |,| INSET )\d+", f)) for f in filters]
    assert all(0 < n <= 12 for n in slices), filters
    assert "Exchange hashpartitioning" not in plan.split("BroadcastExchange")[0]
    # ids beyond all runs, and a batch's own rows
    assert index.stored(rows(spark, range(90_000, 90_010), 0), 90_000, 90_009, batch=3) is None
    own = index.stored(ids, 7, 40_499, batch=2)
    assert sorted(r.request_id for r in own.collect()) == [7, 19_999]


def test_runs_merge_and_replayed_batches_replace_theirs(spark):
    index = SeenIndex(spark, folder(spark, "seen"), COLUMNS)
    for b in range(9):
        index.add(rows(spark, range(b * 100, b * 100 + 100), b), b)
    assert len(index.runs()) < 9 and sum(r["n"] for r in index.runs()) == 900
    index.add(rows(spark, [3, 5000], 77), 0)  # batch 0 again, with other rows; its old ones lie in a merged run
    every = spark.range(0, 6000).select(F.col("id").alias("request_id"))
    got = {(r.request_id, r.v) for r in index.stored(every, 0, 5999, batch=-1).collect()}
    assert got == {(3, 77), (5000, 77)} | {(i, i // 100) for i in range(100, 900)}
    index.retire(keep=1)
    assert {(r.request_id, r.v) for r in index.stored(every, 0, 5999, batch=-1).collect()} == got
    index.add(rows(spark, [], 0), 20)
    assert {(r.request_id, r.v) for r in index.stored(every, 0, 5999, batch=-1).collect()} == got


def test_a_large_batch_is_joined_by_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(seen, "broadcast_if_small", lambda df: df)
    index = SeenIndex(spark, folder(spark, "seen"), COLUMNS, slice_rows=300)
    index.add(rows(spark, range(0, 2000), 1), 1)
    assert index.stored(rows(spark, range(1000, 5000), 0), 1000, 4999, batch=2).count() == 1000


# ---- keys

def test_keys_stay_and_new_ones_follow(spark):
    keys = KeyRegistry(spark, folder(spark, "keys"), ["a", "b"], "sk")
    give = lambda rows: {(r.a, r.b): r.sk for r in keys.assign(spark.createDataFrame(rows, "a long, b string, x string"), ["a", F.col("b").asc_nulls_first()]).collect()}
    first = give([(1, None, "p"), (5, "x", "p"), (5, None, "p")])
    assert first == {(1, None): 1, (5, None): 2, (5, "x"): 3}
    second = give([(3, None, "q"), (1, None, "q"), (0, "z", "q"), (5, "x", "q")])
    assert second == {(1, None): 1, (5, "x"): 3, (0, "z"): 4, (3, None): 5}
    keys.compact()
    assert give([(5, None, "r"), (9, "n", "r")]) == {(5, None): 2, (9, "n"): 6}
    assert give([]) == {} and give([(0, "z", "s")]) == {(0, "z"): 4}


def test_new_keys_are_not_looked_up_again(spark):
    """rows carry the number that they were given; only those known before meet the stored numbers."""
    keys = KeyRegistry(spark, folder(spark, "keys"), ["a"], "sk")
    first = keys.assign(spark.range(5, 9).withColumnRenamed("id", "a"), ["a"])
    assert "FileScan" not in plan_of(first)
    assert {r.a: r.sk for r in first.collect()} == {5: 1, 6: 2, 7: 3, 8: 4}
    second = keys.assign(spark.range(3, 7).withColumnRenamed("id", "a"), ["a"])
    assert {r.a: r.sk for r in second.collect()} == {3: 5, 4: 6, 5: 1, 6: 2}
    assert {r.a: r.sk for r in keys.known(second).collect()} == {3: 5, 4: 6, 5: 1, 6: 2, 7: 3, 8: 4}


# ---- account history

USERS = "user_id long, email string, subscription_plan string, registration_date timestamp_ntz"
CHANGES = "change_id long, user_id long, old_plan string, new_plan string, change_date timestamp_ntz"


def rebuilt(spark, users, changes):
    full = scd2.scd2_from_changes(users, changes)
    return sorted((r.user_id, r.email, r.subscription_plan, r.valid_from, r.valid_to, r.is_current) for r in full.collect())


def held(history):
    return sorted((r.user_id, r.email, r.subscription_plan, r.valid_from, r.valid_to, r.is_current) for r in history.read().collect())


def test_late_changes_split_intervals_and_set_the_first_plan(spark):
    t = lambda d: datetime(2024, 1, d)
    users = [(1, "a@x", "pro", t(1)), (2, "b@x", "free", t(1)), (3, "c@x", "free", t(2))]
    changes = [(10, 1, "free", "pro", t(10)), (11, 1, "pro", "enterprise", t(20)), (12, 1, "enterprise", "pro", t(25)), (13, 3, "pro", "free", t(5)), (14, 9, "x", "y", t(1))]
    user = lambda *i: spark.createDataFrame([users[k] for k in i], USERS)
    change = lambda *i: spark.createDataFrame([changes[k] for k in i], CHANGES)
    history = AccountHistory(spark, folder(spark, "accounts"), buckets=8)
    drops = [(user(0, 1), change(2)), (user(), change(0, 4)), (user(), change(1, 3)), (user(2), change()), (user(0), change(0))]
    seen_users, seen_changes, keys = set(), set(), {}
    for u, c in drops:
        history.apply(u, c)
        seen_users |= {r.user_id for r in u.collect()}
        seen_changes |= {r.change_id for r in c.collect()}
        want = rebuilt(spark, spark.createDataFrame([x for x in users if x[0] in seen_users], USERS),
                       spark.createDataFrame([x for x in changes if x[0] in seen_changes], CHANGES))
        assert held(history) == want
        now = {(r.user_id, r.ord, r.change_id): r.account_sk for r in history.read(keep_lineage=True).collect()}
        assert all(now[e] == k for e, k in keys.items()) and len(set(now.values())) == len(now)
        keys = now
    bad = {r.rule: r.violations for r in scd2.scd2_invariants(history.read(keep_lineage=True), spark.createDataFrame(users, USERS)).collect()}
    assert not any(v for k, v in bad.items() if k != "zero_length")


def test_changed_users_replace_theirs_and_other_buckets_stay(spark):
    t = lambda d: datetime(2024, 1, d)
    history = AccountHistory(spark, folder(spark, "accounts"), buckets=16)
    history.apply(spark.createDataFrame([(i, f"u{i}@x", "free", t(1)) for i in range(200)], USERS), spark.createDataFrame([], CHANGES))
    before = history.state()[1]["runs"]
    history.apply(spark.createDataFrame([(5, "new@x", "pro", t(1))], USERS), spark.createDataFrame([(1, 7, "free", "pro", t(3))], CHANGES))
    after = history.state()[1]["runs"]
    changed = {b for b in after if after[b] != before.get(b)}
    assert 1 <= len(changed) <= 2 and len(before) == 16
    written = spark.read.parquet(f"{history.log.root}/{after[changed.pop()]}")
    assert written.count() < 60  # two buckets of sixteen
    five = history.read().filter("user_id = 5").collect()
    assert [(r.email, r.subscription_plan) for r in five] == [("new@x", "pro")]
    assert [r.subscription_plan for r in history.read().filter("user_id = 7").orderBy("valid_from").collect()] == ["free", "pro"]
    history.retire(keep=1)
    assert history.read().count() == 201


def test_a_merge_that_dies_leaves_the_old_history(spark, monkeypatch):
    s = Q.warehouse(spark, SF_SMALL).sources
    first, second, _ = Q.account_drops(s.users, s.plan_changes)
    history = AccountHistory(spark, folder(spark, "accounts"), buckets=4)
    history.apply(*first)
    before = held(history)
    with monkeypatch.context() as m:
        def dies(base, payload):
            raise SystemError("killed")
        m.setattr(history.log, "commit", dies)
        with pytest.raises(SystemError):
            history.apply(*second)
    assert held(history) == before
    history.apply(*second)
    assert len(held(history)) > len(before)
