"""Incremental fact load: exact dedup across batches and idempotent replays."""

import uuid
from datetime import datetime

from metricmart import schemas
from metricmart.plans import queries as Q
from metricmart.session import checkpoint_dir
from metricmart.streaming import incremental

SF = "/root/testdata/sf0.001"


def test_cross_batch_retry_of_invalid_original_is_dropped(spark):
    wh = Q.warehouse(spark, SF)
    key = wh.sources.api_keys.select("key_id").orderBy("key_id").first().key_id
    dims = (wh.sources.api_keys, wh.dim_account, wh.dim_api_key, wh.dim_model, wh.dim_status_code)
    t = datetime
    batch1 = spark.createDataFrame([
        (1, key, "m1", 5, 5, 0, 200, None, t(2024, 1, 25, 23, 59, 59)),    # invalid original (latency 0)
        (2, key, "m1", 5, 5, 100, 200, None, t(2024, 1, 25, 12, 0, 0)),
    ], schemas.REQUEST_LOGS_RAW)
    batch2 = spark.createDataFrame([
        (1, key, "m1", 5, 5, 101, 200, None, t(2024, 1, 26, 0, 0, 0)),     # its retry, now valid
        (2, key, "m1", 5, 5, 100, 200, None, t(2024, 1, 26, 0, 0, 1)),     # retry of a loaded request
        (3, key, "m1", 5, 5, 100, 200, None, t(2024, 1, 26, 9, 0, 0)),
    ], schemas.REQUEST_LOGS_RAW)
    base = f"{checkpoint_dir(spark)}/inc-test-{uuid.uuid4().hex[:8]}"
    for bid, b in ((1, batch1), (2, batch2), (2, batch2)):  # batch 2 is replayed
        incremental.append_landed_logs(b, bid, base + "/seen", base + "/fact", *dims)
    got = sorted((r.request_id, r.latency_ms) for r in incremental.read_fact(spark, base + "/fact").collect())
    assert got == [(2, 100), (3, 100)]


def test_late_retries_and_late_originals_equal_a_full_rebuild(spark):
    wh = Q.warehouse(spark, SF)
    key = wh.sources.api_keys.select("key_id").orderBy("key_id").first().key_id
    dims = (wh.sources.api_keys, wh.dim_account, wh.dim_api_key, wh.dim_model, wh.dim_status_code)
    day = lambda d, s=0: datetime(2024, 1, d, 12, 0, s)
    rows = [
        [(1, key, "m1", 5, 5, 100, 200, None, day(20)), (2, key, "m1", 5, 5, 250, 200, None, day(23))],
        [(1, key, "m1", 5, 5, 101, 200, None, day(23)),  # its retry three days later: discarded
         (2, key, "m1", 5, 5, 200, 200, None, day(20)),  # the original after its retry: replaces it
         (3, key, "m1", 5, 5, 300, 200, None, day(24))],
        [(2, key, "m1", 5, 5, 0, 200, None, day(19)),    # an earlier, invalid original: takes the request out
         (3, key, "m1", 5, 5, 300, 200, None, day(24))],  # the same row again
    ]
    base = f"{checkpoint_dir(spark)}/inc-test-{uuid.uuid4().hex[:8]}"
    batches = [spark.createDataFrame(b, schemas.REQUEST_LOGS_RAW) for b in rows]
    for bid, b in ((1, batches[0]), (2, batches[1]), (2, batches[1]), (3, batches[2]), (2, batches[1])):
        incremental.append_landed_logs(b, bid, base + "/seen", base + "/fact", *dims)
    got = sorted((r.request_id, r.latency_ms) for r in incremental.read_fact(spark, base + "/fact").collect())
    assert got == [(1, 100), (3, 300)]


def test_a_small_batch_is_written_by_few_tasks_whatever_the_shuffle_partitions(spark, monkeypatch):
    """winners and fresh rows aren't cached shuffles, each of whose partitions every write would deal out again."""
    wh = Q.warehouse(spark, SF)
    dims = (wh.sources.api_keys, wh.dim_account, wh.dim_api_key, wh.dim_model, wh.dim_status_code, wh.key_map)
    base = f"{checkpoint_dir(spark)}/inc-test-{uuid.uuid4().hex[:8]}"
    parts, add = [], incremental.SeenIndex.add
    monkeypatch.setattr(incremental.SeenIndex, "add", lambda self, rows, batch: (parts.append(rows.rdd.getNumPartitions()), add(self, rows, batch))[1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        for bid, part in enumerate(Q.arrivals(wh.sources.logs)[:2], 1):
            incremental.append_landed_logs(part, bid, base + "/seen", base + "/fact", *dims)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(parts) == 2 and max(parts) <= 16, parts


def test_a_load_deduplicates_its_logs_once(spark, monkeypatch):
    from metricmart.operators import quality
    from metricmart.plans.incremental import IncrementalWarehouse

    s = Q.warehouse(spark, SF).sources
    s = Q.loader.Sources(s.users.withColumn("updated_at", s.users.registration_date), s.plan_changes, s.api_keys, s.models, s.logs, s.billing)
    calls, dedup = [], quality.dedup_logs
    monkeypatch.setattr(quality, "dedup_logs", lambda logs: (calls.append(1), dedup(logs))[1])
    own = IncrementalWarehouse(spark, f"{checkpoint_dir(spark)}/inc-test-{uuid.uuid4().hex[:8]}", buckets=2)
    assert own.load(s)["request_logs_raw"] == s.logs.count()
    assert len(calls) == 1
    assert own.requests(s).count() == Q.warehouse(spark, SF).fct_api_requests.count()
