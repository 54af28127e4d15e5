"""Hand-made micro tables for the semantic traps."""

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from metricmart import schemas
from metricmart.functions.columns import money4
from metricmart.operators import facts, quality, scd2
from metricmart.operators.dims import build_dim_status
from metricmart.operators.store import replace_rows
from metricmart.plans import metrics as M
from metricmart.plans import qos


def ts(*a):
    return datetime(*a)


def logs_df(spark, rows):
    return spark.createDataFrame(rows, schemas.REQUEST_LOGS_RAW)


def test_t1_t2_dedup_and_validity(spark):
    rows = [
        (1, 10, "m1", 5, 5, 100, 200, None, ts(2024, 1, 1, 0, 0, 1)),   # retry one second later: dropped
        (1, 10, "m1", 5, 5, 101, 200, None, ts(2024, 1, 1, 0, 0, 2)),
        (2, 10, "m1", 5, 5, 0, 200, None, ts(2024, 1, 1)),              # latency 0: invalid
        (3, 10, "m1", -1, 5, 100, 200, None, ts(2024, 1, 1)),           # negative tokens: invalid
        (4, 10, "m1", None, 5, 100, 200, None, ts(2024, 1, 1)),         # NULL tokens: invalid
        (5, 10, "m1", 0, 0, 100, 500, "generic_error", ts(2024, 1, 1)),  # zero tokens: valid
    ]
    out = quality.clean_logs(logs_df(spark, rows)).orderBy("request_id").collect()
    assert [(r.request_id, r.latency_ms, r.error_code) for r in out] == [(1, 100, "NONE"), (5, 100, "generic_error")]
    stats = dict(quality.dq_stats(logs_df(spark, rows), spark.createDataFrame(
        [(1, 1, None, "refund", "x", "completed", ts(2024, 1, 1))], schemas.BILLING_ORDERS)).collect())
    assert stats == {"original_logs": 6, "deduplicated_logs": 1, "invalid_numeric_logs": 3,
                     "original_billing": 1, "invalid_billing": 1}


def test_null_safe_status_join(spark):
    rows = [(1, 1, "m1", 1, 1, 10, 200, None, ts(2024, 1, 1)),
            (2, 1, "m1", 1, 1, 10, 500, "generic_error", ts(2024, 1, 1)),
            (3, 1, "m1", 1, 1, 10, 200, None, ts(2024, 1, 2))]
    logs = logs_df(spark, rows)
    status = build_dim_status(logs)
    assert status.count() == 2
    joined = logs.join(status, facts.status_join_condition(logs, status))
    assert joined.count() == 3  # NULL = NULL matches; a plain equi-join would drop two rows


def scd_inputs(spark):
    users = spark.createDataFrame([
        (1, "a", ts(2024, 1, 1), "free"),      # no change
        (2, "b", ts(2024, 1, 1), "pro"),       # one change
        (3, "c", ts(2024, 1, 1), "enterprise"),  # two changes at the same instant
        (4, "d", ts(2024, 2, 1), "pro"),       # change dated before registration
    ], "user_id long, email string, registration_date timestamp_ntz, subscription_plan string")
    changes = spark.createDataFrame([
        (10, 2, "free", "pro", ts(2024, 1, 10)),
        (20, 3, "free", "pro", ts(2024, 1, 5)),
        (21, 3, "pro", "enterprise", ts(2024, 1, 5)),
        (30, 4, "free", "pro", ts(2024, 1, 15)),
        (99, 5, "free", "pro", ts(2024, 1, 15)),  # unknown user: vanishes
    ], "change_id long, user_id long, old_plan string, new_plan string, change_date timestamp_ntz")
    return users, changes


def test_scd2_ties_and_order(spark):
    users, changes = scd_inputs(spark)
    rows = scd2.scd2_from_changes(users, changes).orderBy("user_id", "valid_from", "ord", "change_id").collect()
    got = [(r.user_id, r.subscription_plan, r.valid_from.day, r.valid_to.year if r.is_current else r.valid_to.day,
            r.is_current) for r in rows]
    assert got == [
        (1, "free", 1, 9999, True),
        (2, "free", 1, 10, False), (2, "pro", 10, 9999, True),
        (3, "free", 1, 5, False), (3, "pro", 5, 5, False), (3, "enterprise", 5, 9999, True),  # zero-length row kept
        (4, "pro", 15, 1, False), (4, "free", 1, 9999, True),  # T14: the change sorts ahead of registration
    ]
    hist = scd2.scd2_from_changes(users, changes)
    inv = dict(scd2.scd2_invariants(hist, users).collect())
    assert inv["zero_length"] == 1 and inv["current_rows"] == 0 and inv["gap_or_overlap"] == 0
    assert inv["before_registration"] == 1
    assert inv["chain_break"] == 1  # user 4: history ends on 'free', the source says 'pro' (T13/T14)


def test_retention_traps(spark):
    dim = spark.createDataFrame([
        (1, 1, ts(2024, 1, 5), True),   # active in Jan and Mar
        (2, 2, ts(2024, 1, 20), True),  # never active: only in the denominator
        (3, 3, ts(2024, 2, 10), True),  # active in January, before registering (month -1)
        (4, 4, ts(2024, 4, 2), True),   # registered after the end date, cohort has activity (T11)
        (5, 4, ts(2024, 2, 2), False),  # an older version of user 4 carries activity (T5)
    ], "account_sk long, user_id long, registration_date timestamp_ntz, is_current boolean")
    snap = spark.createDataFrame([
        (date(2024, 1, 7), 1), (date(2024, 3, 1), 1), (date(2024, 1, 9), 3), (date(2024, 3, 3), 5),
        (date(2024, 4, 9), 1),  # after the end date: ignored
    ], "snapshot_date date, account_sk long")
    out = {(r.cohort_month, r.month_diff): (r.active_user_count, r.total_users, r.retention_rate)
           for r in M.retention_long(dim, snap, date(2024, 3, 31)).collect()}
    # user 4 registered after the end date (T11) and is active in March through an old version (T5)
    assert out == {("2024-01", 0): (1, 2, 0.5), ("2024-01", 2): (1, 2, 0.5), ("2024-02", -1): (1, 1, 1.0),
                   ("2024-04", -1): (1, 1, 1.0)}
    # a look-back of 1 month from 2024-03-31 cuts the January cohort
    out2 = {r.cohort_month for r in M.retention_long(dim, snap, date(2024, 3, 31), lookback_months=1).collect()}
    assert out2 == {"2024-04"}


def test_retention_json_order(spark):
    long = spark.createDataFrame([("2024-01", "2024-01", 0, 3, 3, 1.0), ("2024-01", "2024-11", 10, 1, 3, 0.3333),
                                  ("2024-01", "2024-03", 2, 2, 3, 0.6667)],
                                 "cohort_month string, active_month string, month_diff int, "
                                 "active_user_count bigint, total_users bigint, retention_rate double")
    js = M.retention_json(long).collect()[0].struct_json
    assert js == '{"month_0":1.0,"month_2":0.6667,"month_10":0.3333}'


def test_replace_deletes_emptied_period(spark):
    existing = spark.createDataFrame([
        ("platform.daily.calls", "platform", "all", "day", "2024-01-09", 5.0),
        ("platform.daily.calls", "platform", "all", "day", "2024-01-10", 5.0),
        ("platform.daily.calls", "platform", "all", "day", "2024-01-11", 5.0),
        ("platform.monthly.mau", "platform", "all", "month", "2024-01", 9.0),
    ], schemas.DWS_METRIC_VALUE)
    new = spark.createDataFrame([("platform.daily.calls", "platform", "all", "day", "2024-01-10", 7.0)],
                                schemas.DWS_METRIC_VALUE)
    ctx = M.MetricContext.for_days(date(2024, 1, 10), date(2024, 1, 11))
    once = replace_rows(existing, new, M.daily_calls_scope(ctx))
    got = sorted((r.time_id, r.metric_value) for r in once.collect())
    assert got == [("2024-01", 9.0), ("2024-01-09", 5.0), ("2024-01-10", 7.0)]  # 01-11 is gone
    twice = replace_rows(once, new, M.daily_calls_scope(ctx))
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_scope_bounds_by_time_type(spark):
    ctx = M.MetricContext.for_days(date(2026, 4, 1), date(2026, 4, 30))
    store = spark.createDataFrame([
        ("platform.monthly.mau", "platform", "all", "month", "2026-03", 1.0),
        ("platform.monthly.mau", "platform", "all", "month", "2026-04", 1.0),
        ("platform.monthly.retention", "platform", "all", "month", "2024-01", 1.0),
        ("platform.monthly.retention", "platform", "all", "month", "2026-04", 1.0),
        ("platform.monthly.retention", "platform", "all", "month", "2026-05", 1.0),
        ("platform.daily.calls", "platform", "all", "day", "2026-03-31", 1.0),
        ("platform.daily.calls", "platform", "all", "day", "2026-04-30", 1.0),
        ("platform.daily.calls", "platform", "all", "day", "2026-05-01", 1.0),
    ], schemas.DWS_METRIC_VALUE)
    hit = lambda scope: sorted(r.time_id for r in store.filter(scope).collect())
    assert hit(M.mau_scope(ctx)) == ["2026-04"]              # month ids, not day bounds (T19)
    assert hit(M.retention_scope(ctx)) == ["2024-01", "2026-04"]  # everything up to the end month (T18)
    assert hit(M.daily_calls_scope(ctx)) == ["2026-04-30"]


def test_three_sigma_spike_flags_exactly_one(spark):
    rows = [("m1", date(2024, 1, d), 100.0 + (d % 3)) for d in range(1, 16)]
    rows[9] = ("m1", date(2024, 1, 10), 400.0)
    s = spark.createDataFrame(rows, "model_id string, snapshot_date date, mean_latency_ms double")
    flagged = [r.snapshot_date.day for r in qos.zscores(s, "model_id", "snapshot_date", "mean_latency_ms")
               .filter("is_alert").collect()]
    assert flagged == [10]


def test_money_rounding_ties(spark):
    df = spark.createDataFrame([(0.13545,), (0.13555,), (-0.00005,), (2.00005,)], "x double")
    got = [r.m for r in df.select(money4(F.col("x")).alias("m")).collect()]
    assert got == [Decimal("0.1355"), Decimal("0.1356"), Decimal("-0.0001"), Decimal("2.0001")]


def test_duplicate_dimension_key_is_refused(spark):
    import pytest

    dim = spark.createDataFrame([(1, "m1"), (2, "m1")], "model_sk long, model_id string")
    with pytest.raises(ValueError):
        facts.assert_unique(dim, ["model_id"], "dim_model")
    facts.assert_unique(dim, ["model_sk"], "dim_model")  # unique: passes


def _mini_fact(spark):
    rows = [  # request_id, account_sk, model_sk, status_sk, key_sk, request_time, latency, tokens…, revenue, cost
        (1, 10, 1, 1, 1, ts(2024, 1, 31, 23, 59, 59, 999999), 100, 1, 1, 0.0, 0.0),  # last microsecond of the range
        (2, 11, 1, 2, 1, ts(2024, 1, 5, 8, 0, 0), 100, 1, 1, 0.0, 0.0),              # account 11: errors only
        (3, 12, 1, 3, 1, ts(2023, 12, 31, 10, 0, 0), 100, 1, 1, 0.0, 0.0),           # before the month
        (4, 10, 1, 1, 1, ts(2024, 2, 1, 0, 0, 0), 100, 1, 1, 0.0, 0.0),              # just after the range
    ]
    fact = spark.createDataFrame(rows, schemas.FCT_API_REQUESTS)
    status = spark.createDataFrame([(1, 200, "NONE", False), (2, 429, "client_error", True),
                                    (3, 302, "NONE", False)], schemas.DIM_STATUS_CODE)
    return fact, status


def test_t9_t23_inclusive_day_bounds_and_missing_days(spark):
    from metricmart.operators.snapshots import account_daily_snapshot

    fact, _ = _mini_fact(spark)
    ctx = M.MetricContext.for_days(date(2024, 1, 1), date(2024, 1, 31))
    days = {r.time_id: r.metric_value for r in M.daily_platform_calls(fact, ctx).collect()}
    assert days == {"2024-01-05": 1.0, "2024-01-31": 1.0}  # 23:59:59.999999 is inside; no rows for empty days
    snap = account_daily_snapshot(fact)
    mau = {r.time_id: r.metric_value for r in M.mau(snap, ctx).collect()}
    assert mau == {"2024-01": 2.0}


def test_t6_mau_counts_error_only_accounts_but_mau_success_does_not(spark):
    from metricmart.operators.snapshots import account_daily_snapshot
    from metricmart.plans import growth

    fact, status = _mini_fact(spark)
    ctx = M.MetricContext.for_days(date(2024, 1, 1), date(2024, 1, 31))
    assert M.mau(account_daily_snapshot(fact), ctx).first().metric_value == 2.0      # accounts 10 and 11
    assert growth.mau_success(fact, status, ctx).first().metric_value == 1.0        # account 10 only


def test_t7_partial_first_month_and_alignment(spark):
    from metricmart.operators.snapshots import account_daily_snapshot

    fact, _ = _mini_fact(spark)
    snap = account_daily_snapshot(fact)
    ctx = M.MetricContext.for_days(date(2024, 1, 10), date(2024, 2, 29))
    as_coded = {r.time_id: r.metric_value for r in M.mau(snap, ctx).collect()}
    aligned = {r.time_id: r.metric_value for r in M.mau(snap, ctx, align_to_month=True).collect()}
    assert as_coded == {"2024-01": 1.0, "2024-02": 1.0}   # account 11 (Jan 5) falls before the start
    assert aligned == {"2024-01": 2.0, "2024-02": 1.0}


def test_t26_error_rule_differs_between_etl_and_guide(spark):
    fact, status = _mini_fact(spark)
    model = spark.createDataFrame([(1, "m1", "p", 1.0, 1.0, 1.0, 1.0)], schemas.DIM_MODEL)
    ctx = M.MetricContext.for_days(date(2023, 12, 1), date(2024, 2, 29))
    r = qos.error_rate(fact, model, status, ctx).first()
    assert (r.requests, r.errors) == (4, 2)  # status 302 is not an error for the ETL (>= 400) but is for the guide
    flags = {row.http_status: row.is_error for row in status.collect()}
    assert flags == {200: False, 429: True, 302: False}


def test_tag_upsert_keeps_the_newest_row_per_key(spark):
    from metricmart.plans.customers import upsert_tags

    old = spark.createDataFrame([(1, "segment_label", "loyal", None, ts(2024, 1, 1)),
                                 (2, "segment_label", "at_risk", None, ts(2024, 1, 1))], schemas.ADS_ACCOUNT_TAGS)
    new = spark.createDataFrame([(1, "segment_label", "champions", None, ts(2024, 2, 1)),
                                 (1, "burn_rate", "-3.5000", None, ts(2024, 2, 1))], schemas.ADS_ACCOUNT_TAGS)
    got = {(r.account_sk, r.tag_key): r.tag_value
           for r in upsert_tags(old, new, ["account_sk", "tag_key"]).collect()}
    assert got == {(1, "segment_label"): "champions", (2, "segment_label"): "at_risk",
                   (1, "burn_rate"): "-3.5000"}
