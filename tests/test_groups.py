"""Order statistics, tags and rules on skewed groups."""

import random
import re
import uuid
from datetime import datetime

from paths import SF_SMALL
from pyspark.sql import Window
from pyspark.sql import functions as F

from metricmart import schemas
from metricmart.operators import constraints
from metricmart.operators.constraints import Rules
from metricmart.operators.sequence import position_in_group, running_in_group
from metricmart.plans import customers
from metricmart.plans import queries as Q
from metricmart.session import checkpoint_dir


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark):
    rng = random.Random(9)
    rows = [(1 if i % 3 == 0 else rng.randrange(50), rng.choice([5, 5, 7, None, 9, rng.randrange(100)]), i) for i in range(4000)]
    return spark.createDataFrame(rows, "g long, v long, id long").repartition(6)


def test_positions_and_ranks_equal_windows(spark):
    df = skewed(spark)
    w = Window.partitionBy("g").orderBy(F.col("v").desc())
    want = {(r.id, r.rank, r.n) for r in df.select("id", F.rank().over(w).alias("rank"), F.row_number().over(Window.partitionBy("g").orderBy(F.col("v").desc(), "id")).alias("n")).collect()}
    got = position_in_group(position_in_group(df, ["g"], [F.col("v").desc(), "id"], "rank", ties=["v"]), ["g"], [F.col("v").desc(), "id"], "n")
    assert got.columns == ["g", "v", "id", "rank", "n"]
    assert {(r.id, r["rank"], r.n) for r in got.collect()} == want


def test_running_totals_equal_windows(spark):
    df = skewed(spark).filter("v IS NOT NULL")
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = {(r.id, r.c, r.t) for r in df.select("id", F.sum("v").over(w).alias("c"), F.sum("v").over(Window.partitionBy("g")).alias("t")).collect()}
    assert {(r.id, r.c, r.c_total) for r in running_in_group(df, ["g"], ["id"], "v", "c").collect()} == want


def test_no_window_holds_an_account_or_a_model(spark):
    wh = Q.warehouse(spark, SF_SMALL)
    from metricmart.plans import qos

    board = customers.key_leaderboard(wh.fct_api_requests, wh.dim_api_key, Q.CTX)
    p99 = qos.p99_latency(wh.fct_api_requests, wh.dim_model, Q.CTX)
    for df in (board, p99):
        for line in re.findall(r"Window \[.*", plan_of(df)):
            assert "account_sk" not in line and "model_id" not in line, line


def test_constraint_report_reads_each_table_once(spark):
    """The logs and the fact are scanned by one branch each."""
    wh = Q.warehouse(spark, SF_SMALL)
    s = wh.sources
    tables = {"users": s.users, "logs": s.logs}
    once = {n: len(re.findall(r"FileScan parquet", plan_of(df.select("*")))) for n, df in tables.items()}
    rules = {r.table: r for r in constraints.source_rules(s.users, s.api_keys, s.plan_changes, s.logs, s.billing, s.models)}
    plan = plan_of(constraints.check(rules["request_logs_raw"]))
    assert plan.count("/events.parquet") <= once["logs"]
    fact = constraints.warehouse_rules({t: getattr(wh, t) for t in wh.TABLES})
    plan = plan_of(constraints.check(next(r for r in fact if r.table == "fct_api_requests")))
    assert len(re.findall(r"FileScan parquet \[request_id", plan)) == 1


def test_rules_count_violations(spark):
    t = "a long, b string, c int, d int"
    rows = spark.createDataFrame([(1, "x", 1, 1), (1, "y", None, 2), (2, "y", 3, None), (None, None, 9, 1), (3, "z", 2, 7), (None, "w", 2, 7)], t)
    parent = spark.createDataFrame([(1,), (1,), (2,)], "p int")
    got = {r.rule: r.violations for r in constraints.check(Rules("t", rows, ["a"], ["b"], ["b", "c"], {"c": [1, 2, 3]}, references=[("d", parent, "p")])).collect()}
    assert got == {"primary_key": 4, "unique:b": 2, "not_null:b": 1, "not_null:c": 1, "domain:c": 1, "foreign_key:d": 2}
    empty = {r.rule: r.violations for r in constraints.check(Rules("t", rows.limit(0), ["a", "b"], [], ["c"], references=[("d", parent, "p")])).collect()}
    assert empty == {"primary_key": 0, "not_null:c": 0, "foreign_key:d": 0}


def test_tag_pool_keeps_what_did_not_change(spark):
    t = lambda d: datetime(2024, 1, d)
    row = lambda sk, k, v, d: (sk, k, v, None, t(d))
    frame = lambda *r: spark.createDataFrame(list(r), schemas.ADS_ACCOUNT_TAGS)
    pool = customers.TagPool(spark, f"{checkpoint_dir(spark)}/tags-{uuid.uuid4().hex[:8]}", "ads_account_tags", buckets=8)
    pool.apply(frame(row(1, "a", "x", 1), row(1, "b", "x", 1), row(2, "a", "x", 1)))
    pool.apply(frame(row(1, "a", "x", 5), row(1, "b", "y", 5), row(3, "a", "z", 5)))
    pool.apply(frame(row(1, "b", "late", 2)))  # older than what is stored
    assert {(r.account_sk, r.tag_key, r.tag_value, r.updated_at.day) for r in pool.read().collect()} == {
        (1, "a", "x", 1), (1, "b", "y", 5), (2, "a", "x", 1), (3, "a", "z", 5)}
    runs = pool.state()[1]["runs"]
    assert len(set(runs.values())) > 1  # buckets that a run didn't touch weren't written


def test_struct_json_escapes(spark):
    rfm = spark.createDataFrame([(1, 5, 4, 3, 'say "hi"\n')], "account_sk long, r_score int, f_score int, m_score int, segment string")
    board = spark.createDataFrame([(1, 2, 1)], "account_sk long, key_id long, token_rank int")
    forecast = spark.createDataFrame([(1.5,), (2.25,)], "predicted_profit_usd double")
    import json

    got = {r.struct_type: json.loads(r.struct_json) for r in customers.struct_metrics(board, rfm, forecast, Q.CTX).collect()}
    assert got == {"rank": {"account_sk": 1, "rank": 1}, "segment": {"r": 5, "f": 4, "m": 3, "segment": 'say "hi"\n'},
                   "forecast": {"horizon_days": 2, "forecast_profit_usd": 3.75}}
