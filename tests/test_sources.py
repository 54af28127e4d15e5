"""The extract path: sources written as OLTP exports and read back by the declared-schema loader
build the same warehouse as the adapters."""

import uuid

from pyspark.sql import functions as F

from metricmart.plans import queries as Q
from metricmart.plans.warehouse import Warehouse
from metricmart.session import checkpoint_dir
from metricmart.sources import loader

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(map(tuple, df.collect()))


def test_warehouse_from_loaded_sources_equals_adapter_build(spark):
    base = f"{checkpoint_dir(spark)}/oltp-{uuid.uuid4().hex[:8]}"
    src = Q.warehouse(spark, SF).sources
    for fmt in ("parquet", "csv"):
        loader.write_sources(src, f"{base}/{fmt}", fmt)
        wh = Warehouse(loader.load_sources(spark, f"{base}/{fmt}", fmt))
        ref = Q.warehouse(spark, SF)
        assert _rows(wh.dim_account) == _rows(ref.dim_account), fmt
        assert _rows(wh.fct_api_requests) == _rows(ref.fct_api_requests), fmt
        assert _rows(wh.fct_account_daily_snapshot) == _rows(ref.fct_account_daily_snapshot), fmt


def test_reference_catalogue_builds_the_model_dimension(spark):
    from metricmart import schemas
    from metricmart.operators.dims import build_dim_model

    models = loader.reference_models(spark)
    assert models.schema == schemas.AI_MODELS
    dim = build_dim_model(models)
    rows = dim.orderBy("model_sk").collect()
    assert len(rows) == 12 and [r.model_sk for r in rows] == list(range(1, 13))
    assert sorted(r.model_id for r in rows) == [r.model_id for r in rows]  # keys in model_id order


def test_cluster_conf_scales_partitions():
    from metricmart.session import cluster_conf

    small, big = cluster_conf(10 << 30), cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600  # 100 TB / 256 MB: no hidden cap
    assert int(cluster_conf(100 << 40, 2048)["spark.sql.shuffle.partitions"]) == 51_200
    assert big["spark.sql.adaptive.enabled"] == "true" and big["spark.sql.session.timeZone"] == "UTC"


def test_entity_scope_accepts_account_and_user(spark):
    from datetime import date

    from metricmart import schemas
    from metricmart.operators.store import in_scope
    from metricmart.plans import metrics as M
    from metricmart.plans.runner import scoped

    dim = spark.createDataFrame([(7, 1), (70, 1), (8, 2)], "account_sk long, user_id long")
    ctx = M.MetricContext.for_days(date(2024, 1, 1), date(2024, 1, 31), user_ids=[1])
    _, entities = scoped({"dim_account": dim}, ctx)
    assert {tuple(r) for r in entities.collect()} == {("account", "7"), ("account", "70"), ("user", "1")}
    store = spark.createDataFrame([
        ("account.monthly.calls", "account", "7", "month", "2024-01", 1.0),
        ("account.monthly.calls", "account", "8", "month", "2024-01", 1.0),
        ("user.monthly.calls", "user", "1", "month", "2024-01", 1.0),
        ("user.monthly.calls", "user", "7", "month", "2024-01", 1.0),
    ], schemas.DWS_METRIC_VALUE)
    for code, kind, hit in (("account.monthly.calls", "account", "7"), ("user.monthly.calls", "user", "1")):
        rows = in_scope(store, M.metric_scope(code, ctx, ("month",), kind), entities).filter("_hit").collect()
        assert [(r.metric_code, r.entity_id) for r in rows] == [(code, hit)]


def test_a_large_scope_stays_a_relation(spark):
    """100,000 named users plan as joins: no literal list, nothing collected."""
    from datetime import date

    from metricmart.operators.store import replace_rows
    from metricmart.plans import metrics as M
    from metricmart.plans.runner import scoped

    dim = spark.range(300_000).selectExpr("id AS account_sk", "id AS user_id")
    for users in (spark.range(0, 200_000, 2), list(range(0, 200_000, 2))):
        _, entities = scoped({"dim_account": dim}, M.MetricContext.for_days(date(2024, 1, 1), date(2024, 1, 31), user_ids=users))
        rows = spark.range(1000).selectExpr("'a' AS metric_code", "'account' AS entity_type", "string(id) AS entity_id", "'month' AS time_type", "'2024-01' AS time_id", "1.0D AS metric_value")
        kept = replace_rows(rows, rows.limit(0), F.col("metric_code") == "a", entities)
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" in plan and " IN (" not in plan and " INSET " not in plan and len(plan) < 20_000
        assert kept.count() == 500


def test_sources_register_as_sql_views(spark):
    src = Q.warehouse(spark, SF).sources
    src.register_views("t_src_")
    n = spark.sql("SELECT count(*) AS n FROM t_src_logs WHERE latency_ms > 0").first().n
    assert n == src.logs.filter("latency_ms > 0").count()


def test_deferred_sources_build_once_on_first_use(spark):
    from metricmart.sources.loader import DeferredSources

    calls = []

    def builder(name):
        def build():
            calls.append(name)
            return spark.range(3).withColumnRenamed("id", name)
        return build

    src = DeferredSources({n: builder(n) for n in ("users", "plan_changes", "api_keys", "models", "logs",
                                                   "billing")})
    assert calls == []
    assert src.users.columns == ["users"] and src.users.columns == ["users"]
    assert calls == ["users"]  # built once, then kept
    src.register_views("t_def_")
    assert sorted(calls) == sorted(["users", "plan_changes", "api_keys", "models", "logs", "billing"])


def test_run_concurrently_keeps_input_order():
    import time

    from metricmart.session import run_concurrently

    out = run_concurrently([lambda i=i: (time.sleep(0.01 * (5 - i)), i)[1] for i in range(5)])
    assert out == [0, 1, 2, 3, 4]


def test_jdbc_reads_are_split(spark, monkeypatch):
    """The options that reach Spark's reader (no database here)."""
    import pytest
    from pyspark.sql import DataFrameReader

    from metricmart import schemas
    from metricmart.sources.loader import Split, read_table

    asked, empty = {}, spark.createDataFrame([], schemas.REQUEST_LOGS_RAW)
    monkeypatch.setattr(DataFrameReader, "options", lambda self, **kw: (asked.update(kw), self)[1])
    monkeypatch.setattr(DataFrameReader, "load", lambda self, *a, **kw: empty)
    monkeypatch.setattr(DataFrameReader, "jdbc", lambda self, url, table, predicates, properties: (asked.update(url=url, table=table, predicates=predicates, properties=properties), empty)[1])
    options = {"url": "jdbc:some:db", "user": "u"}
    read_table(spark, "", "request_logs_raw", "jdbc", options, Split("request_id", 1, 9000, 12))
    assert {k: asked[k] for k in ("dbtable", "partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "dbtable": "request_logs_raw", "partitionColumn": "request_id", "lowerBound": "1", "upperBound": "9000", "numPartitions": "12"}
    read_table(spark, "", "request_logs_raw", "jdbc", options, Split(predicates=("request_id % 2 = 0", "request_id % 2 = 1")))
    assert asked["predicates"] == ["request_id % 2 = 0", "request_id % 2 = 1"] and asked["properties"] == {"user": "u"}
    for bad in ({"column": "a"}, {"column": "a", "lower": 1, "upper": 2, "predicates": ("x",)}, {"column": "a", "lower": 1, "upper": 2, "partitions": 0}):
        with pytest.raises(ValueError):
            Split(**bad)


def test_bookmarks_move_with_the_load(spark):
    from datetime import datetime

    from metricmart.sources.bookmarks import Bookmarks, Growing

    marks = Bookmarks(spark, f"{checkpoint_dir(spark)}/marks-{uuid.uuid4().hex[:8]}", {"a": Growing("id"), "b": Growing("at", 1)})
    rows = spark.createDataFrame([(i, datetime(2024, 1, i)) for i in range(1, 11)], "id long, at timestamp_ntz")
    assert marks.since(rows, "a").count() == 10
    base, _ = marks.marks()
    marks.advance(base, {"a": marks.reached(rows.filter("id <= 4"), "a"), "b": marks.reached(rows.filter("id <= 4"), "b")})
    assert [r.id for r in marks.since(rows, "a").collect()] == [5, 6, 7, 8, 9, 10]
    assert [r.id for r in marks.since(rows, "b").collect()] == [3, 4, 5, 6, 7, 8, 9, 10]  # a day again
    marks.advance(1, {"a": None, "b": datetime(2024, 1, 9)})
    assert marks.marks() == (2, {"a": 4, "b": datetime(2024, 1, 9)})


def test_own_sql_metrics_are_validated_and_published(spark):
    from metricmart.operators.store import MetricStore
    from metricmart.plans import metrics as M
    from metricmart.plans.runner import run_metrics
    from metricmart.plans.sql_mode import sql_spec

    text = "SELECT 'own' AS metric_code, 'platform' AS entity_type, 'all' AS entity_id, 'day' AS time_type, '2024-01-01' AS time_id, double(count(*)) AS metric_value FROM {things} WHERE at <= :end"
    scope = lambda c: F.col("metric_code") == "own"
    specs = [sql_spec("own", "platform", "dws_metric_value", text, scope), sql_spec("odd", "platform", "dws_metric_value", "SELECT 1 AS x", scope),
             sql_spec("bad", "platform", "dws_metric_value", "SELECT nothing FROM {nowhere}", scope)]
    things = spark.sql("SELECT timestamp_ntz'2024-01-03 10:00:00' AS at UNION ALL SELECT timestamp_ntz'2025-01-03 10:00:00'")
    store = MetricStore(spark, f"{checkpoint_dir(spark)}/own-{uuid.uuid4().hex[:8]}")
    _, report = run_metrics(specs, {"things": things}, Q.EVENTS_MONTH, store=store)
    status = {r.metric_code: r for r in report.collect()}
    assert status["own"].status == "ok" and status["odd"].status == status["bad"].status == "failed" and "missing column" in status["odd"].error
    assert [(r.metric_code, r.metric_value) for r in store.read("dws_metric_value").collect()] == [("own", 1.0)]
