"""The metric store and the runner when things go wrong, and when a run touches only a part."""

import uuid
from datetime import date

import pytest
from pyspark.sql import functions as F

from metricmart import schemas
from metricmart.operators.store import MetricStore
from metricmart.plans import metrics as M
from metricmart.plans import queries as Q
from metricmart.plans.runner import MetricSpec, run_metrics
from metricmart.session import checkpoint_dir

SF = "/root/testdata/sf0.001"
VALUE = "dws_metric_value"


@pytest.fixture()
def store(spark):
    return MetricStore(spark, f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex[:8]}")


def rows(spark, code, days, value):
    return spark.createDataFrame([(code, "platform", "all", "day", d, float(value)) for d in days], schemas.DWS_METRIC_VALUE)


def test_failed_write_leaves_nothing_in_the_way(spark, store):
    store.replace(VALUE, rows(spark, "a", ["2024-01-01"], 1), F.col("metric_code") == "a")
    broken = rows(spark, "a", ["2024-01-01"], 2).withColumn("metric_value", F.raise_error(F.lit("broken")).cast("double"))
    with pytest.raises(Exception, match="broken"):
        store.replace(VALUE, broken, F.col("metric_code") == "a")
    assert [r.metric_value for r in store.read(VALUE).collect()] == [1.0]
    assert store.replace(VALUE, rows(spark, "a", ["2024-01-01"], 3), F.col("metric_code") == "a") == 2
    assert [r.metric_value for r in store.read(VALUE).collect()] == [3.0]


def test_kept_rows_keep_their_time_and_their_folder(spark, store):
    store.replace(VALUE, rows(spark, "a", ["2024-01-01", "2024-01-02"], 1).union(rows(spark, "b", ["2024-01-01"], 1)), F.lit(True))
    first = {(r.metric_code, r.time_id): r.created_at for r in store.read(VALUE).collect()}
    before = store.log(VALUE).payload(1)
    store.replace(VALUE, rows(spark, "a", ["2024-01-02"], 2), (F.col("metric_code") == "a") & (F.col("time_id") == "2024-01-02"))
    now = {(r.metric_code, r.time_id): (r.metric_value, r.created_at) for r in store.read(VALUE).collect()}
    assert now["a", "2024-01-01"] == (1.0, first["a", "2024-01-01"]) and now["b", "2024-01-01"] == (1.0, first["b", "2024-01-01"])
    assert now["a", "2024-01-02"][0] == 2.0 and now["a", "2024-01-02"][1] > first["a", "2024-01-02"]
    after = store.log(VALUE).payload(2)
    assert after["b|day-2024-01"] == before["b|day-2024-01"] and after["a|day-2024-01"] != before["a|day-2024-01"]


def test_a_rerun_writes_only_its_periods(spark, store):
    """Two years of days under one code; two days anew: one month's file is written, the rest stays."""
    days = [r.d for r in spark.sql("SELECT string(d) AS d FROM (SELECT explode(sequence(date'2023-01-01', date'2024-12-31')) AS d)").collect()]
    store.replace(VALUE, rows(spark, "a", days, 1).coalesce(1), F.col("metric_code") == "a")
    before = store.log(VALUE).payload(1)
    assert len(before) == 24 and sum(e["rows"] for e in before.values()) == len(days)
    scope = (F.col("metric_code") == "a") & F.col("time_id").between("2024-03-05", "2024-03-06")
    store.replace(VALUE, rows(spark, "a", ["2024-03-05"], 2), scope)  # (the 6th goes)
    after = store.log(VALUE).payload(2)
    assert {k for k in after if after[k] != before[k]} == {"a|day-2024-03"}
    entry = after["a|day-2024-03"]
    assert (entry["rows"], entry["first"], entry["last"]) == (30, "2024-03-01", "2024-03-31")
    written = spark.read.parquet(f"{store.root}/{VALUE}/{entry['run']}")
    assert written.count() == 30 and len(written.inputFiles()) == 1
    # reads prune by the manifest: one entry's file is opened
    part = store.read(VALUE, ["a"], "2024-03-02", "2024-03-09")
    assert part.count() == 7 and len(part.inputFiles()) <= 1
    assert store.read(VALUE).count() == len(days) - 1 and store.read(VALUE, ["b"]).count() == 0


def test_two_writers_one_wins(spark, store):
    """Both start from one version; the slower one is refused and nothing of its rows is seen."""
    from metricmart.operators.commits import Conflict

    store.append(VALUE, rows(spark, "a", ["2024-01-01"], 1))
    other = MetricStore(spark, store.root)
    slow = rows(spark, "b", ["2024-01-01"], 2)
    log = other.log(VALUE)

    class Late(type(log)):
        def commit(self, base, payload):
            store.append(VALUE, rows(spark, "c", ["2024-01-01"], 3))  # the other writer gets in first
            return super().commit(base, payload)

    other.log = lambda table: Late(spark, f"{other.root}/{table}")
    with pytest.raises(Conflict):
        other.append(VALUE, slow)
    assert {r.metric_code for r in store.read(VALUE).collect()} == {"a", "c"} and store.log(VALUE).versions() == [1, 2]
    unnamed = set(store.files.names(f"{store.root}/{VALUE}")) - {"_log"} - {e["run"] for v in (1, 2) for e in store.log(VALUE).payload(v).values()}
    assert len(unnamed) == 1
    store.retire(VALUE)
    assert not unnamed & set(store.files.names(f"{store.root}/{VALUE}"))  # its writer can't publish any more


def test_one_of_many_threads_gets_a_version(spark, store):
    from concurrent.futures import ThreadPoolExecutor

    from metricmart.operators.commits import Conflict

    log = store.log("any")

    def attempt(i):
        try:
            return log.commit(0, {"writer": i})
        except Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(attempt, range(8)))
    assert got.count(1) == 1 and got.count(None) == 7 and log.newest() == (1, {"writer": got.index(1)})
    assert log.files.names(f"{log.root}/_log") == ["v000001.json"]  # no leftovers


def test_rename_without_overwrite(spark, store):
    """The form for file systems other than the local one."""
    from metricmart.operators.commits import Conflict

    log = store.log("renamed")
    log.files._link = log.files._rename
    assert log.commit(0, {"n": 1}) == 1
    with pytest.raises(Conflict):
        log.commit(0, {"n": 2})
    assert log.newest() == (1, {"n": 1})


def test_versions_of_any_number_of_digits(spark, store):
    log = store.log("long")
    assert log.commit(999_999, {"n": 1}) == 1_000_000 and log.newest() == (1_000_000, {"n": 1})
    assert log.commit(1_000_000, {"n": 2}) == 1_000_001 and log.versions() == [1_000_000, 1_000_001]


def test_a_load_that_dies_leaves_the_old_one(spark, monkeypatch):
    """Killed after any of its steps, a load changes nothing; one overtaken by another is refused."""
    from metricmart.operators.commits import CommitLog, Conflict
    from metricmart.plans.warehouse import Warehouse

    path = f"{checkpoint_dir(spark)}/loads-{uuid.uuid4().hex[:8]}"
    with pytest.raises(FileNotFoundError):
        Warehouse.current(spark, path)
    sources = Q.warehouse(spark, SF).sources
    counts = Warehouse.load(sources, path)
    first = Warehouse.current(spark, path)
    for owner, step, when in ((Warehouse, "_stored", ("fct_api_requests",)), (CommitLog, "commit", (None,))):
        for name in when:
            with monkeypatch.context() as m:
                real = getattr(owner, step)

                def dies(self, *args, real=real, name=name, **kw):
                    if name in (None, args[0]):
                        raise SystemError("killed")
                    return real(self, *args, **kw)

                m.setattr(owner, step, dies)
                with pytest.raises(SystemError):
                    Warehouse.load(sources, path)
            assert Warehouse.current(spark, path) == first
    with monkeypatch.context() as m:
        real = CommitLog.commit
        m.setattr(CommitLog, "commit", lambda self, base, payload: (real(self, base, dict(payload, folder="load-of-another")), real(self, base, payload))[1])
        with pytest.raises(Conflict):
            Warehouse.load(sources, path)
    assert Warehouse.current(spark, path).endswith("load-of-another")
    CommitLog(spark, path).commit(2, {"folder": first.rsplit("/", 1)[1], "counts": counts})
    assert Warehouse.load(sources, path) == counts and Warehouse.current(spark, path) != first
    Warehouse.retire(spark, path, keep=1)
    left = [n for n in CommitLog(spark, path).files.names(path) if n.startswith("load-")]
    assert left == [Warehouse.current(spark, path).rsplit("/", 1)[1]]


def test_emptied_code_goes_and_append_adds(spark, store):
    store.append(VALUE, rows(spark, "a", ["2024-01-01"], 1))
    store.append(VALUE, rows(spark, "b", ["2024-01-01"], 1))
    assert store.read(VALUE).count() == 2
    store.replace(VALUE, rows(spark, "c", ["2024-01-01"], 1), F.col("metric_code") == "a")
    assert {r.metric_code for r in store.read(VALUE).collect()} == {"b", "c"} and "a|day-2024-01" not in store.log(VALUE).payload(3)
    store.retire(VALUE, keep=1)
    assert {r.metric_code for r in store.read(VALUE).collect()} == {"b", "c"} and store.log(VALUE).versions() == [3]


def test_second_writer_of_a_version_is_refused(spark, store):
    store.append(VALUE, rows(spark, "a", ["2024-01-01"], 1))
    with pytest.raises(RuntimeError, match="another writer"):
        store.log(VALUE).commit(0, {})
    assert store.read(VALUE).count() == 1


def test_metric_that_fails_while_computed_is_left_out(spark, store):
    good = MetricSpec("a", "platform", VALUE, lambda i, c: rows(spark, "a", ["2024-01-01"], 1), lambda c: F.col("metric_code") == "a")
    bad = MetricSpec("b", "platform", VALUE, lambda i, c: rows(spark, "b", ["2024-01-01"], 1).withColumn(
        "metric_value", F.raise_error(F.concat(F.lit("x" * 600), F.lit("the end"))).cast("double")), lambda c: F.col("metric_code") == "b")
    store.append(VALUE, rows(spark, "b", ["2024-01-01"], 7))
    for kept in (store, None):
        tables, report = run_metrics([bad, good], {"any": spark.range(1)}, Q.EVENTS_MONTH, store=kept)
        status = {r.metric_code: r for r in report.collect()}
        assert status["a"].status == "ok" and status["b"].status == "failed" and "the end" in status["b"].error
        assert ("a", 1.0) in {(r.metric_code, r.metric_value) for r in tables[VALUE].collect()}
    assert {(r.metric_code, r.metric_value) for r in store.read(VALUE).collect()} == {("a", 1.0), ("b", 7.0)}


def test_scoped_run_replaces_only_its_entities(spark, store):
    wh = Q.warehouse(spark, SF)
    inputs = dict(Q._inputs(spark, SF), dim_model=wh.dim_model, fct_model_daily_snapshot=wh.fct_model_daily_snapshot,
                  users=wh.sources.users, dim_status_code=wh.dim_status_code)
    specs = [s for s in Q.all_specs() if s.metric_code in ("account.monthly.*", "model.daily.*", M.DAILY_CALLS)]
    run_metrics(specs, inputs, Q.EVENTS_MONTH, store=store)
    before = sorted(map(tuple, store.read(VALUE).drop("created_at").collect()))
    user = inputs["dim_account"].join(inputs["fct_api_requests"], "account_sk").select("user_id").first().user_id
    for scope in ({"model_ids": ["m1"]}, {"user_ids": [user]}):
        ctx = M.MetricContext.for_days(date(2024, 1, 1), date(2024, 1, 30), **scope)
        _, report = run_metrics(specs, inputs, ctx, store=store)
        assert {r.status for r in report.collect()} == {"ok", "skipped"}
        assert sorted(map(tuple, store.read(VALUE).drop("created_at").collect())) == before
    stamps = store.read(VALUE).filter("metric_code = 'model.daily.calls'").groupBy("entity_id").agg(F.max("created_at").alias("at")).collect()
    assert max(stamps, key=lambda r: r.at).entity_id == "m1"
