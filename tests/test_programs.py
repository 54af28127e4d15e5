"""The two user programs end to end: ETL load from an OLTP export, then the metric calculation."""

import uuid

from metricmart.operators.store import MetricStore
from metricmart.plans import metrics as M
from metricmart.plans import queries as Q
from metricmart.plans.programs import run_calculation, run_etl
from metricmart.session import checkpoint_dir
from metricmart.sources import loader

SF = "/root/testdata/sf0.001"


def test_etl_then_calculation(spark):
    base = f"{checkpoint_dir(spark)}/programs-{uuid.uuid4().hex[:8]}"
    src = Q.warehouse(spark, SF).sources
    loader.write_sources(src, f"{base}/oltp", "parquet")

    etl = run_etl(spark, f"{base}/oltp", f"{base}/dw")
    assert etl["dq"] == {r.check_name: r.value for r in Q.q_dq_stats(spark, SF).collect()}
    assert etl["loaded"]["fct_api_requests"] == Q.q_fct_api_requests(spark, SF).count()

    report = run_calculation(spark, f"{base}/dw", f"{base}/store", Q.EVENTS_MONTH, src.users)
    assert {r.status for r in report.collect()} == {"ok"}
    stored = MetricStore(spark, f"{base}/store").read("dws_metric_value")
    assert sorted(map(tuple, stored.drop("created_at").collect())) == sorted(map(tuple, Q.q_run_all_metrics(spark, SF).collect()))
    # a second calculation run replaces, it does not add
    run_calculation(spark, f"{base}/dw", f"{base}/store", Q.EVENTS_MONTH, src.users)
    again = MetricStore(spark, f"{base}/store").read("dws_metric_value")
    assert again.count() == stored.count()
