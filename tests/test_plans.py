"""Plan checks: no Python in the hot path, broadcast only on bounded sides, pushdown and pruning."""

from paths import SF_SMALL
from metricmart.plans import queries as Q


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_in_warehouse_queries(spark):
    for name in ("q_fct_api_requests", "q_account_daily_snapshot", "q_model_daily_snapshot", "q_retention_long",
                 "q_scd2_dim_account", "q_p99_latency", "q_mau", "q_daily_platform_calls"):
        p = plan_of(Q.QUERIES[name](spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p, name


def test_fact_build_broadcasts_only_dimensions(spark):
    wh = Q.warehouse(spark, "/root/testdata/sf0.01")
    from metricmart.operators import facts

    f = facts.build_fct_requests(wh.clean_logs, wh.sources.api_keys, wh.dim_account, wh.dim_api_key,
                                 wh.dim_model, wh.dim_status_code)
    p = plan_of(f)
    assert p.count("BroadcastHashJoin") >= 3  # key lookup, model, status: all size-checked dimensions
    assert "SortMergeJoin" not in p


def test_range_scan_prunes_partitions_and_pushes_filters(spark):
    df = Q.q_fact_range_scan(spark, SF_SMALL)
    p = plan_of(df)
    assert "PartitionFilters: [isnotnull(request_date" in p
    assert "PushedFilters: [IsNotNull(request_time), GreaterThanOrEqual(request_time" in p


def test_column_pruning_reaches_the_scan(spark):
    df = Q.q_mau(spark, SF_SMALL)
    p = plan_of(df)
    # two of seven snapshot columns are read; the date bound prunes date partitions
    assert "ReadSchema: struct<account_sk:bigint>" in p
    assert "PartitionFilters: [isnotnull(snapshot_date" in p


def test_scd2_shuffles_once_by_user(spark):
    from metricmart.operators.scd2 import scd2_from_changes

    s = Q.warehouse(spark, SF_SMALL).sources
    p = plan_of(scd2_from_changes(s.users, s.plan_changes))
    # all window work shares one hash partitioning on user_id
    assert p.count("Window [") >= 1


def test_single_partition_exchanges_only_carry_partial_aggregates(spark):
    """No single-partition exchange over fact-sized rows: what crosses one is a partial
    aggregate (one row per task and group) or the sequence operator's statistics (one row per
    partition) — never raw rows."""
    for name in ("q_dq_stats", "q_alert_count", "q_scd2_invariants", "q_orphans", "q_mau",
                 "q_daily_platform_calls", "q_p99_latency", "q_retention_long", "q_constraint_report"):
        df = Q.QUERIES[name](spark, SF_SMALL)
        df.collect()
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                child = lines[i + 1]
                partial = "HashAggregate" in child and ("partial_" in child or "keys=[]" in child)
                per_partition_stats = "HashAggregate(keys=[_sq_pid" in child  # one row per partition
                assert partial or per_partition_stats, (name, child.strip()[:120])
