"""Every registered query against its DuckDB twin on the driver's tables (the correctness gate)."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from paths import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark",
          "labels", "conversations"]
SF = os.environ.get("ORACLE_SF_DIR", SF_SMALL)


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "as_tuple"):
        return float(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in recs), key=lambda t: tuple(map(str, t)))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_is_registered_with_an_oracle():
    assert not {q for q in set(E.queries()) - set(E.oracle_sql()) if q.startswith("q_")}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["snapshot_date", "account_sk", "daily_requests", "sum_prompt_tokens",
                          "sum_completion_tokens", "daily_revenue_usd", "daily_cost_usd"]


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    want_cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(want_cols)
    assert _rows(df.columns, got) == _rows(want_cols, want)


def test_kmeans_of_few_accounts(spark):
    """Fewer accounts than clusters, and none."""
    from metricmart.plans import customers
    from metricmart.plans import queries as Q

    wh = Q.warehouse(spark, SF)
    some = [r[0] for r in wh.fct_api_requests.select("account_sk").distinct().orderBy("account_sk").limit(2).collect()]
    for keep, clusters in ((some, {0, 1}), ([], set())):
        rows = customers.kmeans_segments(wh.fct_api_requests.filter(wh.fct_api_requests.account_sk.isin(keep)), wh.dim_status_code, Q.CTX).collect()
        assert len(rows) == len(keep) and {r.cluster for r in rows} <= clusters
