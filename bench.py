"""Benchmark: every registered query at one scale, Spark next to its DuckDB twin.

Environment: ``BENCH_SF_DIR`` (default /root/testdata/sf0.1), ``BENCH_CPUS``
(default 8), ``BENCH_QUERIES`` (comma list, default all), ``BENCH_DUCKDB``
(``0`` skips the DuckDB timings), ``BENCH_SECONDS`` (default 1500: no query is begun after
that; those left out are listed under ``skipped``).

Each Spark query is forced to completion with the ``noop`` sink (full
evaluation, nothing collected). The warehouse dimensions are built and frozen
once first (``etl_load``: dimensions, facts and snapshots written to the shared
folder), as the reference's ETL runs before its metrics. Results that queries store for others are
forgotten before each, so a time holds all of a query's own work. Prints one JSON
line: ``{"metric", "value", "unit", "queries", "sf", ...}``.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
ONLY = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
WITH_DUCKDB = os.environ.get("BENCH_DUCKDB", "1") != "0"
SECONDS = float(os.environ.get("BENCH_SECONDS", "1500"))
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def main() -> None:
    from metricmart.plans import queries as Q
    from metricmart.plans.oracle_sql import SQL
    from metricmart.session import build_session

    spark = build_session(f"local[{CPUS}]", shuffle_partitions=max(CPUS, 8),
                          extra={"spark.driver.memory": "16g"})
    names = [n for n in Q.QUERIES if not ONLY or n in ONLY]
    timings: dict[str, float] = {}

    t0 = time.perf_counter()
    Q.warehouse(spark, SF_DIR).materialize()
    Q.warehouse(spark, SF_DIR, aligned=True).fct_account_transactions
    timings["etl_load"] = round(time.perf_counter() - t0, 3)

    begun, skipped = time.perf_counter(), []
    for name in names:
        if time.perf_counter() - begun > SECONDS:
            skipped.append(name)
            continue
        Q._RESULTS.clear()  # a stored result of another query must not stand in for the work
        t = time.perf_counter()
        Q.QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)

    duck: dict[str, float] = {}
    if WITH_DUCKDB:
        import duckdb

        con = duckdb.connect()
        con.execute(f"SET threads = {CPUS}")
        for tname in TABLES:
            p = f"{SF_DIR}/{tname}.parquet"
            if os.path.exists(p):
                con.execute(f"CREATE VIEW {tname} AS SELECT * FROM read_parquet('{p}')")
        for name in names:
            if name in SQL and name in timings:
                t = time.perf_counter()
                con.execute(SQL[name]).fetchall()
                duck[name] = round(time.perf_counter() - t, 3)

    sf = re.search(r"sf([0-9.]+)", SF_DIR)
    total = round(sum(timings.values()), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": total, "unit": "sec", "queries": timings,
        "sf": float(sf.group(1)) if sf else SF_DIR, "cpus": CPUS, "engine": "spark",
        "skipped": skipped, "duckdb_queries": duck, "duckdb_total": round(sum(duck.values()), 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
