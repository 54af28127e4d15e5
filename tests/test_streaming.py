"""Streams give the batch answer: daily calls, and online 3-sigma alerts across many micro-batches."""

import math
import random
from datetime import date, timedelta

import pandas as pd

from metricmart.plans import queries as Q
from metricmart.session import checkpoint_dir
from metricmart.streaming.alerts import stream_latency_alerts


def test_online_alerts_over_many_batches(spark):
    rnd = random.Random(1)
    rows = []
    for m in ("a", "b", "c"):
        for i in range(15):
            x = 100.0 + (i % 3)  # steady series: early small-sample z stays below 3
            if m == "a" and i == 12:
                x = 400.0  # the planted spike
            rows.append((m, x, date(2024, 1, 1) + timedelta(days=i)))
    base = checkpoint_dir(spark) + f"/alerts-test-{rnd.random():.8f}"
    # each day lands as its own file, in day order: one micro-batch per file
    for d in sorted({r[2] for r in rows}):
        day_rows = [r for r in rows if r[2] == d]
        spark.createDataFrame(day_rows, "model_id string, mean_latency_ms double, snapshot_date date") \
             .coalesce(1).write.mode("append").parquet(base + "/in")
    got = stream_latency_alerts(spark, base + "/in", base + "/out", base + "/ckpt", max_files_per_trigger=1)
    res = {(r.model_id, r.snapshot_date): (r.prior_days, r.z_score, r.is_alert) for r in got.collect()}
    assert len(res) == len(rows)
    pdf = pd.DataFrame(rows, columns=["m", "x", "d"]).sort_values(["m", "d"])
    for m, g in pdf.groupby("m"):
        xs = list(g.x)
        for i, (x, d) in enumerate(zip(g.x, g.d)):
            prior = xs[:i]
            z = None
            if len(prior) >= 2:
                sd = pd.Series(prior).std()
                z = (x - sum(prior) / len(prior)) / sd if sd > 0 else None
            n, zs, alert = res[(m, d)]
            assert n == i
            assert (zs is None and z is None) or math.isclose(zs, round(z, 4), abs_tol=1.5e-4)
            assert alert == (z is not None and abs(round(z, 4)) > 3)
    assert [k for k, v in res.items() if v[2]] == [("a", date(2024, 1, 13))]


def test_stream_daily_calls_equals_batch(spark):
    sf = "/root/testdata/sf0.001"
    stream = sorted(map(tuple, Q.q_stream_daily_calls(spark, sf).collect()))
    batch = sorted(map(tuple, Q.q_daily_platform_calls(spark, sf).collect()))
    assert stream == batch


def test_late_and_corrected_days_are_scored_as_in_a_batch(spark):
    """Days land out of order, one again with another mean, over several runs of the stream."""
    rnd = random.Random(4)
    days = [date(2024, 1, 1) + timedelta(days=i) for i in range(20)]
    series = {(m, d): round(100 + 20 * rnd.random() + 400 * (m == "b" and i == 15), 3) for m in "ab" for i, d in enumerate(days)}
    order = list(series)
    rnd.shuffle(order)
    drops = [order[i::4] for i in range(4)]
    series["a", days[3]], wrong = 111.0, {("a", days[3]): 5.0}
    base = checkpoint_dir(spark) + f"/alerts-late-{rnd.random():.8f}"
    ddl = "model_id string, mean_latency_ms double, snapshot_date date"
    for i, drop in enumerate(drops):
        rows = [(m, wrong.get((m, d), series[m, d]), d) for m, d in drop]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(base + "/in")
        got = stream_latency_alerts(spark, base + "/in", base + "/out", base + "/ckpt")
    spark.createDataFrame([("a", 111.0, days[3])], ddl).coalesce(1).write.mode("append").parquet(base + "/in")
    got = stream_latency_alerts(spark, base + "/in", base + "/out", base + "/ckpt")
    res = {(r.model_id, r.snapshot_date): r for r in got.collect()}
    assert set(res) == set(series)
    for m in "ab":
        for i, d in enumerate(days):
            prior = pd.Series([series[m, x] for x in days[:i]])
            z = (series[m, d] - prior.mean()) / prior.std() if i >= 2 else None
            r = res[m, d]
            assert r.prior_days == i and r.mean_latency_ms == series[m, d]
            assert (r.z_score is None) == (z is None) and (z is None or math.isclose(r.z_score, z, abs_tol=1.5e-4))
    assert res["b", days[15]].is_alert
