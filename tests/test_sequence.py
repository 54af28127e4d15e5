"""The skew-proof neighbour operator equals lead/lag, whatever the skew and the partitioning."""

import random

import pandas as pd

from metricmart.operators.sequence import global_position, neighbour_in_order


def _data(seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(600):
        k = 0 if rnd.random() < 0.6 else rnd.randint(1, 30)  # key 0 holds ~60% of the rows
        rows.append((k, rnd.randint(0, 50), i, rnd.random()))
    return rows


def test_neighbours_match_pandas(spark):
    rows = _data(11)
    df = spark.createDataFrame(rows, "k long, t long, tie long, v double")
    pdf = pd.DataFrame(rows, columns=["k", "t", "tie", "v"]).sort_values(["k", "t", "tie"])
    want_next = dict(zip(pdf.tie, pdf.groupby("k").v.shift(-1)))
    want_prev = dict(zip(pdf.tie, pdf.groupby("k").v.shift(1)))
    for n in (1, 3, 8, None):  # None: AQE sizes the range partitions
        nxt = neighbour_in_order(df, ["k"], ["t", "tie"], ["v"], "_n_", "next", num_partitions=n)
        got = {r.tie: r._n_v for r in nxt.collect()}
        assert all((got[t] is None and pd.isna(w)) or got[t] == w for t, w in want_next.items()), n
        prv = neighbour_in_order(df, ["k"], ["t", "tie"], ["v"], "_p_", "previous", num_partitions=n)
        got = {r.tie: r._p_v for r in prv.collect()}
        assert all((got[t] is None and pd.isna(w)) or got[t] == w for t, w in want_prev.items()), n


def test_hot_key_is_spread_over_partitions(spark):
    from pyspark.sql import functions as F

    from metricmart.operators.sequence import stage_in_order

    df = spark.createDataFrame(_data(5), "k long, t long, tie long, v double")
    staged, stats = stage_in_order(df, ["k", "t", "tie"], num_partitions=8)
    parts_of_hot_key = staged.filter("k = 0").select(F.countDistinct("_sq_pid")).first()[0]
    assert parts_of_hot_key >= 3  # a window partitioned by k would put all of it in one task


def test_global_position_dense(spark):
    df = spark.createDataFrame(_data(3), "k long, t long, tie long, v double")
    got = sorted((r.k, r.t, r.tie, r.pos) for r in global_position(df, ["k", "t", "tie"], "pos", 5).collect())
    assert [g[3] for g in got] == list(range(1, len(got) + 1))
