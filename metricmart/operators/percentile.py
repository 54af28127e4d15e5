"""Exact continuous percentiles without gathering a group's rows in one place.

Spark's ``percentile`` keeps every value of a group in one aggregation buffer,
so a hot group (one model with a third of all calls) would sit in one task's
memory. Two exact alternatives, both with the interpolation of
``percentile_cont``: ``h = (n − 1)·p``, ``lo + (hi − lo)·(h − ⌊h⌋)``.

* ``grouped_percentile``: for integer-like values (latency in ms, counts, days).
  A ``(group, value) → count`` histogram is built with map-side partial
  aggregation; its size is bounded by the value domain, not by the rows, and
  the order statistics are read from its running counts.
* ``global_percentiles``: cut-offs over one whole column of any type. Rows are
  numbered in value order by the distributed surrogate-key operator (range
  partitioning + prefix offsets), then only the ranks needed are fetched.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import with_surrogate_key
from .sequence import running_in_group


def grouped_percentile(df: DataFrame, group_cols: list[str], value_col: str, p: float,
                       name: str) -> DataFrame:
    """``group_cols + [name]``: the exact ``percentile_cont(p)`` of ``value_col`` per group."""
    hist = (df.filter(F.col(value_col).isNotNull())
              .groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c")))
    return histogram_percentile(hist, group_cols, value_col, "_c", p, name)


def histogram_percentile(hist: DataFrame, group_cols: list[str], value_col: str, count_col: str, p: float,
                         name: str) -> DataFrame:
    """The same from a histogram: one row per group and value, with its count.

    The running counts come from ``running_in_group``, so a group with very many values isn't held by one task.
    """
    hist = hist.select(*group_cols, value_col, F.col(count_col).alias("_c"))
    hist = running_in_group(hist, group_cols, [value_col], "_c", "_cum")
    h = (F.col("_cum_total") - 1).cast("double") * F.lit(float(p))
    picked = hist.groupBy(*group_cols).agg(
        F.min(F.when(F.col("_cum") > F.floor(h), F.col(value_col))).cast("double").alias("_lo"),
        F.min(F.when(F.col("_cum") > F.ceil(h), F.col(value_col))).cast("double").alias("_hi"),
        F.max(h - F.floor(h)).alias("_frac"))
    return picked.select(*group_cols, (F.col("_lo") + (F.col("_hi") - F.col("_lo")) * F.col("_frac")).alias(name))


def global_percentiles(df: DataFrame, value_col: str, tiebreak: list[str], ps: list[float]) -> list[float]:
    """Exact ``percentile_cont`` cut-offs of one column (NULLs ignored), as Python floats.

    ``tiebreak`` makes the value order total (e.g. the entity key). Only
    ``2·len(ps)`` rows reach the driver.
    """
    vals = df.select(value_col, *tiebreak).filter(F.col(value_col).isNotNull())
    ranked = with_surrogate_key(vals, [value_col, *tiebreak], "_rank")
    n = ranked.count()
    if n == 0:
        return [float("nan")] * len(ps)
    wanted = {}
    for p in ps:
        h = (n - 1) * p
        wanted[p] = (h, math.floor(h) + 1, math.ceil(h) + 1)
    ranks = sorted({r for _, lo, hi in wanted.values() for r in (lo, hi)})
    got = {r[0]: float(r[1]) for r in ranked.filter(F.col("_rank").isin(ranks))
           .select("_rank", value_col).collect()}
    out = []
    for p in ps:
        h, lo, hi = wanted[p]
        out.append(got[lo] + (got[hi] - got[lo]) * (h - math.floor(h)))
    return out


def score_by_cutoffs(col, cutoffs: list[float], higher_is_better: bool = True):
    """1..len(cutoffs)+1 by comparing a value with ascending cut-offs; ties share a score."""
    k = len(cutoffs) + 1
    expr = F.lit(k)
    for i in range(len(cutoffs) - 1, -1, -1):
        expr = F.when(col <= F.lit(cutoffs[i]), F.lit(i + 1)).otherwise(expr)
    return expr if higher_is_better else (F.lit(k + 1) - expr)
