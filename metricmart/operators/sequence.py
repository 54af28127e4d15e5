"""Skew-proof ordered sequences: global positions, and each row's next / previous row.

``stage_in_order`` range-partitions rows on a total order and sorts inside each
partition, so every task holds one contiguous slice of the order and a hot key
(one user with a third of all rows) is spread over as many tasks as its rows
need. Each row gets an address ``(_pid, _mid)``: its partition and its
``monotonically_increasing_id``, consecutive within a partition. The staged
rows are frozen with a reliable checkpoint (range boundaries come from
sampling and must not move between reads). One row of statistics per
partition (count, first and last address) is all that is needed to number
rows globally (surrogate keys) or to find a row's neighbour in the order.

``neighbour_in_order`` replaces ``lead`` / ``lag`` over ``partitionBy(key)``
windows: the neighbour's address is computed arithmetically (same partition,
position ± 1, or the first / last row of the next / previous non-empty
partition) and fetched with an equi-join on that unique address — a join with
no hot key, whatever the skew of ``key``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze

PID, MID = "_sq_pid", "_sq_mid"


def _cols(cols: list) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def stage_in_order(df: DataFrame, order: list, num_partitions: int | None = None):
    """``(staged, stats)``: frozen rows with ``_sq_pid`` / ``_sq_mid``, and one row per
    non-empty partition with ``_sq_n`` (rows), ``_sq_first`` / ``_sq_last`` (addresses)
    and ``_sq_before`` (rows in all earlier partitions)."""
    o = _cols(order)
    # without an explicit count AQE sizes the range partitions: adjacent small ranges are
    # coalesced to the advisory size, which keeps every task a contiguous, ordered slice
    ranged = df.repartitionByRange(num_partitions, *o) if num_partitions else df.repartitionByRange(*o)
    staged = freeze(ranged.sortWithinPartitions(*o)
                          .withColumn(PID, F.spark_partition_id())
                          .withColumn(MID, F.monotonically_increasing_id()))
    stats = staged.groupBy(PID).agg(F.count(F.lit(1)).alias("_sq_n"), F.min(MID).alias("_sq_first"),
                                    F.max(MID).alias("_sq_last"))
    # one row per partition: a window over it is bounded by the partition count
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = stats.withColumn("_sq_before", F.coalesce(F.sum("_sq_n").over(before), F.lit(0)))
    return staged, stats


def neighbour_in_order(df: DataFrame, key: list[str], order: list, values: list[str], prefix: str,
                       direction: str = "next", num_partitions: int | None = None) -> DataFrame:
    """Add ``prefix + v`` for each ``v`` in ``values``: the value on the next (or previous)
    row of the same ``key`` in ``(key, order)`` order, NULL at the end of a key.

    ``key + order`` must be unique (a total order), as for ``lead`` / ``lag`` to be
    deterministic.
    """
    staged, stats = stage_in_order(df, [*key, *order], num_partitions)
    w = Window.orderBy(PID)  # over one row per partition
    if direction == "next":
        nb = stats.select(PID, "_sq_first", "_sq_last",
                          F.lead(PID).over(w).alias("_nb_pid"), F.lead("_sq_first").over(w).alias("_nb_mid"))
        inside = F.col(MID) < F.col("_sq_last")
        step = F.col(MID) + 1
    elif direction == "previous":
        nb = stats.select(PID, "_sq_first", "_sq_last",
                          F.lag(PID).over(w).alias("_nb_pid"), F.lag("_sq_last").over(w).alias("_nb_mid"))
        inside = F.col(MID) > F.col("_sq_first")
        step = F.col(MID) - 1
    else:
        raise ValueError(direction)
    # one row per partition: bounded by the partition count, not by the data
    addressed = (staged.join(F.broadcast(nb), PID)
                 .withColumn("_to_pid", F.when(inside, F.col(PID)).otherwise(F.col("_nb_pid")))
                 .withColumn("_to_mid", F.when(inside, step).otherwise(F.col("_nb_mid")))
                 .drop("_sq_first", "_sq_last", "_nb_pid", "_nb_mid"))
    other = staged.select(F.col(PID).alias("_to_pid"), F.col(MID).alias("_to_mid"),
                          *[F.col(k).alias(f"_nbk_{k}") for k in key],
                          *[F.col(v).alias(prefix + v) for v in values])
    j = addressed.join(other, ["_to_pid", "_to_mid"], "left")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_nbk_{k}")) for k in key])
    j = j.withColumns({prefix + v: F.when(same, F.col(prefix + v)) for v in values})
    return j.drop("_to_pid", "_to_mid", PID, MID, *[f"_nbk_{k}" for k in key])


def global_position(df: DataFrame, order: list, name: str, num_partitions: int | None = None) -> DataFrame:
    """K-1: number rows 1..n in ``order`` (a total order), with no single-partition window."""
    staged, stats = stage_in_order(df, order, num_partitions)
    offsets = F.broadcast(stats.select(PID, "_sq_first", "_sq_before"))  # one row per partition
    return (staged.join(offsets, PID)
                  .withColumn(name, F.col("_sq_before") + (F.col(MID) - F.col("_sq_first")) + 1)
                  .drop(PID, MID, "_sq_first", "_sq_before"))


def position_in_group(df: DataFrame, group: list[str], order: list, name: str, ties: list[str] | None = None) -> DataFrame:
    """Add ``name``: each row's number 1..n within its group, in ``order`` (total within the group).

    With ``ties`` (the columns that decide a rank) rows equal in them share the least number, as ``rank()``
    gives. No window holds a group: a position is the global one less that of the group's first row, so a group with a
    third of all rows is numbered by as many tasks as its rows need. Groups must not be null.
    """
    placed = global_position(df, [*group, *order], "_sq_pos")
    first = placed.groupBy(*group).agg(F.min("_sq_pos").alias("_sq_first_pos"))
    if ties is None:
        out = placed.withColumn("_sq_at", F.col("_sq_pos"))
    else:
        equal = placed.groupBy(*group, *ties).agg(F.min("_sq_pos").alias("_sq_at"))
        names = [f"_sq_t{i}" for i in range(len(group) + len(ties))]
        equal = equal.select(*[F.col(c).alias(n) for c, n in zip([*group, *ties], names, strict=True)], "_sq_at")
        same = reduce(lambda a, b: a & b, [placed[c].eqNullSafe(equal[n]) for c, n in zip([*group, *ties], names, strict=True)])
        out = placed.join(equal, same).drop(*names)
    return (out.join(first, group).withColumn(name, (F.col("_sq_at") - F.col("_sq_first_pos") + 1).cast("int"))
               .drop("_sq_pos", "_sq_at", "_sq_first_pos").select(*df.columns, name))


def running_in_group(df: DataFrame, group: list[str], order: list, value: str, name: str) -> DataFrame:
    """Add ``name``: the running total of the non-negative ``value`` within the group, the row included, and
    ``name_total``, the group's. Totals run within the ordered partitions, each of which a task holds
    anyway, and are shifted by those of the partitions before; the group's start is then taken off."""
    staged, _ = stage_in_order(df, [*group, *order])
    inside = Window.partitionBy(PID).orderBy(MID).rowsBetween(Window.unboundedPreceding, 0)  # a partition's rows
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    sums = staged.groupBy(PID).agg(F.sum(value).alias("_sq_sum"))
    sums = sums.select(PID, F.coalesce(F.sum("_sq_sum").over(before), F.lit(0)).alias("_sq_base"))
    run = (staged.withColumn("_sq_run", F.sum(value).over(inside)).join(F.broadcast(sums), PID)
                 .withColumn("_sq_run", F.col("_sq_run") + F.col("_sq_base")))
    start = run.groupBy(*group).agg(F.min(F.col("_sq_run") - F.col(value)).alias("_sq_start"), F.sum(value).alias(f"{name}_total"))
    return run.join(start, group).withColumn(name, F.col("_sq_run") - F.col("_sq_start")).select(*df.columns, name, f"{name}_total")
