"""Column expressions shared by the loads and the metrics (SCL-*, PRJ-*).

All are built-in ``pyspark.sql.functions`` so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import OPEN_END

PER_MILLION = 1000000.0


def plan_of_priority(priority: Column) -> Column:
    """Adapter rule: order priority → subscription plan."""
    return (F.when(priority == "1-URGENT", "enterprise")
            .when(priority.isin("2-HIGH", "3-MEDIUM"), "pro")
            .otherwise("free"))


def token_amount(prompt: Column, completion: Column, in_rate: Column, out_rate: Column) -> Column:
    """PRJ-3 / PRJ-4: ``prompt*in_rate/1e6 + completion*out_rate/1e6`` (double)."""
    return prompt * in_rate / PER_MILLION + completion * out_rate / PER_MILLION


def is_error(http_status: Column) -> Column:
    """PRJ-5: error when status >= 400; a NULL status is not an error."""
    return F.coalesce(http_status >= 400, F.lit(False))


def day_id(ts: Column) -> Column:
    """SCL-1: 'yyyy-MM-dd' time id."""
    return F.date_format(ts, "yyyy-MM-dd")


def month_id(ts: Column) -> Column:
    """SCL-2: 'yyyy-MM' time id."""
    return F.date_format(ts, "yyyy-MM")


def year_id(ts: Column) -> Column:
    return F.date_format(ts, "yyyy")


def week_id(ts: Column) -> Column:
    """ISO week id 'YYYY-Www' (week-based year)."""
    d = F.to_date(ts)
    # the ISO year is the year of the Thursday of the same week
    thursday = F.date_add(d, 3 - ((F.dayofweek(d) + 5) % 7))
    return F.format_string("%04d-W%02d", F.year(thursday), F.weekofyear(d))


def month_index(ts: Column) -> Column:
    """SCL-3 / SCL-4 helper: year*12 + month, so month differences are whole numbers."""
    return F.year(ts) * 12 + F.month(ts)


def open_end() -> Column:
    """PRJ-7: the open end of the current SCD2 interval."""
    return F.lit(OPEN_END).cast("timestamp_ntz")


def exact_sum(name: str) -> Column:
    """Money summed as DECIMAL, so the total doesn't depend on the order of the rows."""
    return F.sum(F.col(name).cast("decimal(28,12)")).cast("double")


def money4(x: Column) -> Column:
    """S-21 / T20: a money value at 4 decimals, rounded HALF_UP through DECIMAL.

    Rounding a double directly is not stable on ties (0.13545 may be stored just
    below); going through DECIMAL(38,10) first fixes the value, then rounds.
    """
    return F.round(x.cast("decimal(38,10)"), 4).cast("decimal(18,4)")


def round4(x: Column) -> Column:
    """A double shown at 4 decimals, rounded HALF_UP through DECIMAL (tie-safe, see ``money4``)."""
    return F.round(x.cast("decimal(38,10)"), 4).cast("double")


def round10(x: Column) -> Column:
    """DW doubles are compared at 10 decimals (exact adapter prices have at most 10)."""
    return F.round(x, 10)


def safe_ratio(num: Column, den: Column) -> Column:
    """Division that gives NULL (not an ANSI error) on a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))
