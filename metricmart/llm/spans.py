"""Pattern spans as column expressions: all leftmost non-overlapping matches with their places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPAN = "array<struct<kind:string,start:int,end:int,match:string>>"


def no_spans() -> Column:
    return F.array().cast(SPAN)


def find(text: Column, kind: str, pattern: str, only_if: Column | None = None) -> Column:
    """Spans of ``pattern`` in code points, end exclusive. Splitting at the matches gives the gaps
    between them, so a fold over gap and match lengths gives each match's place.
    ``only_if``: a cheap condition that every text with a match fulfils."""
    pairs = F.filter(F.zip_with(
        F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda gap, m: F.struct(F.char_length(gap).alias("gap"), m.alias("m"))), lambda x: x["m"].isNotNull())

    def step(acc, x):
        start = acc["at"] + x["gap"]
        end = start + F.char_length(x["m"])
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["m"].alias("match"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    got = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), no_spans().alias("out")), step, lambda a: a["out"])
    return F.when(only_if & text.isNotNull(), got).otherwise(no_spans()) if only_if is not None else F.coalesce(got, no_spans())


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span in the given order, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def in_order(spans: Column, kinds: tuple[str, ...], by_start: bool) -> Column:
    """Spans sorted by start then kind as listed, or by kind as listed then start."""
    rank = lambda s: F.array_position(F.array(*[F.lit(k) for k in kinds]), s["kind"]).cast("int")
    first, second = (lambda s: s["start"], rank) if by_start else (rank, lambda s: s["start"])
    keyed = F.transform(spans, lambda s: F.struct(first(s).alias("a"), second(s).alias("b"), s["end"].alias("c"), s.alias("s")))
    return F.transform(F.array_sort(keyed), lambda x: x["s"])
