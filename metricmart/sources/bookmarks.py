"""SRC-5 under S-16: how far each source table has been read.

A load reads only rows past its table's mark, in a column that grows (an id, or a time of change). The mark
moves with the load: it is the greatest value that the load has taken up, published in a commit log after all else. A load that
dies is read again from the old mark. Rows may become visible a little out of order; ``overlap``
reads that much before the mark again, and the loads that follow take a row that comes twice only once.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.commits import CommitLog


@dataclass(frozen=True)
class Growing:
    """The column by which a table is read on; ``overlap`` in its units (days, for times)."""

    column: str
    overlap: int = 0


#: the source tables that grow; the others (keys and models) are small and read whole
TABLES = {"users": Growing("updated_at"), "user_plan_changes": Growing("change_date", 1), "request_logs_raw": Growing("request_time", 1),
          "billing_orders": Growing("created_at", 1)}


class Bookmarks:
    """Marks under ``root``, all of a load's in one version."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, Growing] | None = None):
        self.log, self.tables = CommitLog(spark, root), tables or TABLES

    def marks(self) -> tuple[int, dict]:
        base, state = self.log.newest({})
        return base, {t: datetime.fromisoformat(m["at"]) if m["kind"] == "time" else m["at"] for t, m in state.items()}

    def since(self, rows: DataFrame, table: str) -> DataFrame:
        """The rows past the table's mark (all, before the first load): a filter that sources can push down."""
        mark, how = self.marks()[1].get(table), self.tables[table]
        if mark is None:
            return rows
        start = mark - (timedelta(days=how.overlap) if isinstance(mark, datetime) else how.overlap)
        return rows.filter(F.col(how.column) > F.lit(start) if not how.overlap else F.col(how.column) >= F.lit(start))

    def reached(self, rows: DataFrame, table: str):
        """The greatest value of the table's column in ``rows`` (None: no row)."""
        return rows.agg(F.max(self.tables[table].column)).first()[0]

    def advance(self, base: int, reached: dict) -> int:
        """Publish new marks; a table without new rows keeps its own."""
        now = {**self.marks()[1], **{t: v for t, v in reached.items() if v is not None}}
        return self.log.commit(base, {t: {"kind": "time", "at": v.isoformat()} if isinstance(v, datetime) else {"kind": "number", "at": v} for t, v in now.items()})
