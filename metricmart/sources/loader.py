"""Source loaders (SRC-1..SRC-12): the six OLTP tables as lazy, schema-declared DataFrames."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas


@dataclass
class Sources:
    """The extract bundle: one lazy DataFrame per source table."""

    users: DataFrame
    plan_changes: DataFrame
    api_keys: DataFrame
    models: DataFrame
    logs: DataFrame
    billing: DataFrame

    def register_views(self, prefix: str = "src_") -> None:
        """SRC-8: expose every frame to SQL as ``src_<name>``."""
        for f in fields(self):
            getattr(self, f.name).createOrReplaceTempView(prefix + f.name)


class DeferredSources(Sources):
    """Sources built on first use: a source whose construction runs jobs (a frozen staging)
    starts only when a table needs it, e.g. inside the concurrent first wave of a load."""

    def __init__(self, builders: dict):  # noqa: D107 - name → zero-argument callable
        self._builders = dict(builders)

    def __getattr__(self, name: str):
        builders = self.__dict__.get("_builders", {})
        if name in builders:
            value = builders[name]()
            setattr(self, name, value)
            return value
        raise AttributeError(name)


_TABLE_OF = {
    "users": "users",
    "plan_changes": "user_plan_changes",
    "api_keys": "api_keys",
    "models": "ai_models",
    "logs": "request_logs_raw",
    "billing": "billing_orders",
}


# CSV keeps microseconds only with an explicit pattern (the default stops at milliseconds).
CSV_OPTIONS = {"header": "true", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS",
               "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"}


@dataclass(frozen=True)
class Split:
    """How a database table is read by several tasks: equal strides of a numeric or time column between two
    values (rows beyond them belong to the first and last stride), or one task per predicate."""

    column: str | None = None
    lower: object = None
    upper: object = None
    partitions: int = 1
    predicates: tuple[str, ...] = ()

    def __post_init__(self):
        strides = (self.column, self.lower, self.upper)
        if self.predicates and any(x is not None for x in strides):
            raise ValueError("a split goes by a column or by predicates, not both")
        if not self.predicates and any(x is None for x in strides):
            raise ValueError("a split by a column needs the column and both bounds")
        if not self.predicates and self.partitions < 1:
            raise ValueError("a split has at least one partition")

    def options(self) -> dict[str, str]:
        """Spark's options for strides (none for predicates)."""
        if self.predicates:
            return {}
        return {"partitionColumn": self.column, "lowerBound": str(self.lower), "upperBound": str(self.upper), "numPartitions": str(self.partitions)}


def read_jdbc(spark: SparkSession, table: str, options: dict, split: Split | None = None) -> DataFrame:
    """A database table; without a ``split`` by one task. Filters and columns are pushed to the database."""
    if split and split.predicates:
        rest = {k: str(v) for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], table, predicates=list(split.predicates), properties=rest)
    return spark.read.format("jdbc").options(**options, dbtable=table, **(split.options() if split else {})).load()


def read_table(spark: SparkSession, path: str, table: str, fmt: str = "parquet",
               options: dict | None = None, split: Split | None = None) -> DataFrame:
    """Full scan of one source table with its declared schema (SRC-1..6).

    ``fmt`` is any Spark source: ``parquet`` (default), ``csv`` (header row) or
    ``jdbc`` (``options`` carry url / user / password / fetchsize / …; ``split`` says how tasks share the table).
    """
    schema = schemas.SOURCES[table]
    reader = spark.read.options(**(options or {}))
    if fmt == "jdbc":
        return schemas.conform(read_jdbc(spark, table, options or {}, split), schema)
    if fmt == "csv":
        return reader.options(**CSV_OPTIONS).schema(schema).csv(f"{path}/{table}")
    return schemas.conform(reader.format(fmt).load(f"{path}/{table}"), schema)


def write_sources(src: Sources, path: str, fmt: str = "csv") -> None:
    """SNK-8: export the six source tables (CSV with a header by default), one folder each;
    the six writes are independent and run as concurrent jobs."""
    from ..session import run_concurrently

    def write(name: str, table: str) -> None:
        w = getattr(src, name).write.mode("overwrite")
        if fmt == "csv":
            w.options(**CSV_OPTIONS).csv(f"{path}/{table}")
        else:
            w.format(fmt).save(f"{path}/{table}")

    run_concurrently([lambda n=n, t=t: write(n, t) for n, t in _TABLE_OF.items()])


def load_sources(spark: SparkSession, path: str, fmt: str = "parquet",
                 options: dict | None = None, splits: dict[str, Split] | None = None) -> Sources:
    """SRC-7: the six source tables. ``api_keys`` is a projected scan (SRC-3). ``splits``: by table, for databases.

    Column defaults of the source DDL (C-6) are filled on the reference tables;
    the request log keeps its NULLs so the validity rule (T2) still sees them.
    """
    frames = {name: read_table(spark, path, table, fmt, options, (splits or {}).get(table)) for name, table in _TABLE_OF.items()}
    for name, table in _TABLE_OF.items():
        if table != "request_logs_raw":
            frames[name] = apply_defaults(frames[name], table)
    frames["api_keys"] = frames["api_keys"].select("key_id", "user_id", "key_name", "is_active")
    return Sources(**frames)


def apply_defaults(df: DataFrame, table: str) -> DataFrame:
    """C-6: fill the source DDL's column defaults of ``table`` where a value is missing."""
    present = {c: v for c, v in schemas.SOURCE_DEFAULTS[table].items() if c in df.columns}
    return df.fillna(present) if present else df


def write_jdbc(df: DataFrame, url: str, table: str, batchsize: int = 5000, mode: str = "append",
               properties: dict | None = None) -> None:
    """SNK-9: append into an RDBMS table in batches (5,000 rows per insert batch by default);
    each task writes its own partition over its own connection."""
    (df.write.format("jdbc").mode(mode).option("url", url).option("dbtable", table)
       .option("batchsize", batchsize).options(**(properties or {})).save())


def range_scan(df: DataFrame, ts_col: str, start, end) -> DataFrame:
    """SRC-9 / SRC-11: inclusive time-range read; pushed to the scan as a parquet
    filter (and to partition pruning when the table is partitioned by date)."""
    return df.filter(F.col(ts_col).between(F.lit(start), F.lit(end)))


# The model catalogue of the reference's shipped settings
# (model_id, provider, input price, output price, input cost, output cost per 1M tokens,
#  max context). A configuration input, loaded as a small dimension source (SRC-12).
REFERENCE_MODELS = [
    ("gpt-5.4", "OpenAI", 2.50, 15.00, 2.00, 10.00, 1050000),
    ("gpt-5.4-pro", "OpenAI", 30.00, 180.00, 25.00, 150.00, 1050000),
    ("gpt-5.4-codex", "OpenAI", 2.50, 15.00, 1.80, 12.00, 1050000),
    ("gpt-4.1", "OpenAI", 2.50, 10.00, 1.50, 8.00, 128000),
    ("claude-sonnet-4-6", "Anthropic", 3.00, 15.00, 2.40, 12.00, 200000),
    ("claude-sonnet-4-6-thinking", "Anthropic", 3.00, 15.00, 2.40, 12.00, 200000),
    ("claude-opus-4-6", "Anthropic", 5.00, 25.00, 4.00, 20.00, 200000),
    ("claude-opus-4-6-thinking", "Anthropic", 5.00, 25.00, 4.00, 20.00, 200000),
    ("deepseek-v3.2", "DeepSeek", 0.28, 0.42, 0.15, 0.25, 128000),
    ("deepseek-v3.2-exp", "DeepSeek", 0.28, 0.42, 0.15, 0.25, 128000),
    ("gemini-3-flash-preview", "Google", 0.50, 3.00, 0.35, 2.00, 1000000),
    ("gemini-3.1-pro-preview", "Google", 2.00, 12.00, 1.50, 9.00, 2000000),
]


def reference_models(spark: SparkSession) -> DataFrame:
    """SRC-12: the configured model catalogue as an ``ai_models`` frame."""
    return schemas.conform(reference_catalogue(spark), schemas.AI_MODELS)


def reference_catalogue(spark: SparkSession) -> DataFrame:
    """The configured catalogue with each model's position (0-based) in the settings."""
    rows = [(i, m, p, ip, op, ic, oc, ctx, True) for i, (m, p, ip, op, ic, oc, ctx) in enumerate(REFERENCE_MODELS)]
    df = spark.createDataFrame(rows, "position int, model_id string, provider string, ip double, op double, "
                                     "ic double, oc double, max_context int, is_available boolean")
    return df.selectExpr("position", "model_id", "provider", "ip as input_price_per_1M",
                         "op as output_price_per_1M", "ic as input_cost_per_1M", "oc as output_cost_per_1M",
                         "max_context", "is_available")
