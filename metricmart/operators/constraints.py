"""C-1..C-6: the rules of a table's DDL as data checks, compiled into one pass per table.

``Rules`` lists what holds for a table. ``check`` turns all of it into one aggregation over one scan:

* Column rules (NOT NULL, domains, defaults) are 0/1 flags of a row.
* A reference is a left join with the distinct keys of its parent, which adds a flag; the planner broadcasts
  small parents and splits skewed joins.
* Rows are then aggregated by the primary key, with partial sums before the shuffle: the count per key
  decides on keys, and the flags' sums go along. A key that many rows share is summed up before it is moved.
  UNIQUE columns are further grouping sets of the same aggregation.
* A second aggregation over the per-key rows gives the counts of violations.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas


@dataclass
class Rules:
    table: str
    rows: DataFrame
    key: list[str]
    unique: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    domains: dict[str, list] = field(default_factory=dict)
    defaults: bool = False  # columns with a default in the DDL: missing values are counted (the loader fills them)
    references: list[tuple[str, DataFrame, str]] = field(default_factory=list)  # column, parent, its column; NULL is allowed

    def column_rules(self) -> dict[str, Column]:
        """Each row rule's name and violation."""
        rules = {f"not_null:{c}": F.col(c).isNull() for c in self.not_null}
        for c, domain in self.domains.items():
            rules[f"domain:{c}"] = F.col(c).isNotNull() & ~F.col(c).isin(*domain)
        if self.defaults:
            for c in schemas.SOURCE_DEFAULTS.get(self.table, {}):
                if c in self.rows.columns:
                    rules[f"default:{c}"] = F.col(c).isNull()
        return rules


def check(rules: Rules) -> DataFrame:
    """``(rule, table_name, violations)``: a row per rule of the table, from one scan of it."""
    flags = {name: bad.cast("int") for name, bad in rules.column_rules().items()}
    needed = [F.col(c) for c in dict.fromkeys([*rules.key, *rules.unique, *(r[0] for r in rules.references)])]
    rows = rules.rows.select(*needed, *[f.alias(f"_f{i}") for i, f in enumerate(flags.values())])
    names = list(flags)
    for column, parent, parent_column in rules.references:
        known = parent.select(F.col(parent_column).alias("_parent")).distinct().withColumn("_known", F.lit(1))
        missing = (F.col(column).isNotNull() & F.col("_known").isNull()).cast("int")
        rows = (rows.join(known, F.col(column) == F.col("_parent"), "left")
                    .withColumn(f"_f{len(names)}", missing).drop("_parent", "_known"))
        names.append(f"foreign_key:{column}")
    sums = [F.count(F.lit(1)).alias("_n"), *[F.sum(f"_f{i}").alias(f"_f{i}") for i in range(len(names))]]
    if rules.unique:
        groups = [[F.col(c) for c in rules.key], *[[F.col(c)] for c in rules.unique]]
        kept = [*rules.key, *rules.unique]
        per_key = rows.groupingSets(groups, *kept).agg(*sums, *[F.grouping(c).alias(f"_out_{c}") for c in kept])
        by_key = F.col(f"_out_{rules.key[0]}") == 0
    else:
        per_key, by_key = rows.groupBy(*rules.key).agg(*sums), F.lit(True)
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in rules.key])
    shared = F.col("_n") > 1
    found = {"primary_key": F.when(by_key & (shared | no_key), F.col("_n"))}
    for c in rules.unique:
        found[f"unique:{c}"] = F.when((F.col(f"_out_{c}") == 0) & F.col(c).isNotNull() & shared, F.col("_n"))
    for i, name in enumerate(names):
        found[name] = F.when(by_key, F.col(f"_f{i}"))
    columns = [f"_r{i}" for i in range(len(found))]
    counts = per_key.agg(*[F.coalesce(F.sum(v), F.lit(0)).cast("bigint").alias(c) for c, v in zip(columns, found.values(), strict=True)])
    label = F.create_map(*[F.lit(x) for pair in zip(columns, found, strict=True) for x in pair])
    return counts.unpivot([], columns, "_n", "violations").select(
        label[F.col("_n")].alias("rule"), F.lit(rules.table).alias("table_name"), "violations")


def report(tables: list[Rules]) -> DataFrame:
    return reduce(DataFrame.unionByName, [check(r) for r in tables])


def source_rules(users: DataFrame, keys: DataFrame, changes: DataFrame, logs: DataFrame, billing: DataFrame,
                 models: DataFrame) -> list[Rules]:
    """The rules of the source tables."""
    return [
        Rules("users", users, ["user_id"], ["email"], ["email", "registration_date", "subscription_plan"],
              {"subscription_plan": schemas.PLANS}, defaults=True),
        Rules("api_keys", keys, ["key_id"], ["api_key"], ["user_id", "api_key"], defaults=True,
              references=[("user_id", users, "user_id")]),
        Rules("user_plan_changes", changes, ["change_id"], [], ["user_id", "old_plan", "new_plan", "change_date"], defaults=True,
              references=[("user_id", users, "user_id")]),
        Rules("request_logs_raw", logs, ["request_id"], [],
              ["key_id", "model_id", "prompt_token_count", "completion_token_count", "latency_ms", "http_status", "request_time"],
              references=[("key_id", keys, "key_id"), ("model_id", models, "model_id")]),
        Rules("billing_orders", billing, ["order_id"], [], ["user_id", "amount", "order_type", "transaction_status", "created_at"],
              {"order_type": schemas.ORDER_TYPES, "transaction_status": schemas.TRANSACTION_STATUSES}, defaults=True,
              references=[("user_id", users, "user_id")]),
        Rules("ai_models", models, ["model_id"], [], ["provider", "input_price_per_1M", "output_price_per_1M", "input_cost_per_1M",
                                                      "output_cost_per_1M"], defaults=True),
    ]


#: The references of the facts: column and dimension (both have the column).
FACT_REFERENCES = {
    "fct_api_requests": [("account_sk", "dim_account"), ("model_sk", "dim_model"), ("status_sk", "dim_status_code"), ("key_sk", "dim_api_key")],
    "fct_account_transactions": [("account_sk", "dim_account")],
}


def warehouse_rules(tables: dict[str, DataFrame]) -> list[Rules]:
    """Keys of every given table, and the facts' references."""
    return [Rules(name, df, schemas.PRIMARY_KEYS[name],
                  references=[(c, tables[dim], c) for c, dim in FACT_REFERENCES.get(name, [])]) for name, df in tables.items()]
