"""Configuration-driven routing of change rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.maps import comma_list, keep_listed
from freshet.operators.filters import dim_changes, fact_changes


def current_rules(
    snapshot: DataFrame, rule_changes: DataFrame | None, keys: list[str]
) -> DataFrame:
    """The rules in force: the preloaded snapshot overlaid by later changes.

    ``rule_changes`` has the rule columns, ``op`` and a number ``seq`` that
    grows with each change.  A ``d`` removes the key's rule, also the
    preloaded one.
    """
    rule = [name for name in snapshot.columns]
    rows = snapshot.select(*rule, F.lit("r").alias("op"), F.lit(-1).cast("bigint").alias("seq"))
    if rule_changes is not None:
        rows = rows.unionByName(
            rule_changes.select(*rule, "op", F.col("seq").cast("bigint"))
        )
    rest = [name for name in rule if name not in keys]
    return (
        rows.groupBy(*keys)
        .agg(F.max_by(F.struct("op", *rest), "seq").alias("_last"))
        .where(F.col("_last.op") != "d")
        .select(*keys, *[F.col(f"_last.{name}").alias(name) for name in rest])
    )


def _ready(rules: DataFrame) -> DataFrame:
    """The rules with their column list split once, not once per change row."""
    listed = rules.withColumn("_listed", comma_list(F.col("sink_columns")))
    return listed.drop("sink_columns")


def route_dimensions(changes: DataFrame, rules: DataFrame, database: str) -> DataFrame:
    """Change rows with the rule of their table; rows without a rule vanish.

    ``data`` keeps only the rule's columns.  Beside it: the operation type,
    target table, column family and row key.
    """
    kept = dim_changes(changes, database)
    carried = [c for c in changes.columns if c not in ("database", "table", "type", "old")]
    ruled = kept.join(_ready(rules.withColumnRenamed("source_table", "table")), "table")
    return ruled.select(
        "sink_table",
        "sink_family",
        F.expr("data[sink_row_key]").alias("row_key"),
        F.col("type").alias("op_type"),
        *[
            keep_listed(F.col("data"), F.col("_listed")).alias("data")
            if c == "data"
            else F.col(c)
            for c in carried
        ],
    )


def route_facts(changes: DataFrame, rules: DataFrame, database: str) -> DataFrame:
    """Fact rows for the sink named by (table, type)."""
    kept = fact_changes(changes, database)
    carried = [c for c in changes.columns if c not in ("database", "table", "type", "old", "data")]
    ruled = kept.join(
        _ready(rules.withColumnsRenamed({"source_table": "table", "source_type": "type"})),
        ["table", "type"],
    )
    return ruled.select(
        "sink_table",
        keep_listed(F.col("data"), F.col("_listed")).alias("data"),
        *carried,
    )
