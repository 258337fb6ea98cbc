"""Rules that change while a job runs: every version of a rule, in force from a time on.

A change row is routed by the version in force at its own time, so the result does not depend on how rows and rule changes
fall into micro-batches.  All versions of a key are one row, so joining change rows to them never multiplies a row.

Times are milliseconds.  A version holds from its time on, that time included, until the key's next one; a removal is a
version too.  A row without a time takes the newest version.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.maps import comma_list, keep_listed
from freshet.operators.filters import dim_changes, fact_changes

DIM_KEYS = ("source_table",)
FACT_KEYS = ("source_table", "source_type")
#: Captured times are milliseconds; change rows carry seconds.
MILLIS = 1000
_BEFORE_ALL, _AFTER_ALL = -(2**63), 2**63 - 1


def steps(rule_changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Captured changes as steps per key; an update that moves a rule to another key removes it from the old one.

    ``rule_changes`` comes from ``snapshots.rule_changes``: ``op``, ``ts_ms``, ``seq``, the rule's columns, and the
    ones before the change with ``old_`` in front.
    """
    rest = [name for name in _rule_columns(rule_changes) if name not in keys]
    moved = (F.col("op") == "u") & F.coalesce(
        F.struct(*[F.col(f"old_{key}") for key in keys]) != F.struct(*keys), F.lit(False)
    )
    whole = F.struct(*keys, "op", *rest)
    gone = F.struct(
        *[F.col(f"old_{key}").alias(key) for key in keys],
        F.lit("d").alias("op"),
        *[F.lit(None).cast("string").alias(name) for name in rest],
    )
    return rule_changes.select(
        F.col("ts_ms").cast("bigint").alias("ts_ms"),
        F.col("seq").cast("bigint").alias("seq"),
        F.explode(F.when(moved, F.array(gone, whole)).otherwise(F.array(whole))).alias("_s"),
    ).select("ts_ms", "seq", "_s.*")


def _rule_columns(rule_changes: DataFrame) -> list[str]:
    return [n for n in rule_changes.columns if f"old_{n}" in rule_changes.columns]


def as_changes(snapshot: DataFrame) -> DataFrame:
    """The rows of a rule table as changes that hold from the beginning."""
    old = [F.lit(None).cast("string").alias(f"old_{name}") for name in snapshot.columns]
    return snapshot.select(
        F.lit(-1).cast("bigint").alias("seq"), F.lit("r").alias("op"), F.lit(_BEFORE_ALL).alias("ts_ms"), *old, "*"
    )


def rule_log(rule_changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key with its ``versions``, oldest first.

    Each version has ``since``, ``op``, the rule's columns, and its column list split once.
    """
    rest = [name for name in _rule_columns(rule_changes) if name not in keys]
    version = F.struct(
        F.col("ts_ms").alias("since"), "seq", "op", *rest, comma_list(F.col("sink_columns")).alias("listed")
    )
    known = steps(rule_changes, keys)
    return known.groupBy(*keys).agg(F.array_sort(F.collect_list(version)).alias("versions"))


def in_force(versions: Column | str, at: Column) -> Column:
    """The version in force at ``at``; null before the first one and after a removal."""
    versions = F.col(versions) if isinstance(versions, str) else versions
    at = F.coalesce(at, F.lit(_AFTER_ALL))
    last = F.get(F.filter(versions, lambda v: v["since"] <= at), F.size(F.filter(versions, lambda v: v["since"] <= at)) - 1)
    return F.when(last["op"] != "d", last)


def _ruled(changes: DataFrame, log: DataFrame, names: dict[str, str], ts: str) -> DataFrame:
    keyed = log.withColumnsRenamed(names)
    at = F.col(ts).cast("bigint") * MILLIS
    joined = changes.join(keyed, list(names.values()))
    return joined.withColumn("_rule", in_force("versions", at)).drop("versions").where(F.col("_rule").isNotNull())


def route_dimensions_at(changes: DataFrame, log: DataFrame, database: str, ts: str = "ts") -> DataFrame:
    """``routing.route_dimensions`` with the rule in force at each row's time."""
    kept = dim_changes(changes, database)
    carried = [c for c in changes.columns if c not in ("database", "table", "type", "old", "data")]
    ruled = _ruled(kept, log, {"source_table": "table"}, ts)
    return ruled.select(
        F.col("_rule.sink_table").alias("sink_table"),
        F.col("_rule.sink_family").alias("sink_family"),
        F.expr("data[_rule.sink_row_key]").alias("row_key"),
        F.col("type").alias("op_type"),
        keep_listed(F.col("data"), F.col("_rule.listed")).alias("data"),
        *carried,
    )


def route_facts_at(changes: DataFrame, log: DataFrame, database: str, ts: str = "ts") -> DataFrame:
    """``routing.route_facts`` with the rule in force at each row's time."""
    kept = fact_changes(changes, database)
    carried = [c for c in changes.columns if c not in ("database", "table", "type", "old", "data")]
    ruled = _ruled(kept, log, {"source_table": "table", "source_type": "type"}, ts)
    return ruled.select(
        F.col("_rule.sink_table").alias("sink_table"),
        keep_listed(F.col("data"), F.col("_rule.listed")).alias("data"),
        *carried,
    )


def generations(rule_changes: DataFrame) -> DataFrame:
    """Per target table the times it was emptied, oldest first, and whether it is ``present`` now.

    A removal or an update of a rule empties its target, and so does moving the rule away; ``r`` and ``c`` create the
    target if it is absent.  A table's generation at a time is the number of these times up to then, so dropping a
    table is one row here and touches none of its cells.
    """
    moved = (F.col("op") == "u") & F.coalesce(F.col("old_sink_table") != F.col("sink_table"), F.lit(False))
    here = F.struct("sink_table", "op")
    left = F.struct(F.col("old_sink_table").alias("sink_table"), F.lit("d").alias("op"))
    events = rule_changes.select(
        F.col("ts_ms").cast("bigint").alias("ts_ms"), F.col("seq").cast("bigint").alias("seq"),
        F.explode(F.when(moved, F.array(left, here)).otherwise(F.array(here))).alias("_s"),
    ).select("ts_ms", "seq", "_s.*")
    emptied = F.col("op").isin("d", "u")
    return events.groupBy("sink_table").agg(
        F.array_sort(F.collect_list(F.when(emptied, F.col("ts_ms")))).alias("emptied"),
        (F.max(F.struct("ts_ms", "seq", "op"))["op"] != "d").alias("present"),
    )


def with_generation(rows: DataFrame, tables: DataFrame, ts: str = "ts") -> DataFrame:
    """Adds the ``generation`` of each row's ``sink_table`` at the row's time; 0 for tables never emptied."""
    at = F.coalesce(F.col(ts).cast("bigint") * MILLIS, F.lit(_AFTER_ALL))
    joined = rows.join(tables.select("sink_table", "emptied"), "sink_table", "left")
    passed = F.size(F.filter(F.coalesce("emptied", F.array().cast("array<bigint>")), lambda t: t <= at))
    return joined.withColumn("generation", passed).drop("emptied")


def of_living_tables(cells: DataFrame, tables: DataFrame) -> DataFrame:
    """``cells`` of each table's newest generation; tables that are dropped have none."""
    now = tables.select("sink_table", F.size("emptied").alias("_now"), "present")
    joined = cells.join(now, "sink_table", "left")
    fits = F.col("present").isNull() | (F.col("present") & (F.col("generation") == F.col("_now")))
    return joined.where(fits).drop("_now", "present")
