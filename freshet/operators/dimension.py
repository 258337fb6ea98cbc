"""Keyed dimension tables as a fold over their change rows.

A put writes only non-null columns, so an older value survives a null update;
a delete removes the row with all its columns; dropping or re-creating a table
forgets all rows before.  Folding is aggregation only: per cell the last
non-null value, then per row and per table the last delete, so a busy row key
is pre-aggregated before each shuffle and nothing is joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.maps import without_nulls


ROW_KEYS = ("sink_table", "row_key")


def cells(routed: DataFrame, order: Sequence[str], keys: Sequence[str] = ROW_KEYS) -> DataFrame:
    """Routed change rows as cells (``sink_table, row_key, col, value, at``).

    A delete becomes one cell whose ``col`` is null.
    """
    at = F.struct(*[F.col(name) for name in order])
    written = F.map_entries(without_nulls(F.col("data")))
    deleted = F.array(
        F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))
    )
    return routed.select(
        *keys,
        at.alias("at"),
        F.explode(F.when(F.col("op_type") == "delete", deleted).otherwise(written)).alias("_e"),
    ).select(
        *keys,
        F.col("_e.key").alias("col"),
        F.col("_e.value").alias("value"),
        "at",
    )


def latest_cells(all_cells: DataFrame, keys: Sequence[str] = ROW_KEYS) -> DataFrame:
    """The last write of each cell; folding folded cells again is allowed."""
    return (
        all_cells.groupBy(*keys, "col")
        .agg(F.max(F.struct("at", "value")).alias("_last"))
        .select(*keys, "col", "_last.value", "_last.at")
    )


def covered_dropped(last: DataFrame, keys: Sequence[str] = ROW_KEYS) -> DataFrame:
    """Folded cells without those a later delete of their row covers; the deletes themselves stay."""
    deleted_at = F.max(F.when(F.col("col").isNull(), F.col("at"))).over(Window.partitionBy(*keys))
    kept = F.col("col").isNull() | F.col("_gone").isNull() | (F.col("at") > F.col("_gone"))
    return last.withColumn("_gone", deleted_at).where(kept).drop("_gone")


def live_cells(
    all_cells: DataFrame, resets: DataFrame | None = None, keys: Sequence[str] = ROW_KEYS
) -> DataFrame:
    """Cells written after their row's last delete and their table's last reset."""
    live = covered_dropped(latest_cells(all_cells, keys), keys).where(F.col("col").isNotNull())
    if resets is None:
        return live
    return (
        live.join(resets, "sink_table")
        .where("present")
        .where(F.col("reset_at").isNull() | (F.col("at") > F.col("reset_at")))
        .drop("present", "reset_at")
    )


def dimension_rows(live: DataFrame) -> DataFrame:
    """One row per row key, its columns as a map."""
    return live.groupBy("sink_table", "row_key").agg(
        F.map_from_entries(F.collect_list(F.struct("col", "value"))).alias("info")
    )


def dimension_table(live: DataFrame, table: str, columns: Sequence[str]) -> DataFrame:
    """One dimension as a typed table; ``columns`` are known from its rule."""
    picked = [
        F.max(F.when(F.col("col") == name, F.col("value"))).alias(name) for name in columns
    ]
    return live.where(F.col("sink_table") == table).groupBy("row_key").agg(*picked)


def table_lifecycle(rule_changes: DataFrame, at: Sequence[str]) -> DataFrame:
    """Which target tables exist, and since when they are empty.

    ``rule_changes`` has ``op``, ``sink_table``, ``old_sink_table`` (the target
    named by the row before an update) and the order columns ``at``.  A ``d``
    drops the table, ``r``/``c`` create it if absent, ``u`` drops and creates.
    """
    when = F.struct(*[F.col(name) for name in at])
    moved = (F.col("op") == "u") & (F.col("old_sink_table") != F.col("sink_table"))
    steps = F.concat(
        F.when(
            moved,
            F.array(
                F.struct(
                    F.col("old_sink_table").alias("sink_table"), F.lit("d").alias("op")
                )
            ),
        ).otherwise(F.array().cast("array<struct<sink_table:string,op:string>>")),
        F.array(F.struct(F.col("sink_table"), F.col("op"))),
    )
    events = rule_changes.select(when.alias("at"), F.explode(steps).alias("s")).select(
        "at", "s.*"
    )
    dropped = F.col("op").isin("d", "u")
    return events.groupBy("sink_table").agg(
        (F.max_by("op", "at") != "d").alias("present"),
        F.max(F.when(dropped, F.col("at"))).alias("reset_at"),
    )
