"""The row before or after, per key, without holding a whole key in one task.

A plain ``lag`` sorts all rows of a key in one task.  Here the order is cut
into chunks: neighbours inside a chunk come from a window over (key, chunk),
and the value that crosses a chunk border travels as one marker row, found
from a pre-aggregated summary with one row per key and chunk.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def neighbour_value(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    chunk: Column,
    name: str,
    ahead: bool = False,
) -> DataFrame:
    """Adds ``name``: ``value`` of the previous (or next) row of the same key.

    ``order`` must be total within a key for a repeatable answer.  ``chunk``
    must never fall as ``order`` rises.
    """
    keys, order = list(keys), list(order)
    rank = [F.col(c).desc() if ahead else F.col(c).asc() for c in order]
    rows = df.select(
        "*",
        chunk.alias("_chunk"),
        F.struct(value.alias("v")).alias("_value"),
        F.lit(1).alias("_is_row"),
    )

    edge = F.min_by if ahead else F.max_by
    edges = (
        rows.select(*keys, *[c for c in order if c not in keys], "_chunk", "_value")
        .groupBy(*keys, "_chunk")
        .agg(edge("_value", F.struct(*order)).alias("_edge"))
    )
    chunk_rank = F.col("_chunk").desc() if ahead else F.col("_chunk").asc()
    across = Window.partitionBy(*keys).orderBy(chunk_rank)
    markers = (
        edges.withColumn("_value", F.lag("_edge").over(across))
        .where(F.col("_value").isNotNull())
        .select(*keys, "_chunk", "_value", F.lit(0).alias("_is_row"))
    )

    inside = Window.partitionBy(*keys, "_chunk").orderBy("_is_row", *rank)
    return (
        rows.unionByName(markers, allowMissingColumns=True)
        .withColumn(name, F.lag("_value").over(inside)["v"])
        .where(F.col("_is_row") == 1)
        .drop("_chunk", "_value", "_is_row")
    )


def time_chunk(ts: Column | str, seconds: int = 3600) -> Column:
    """Chunk number of a timestamp."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.floor(F.unix_micros(ts.cast("timestamp")) / F.lit(seconds * 1_000_000))


def number_chunk(number: Column | str, size: int = 1_000_000) -> Column:
    """Chunk number of an arrival number."""
    number = F.col(number) if isinstance(number, str) else number
    return F.floor(number / F.lit(size))
