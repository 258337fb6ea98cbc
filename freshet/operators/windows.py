"""Windowed counts.

``groupBy(window)`` aggregates partially on every task before its shuffle, so
a global window is not one task's work.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import DATE, window_labels


def tumbling(
    df: DataFrame,
    ts: str,
    size: str,
    measures: Sequence[Column],
    by: Sequence[str] = (),
    date_pattern: str = DATE,
) -> DataFrame:
    """Window labels, ``by`` columns and ``measures`` per window."""
    grouped = df.groupBy(F.window(ts, size).alias("window"), *by).agg(*measures)
    made = [name for name in grouped.columns if name != "window" and name not in by]
    return grouped.select(*window_labels("window", date_pattern), *by, *made)


def total(column: Column | str, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(name)


def sliding_counts(
    df: DataFrame, ts: str, by: Sequence[str], panes: int, slide_seconds: int, name: str
) -> DataFrame:
    """Counts in half-open windows of ``panes`` slides, one starting every slide.

    Rows are first counted per slide-sized pane, so that what is copied into
    ``panes`` windows is counts and not rows.  On a stream, where a window's
    state is a count anyway, the built-in sliding window is used.
    """
    by = list(by)
    slide = f"{slide_seconds} seconds"
    if df.isStreaming:
        length = f"{panes * slide_seconds} seconds"
        counted = df.groupBy(*by, F.window(ts, length, slide).alias("w")).agg(
            F.count(F.lit(1)).alias(name)
        )
        return counted.select(
            *by, F.col("w.start").alias("start"), F.col("w.end").alias("end"), name
        )
    per_pane = df.groupBy(*by, F.window(ts, slide).alias("pane")).agg(
        F.count(F.lit(1)).alias("n")
    )
    starts = F.transform(
        F.sequence(F.lit(0), F.lit(panes - 1)),
        lambda back: F.col("pane.start") - F.make_dt_interval(secs=back * slide_seconds),
    )
    spread = per_pane.select(*by, "n", F.explode(starts).alias("start"))
    length = F.make_dt_interval(secs=F.lit(panes * slide_seconds))
    return (
        spread.groupBy(*by, "start")
        .agg(F.sum("n").cast("bigint").alias(name))
        .select(
            *by,
            "start",
            (F.col("start") + length).alias("end"),
            name,
        )
    )
