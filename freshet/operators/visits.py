"""Who was seen when: daily uniques, first-ever and returning keys.

Two forms of the same rule, "a row counts when its day differs from the day
the key was last seen":

* ``daily_first`` for rows in event-time order.  Days then only grow, so the
  counted rows are the earliest per key and day.  That is one partial
  aggregate, and the days of a key are few enough for a window.
* ``day_changes`` for any arrival order, where days may go back and forth and
  each change counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freshet.functions.packing import packed_order
from freshet.operators.ordered import neighbour_value

#: More than there are days.
_DAYS = 1_000_000


def day_of(ts: Column | str) -> Column:
    ts = F.col(ts) if isinstance(ts, str) else ts
    return ts.cast("date")


def daily_first(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """One row per key and day: ``ts`` of the first hit, ``day``, ``prev_day``.

    On a stream, rows are taken in order of event time too, at a grain of five seconds: ``ts`` is then the last instant
    of the five seconds the first hit is in.
    """
    keys = list(keys)
    if df.isStreaming:
        from freshet.streaming.stateful import day_seen

        return day_seen(df.select(*keys, ts), keys, ts)
    days = df.groupBy(*keys, day_of(ts).alias("day")).agg(F.min(ts).alias(ts))
    seen = Window.partitionBy(*keys).orderBy("day")
    return days.withColumn("prev_day", F.lag("day").over(seen))


def first_rows(
    df: DataFrame, keys: Sequence[Column | str], order: Sequence[str], keep: Sequence[str]
) -> DataFrame:
    """The earliest row per key, with columns ``order`` and ``keep``."""
    fields = list(dict.fromkeys([*order, *keep]))
    return (
        df.groupBy(*keys)
        .agg(F.min(F.struct(*fields)).alias("_first"))
        .select("_first.*")
    )


def day_changes(
    df: DataFrame, keys: Sequence[str], ts: str, order: Sequence[str], chunk: Column
) -> DataFrame:
    """Adds ``day``, ``prev_day`` and ``changed`` to every row, in arrival order."""
    dated = df.withColumn("day", day_of(ts))
    return neighbour_value(
        dated, keys, order, F.col("day"), chunk, "prev_day"
    ).withColumn("changed", ~F.col("day").eqNullSafe(F.col("prev_day")))


def is_new() -> Column:
    """1 for a key never seen before."""
    return F.when(F.col("prev_day").isNull(), 1).otherwise(0)


def is_returning(min_gap_days: int) -> Column:
    """1 for a key back after at least ``min_gap_days`` days."""
    gap = F.datediff(F.col("day"), F.col("prev_day"))
    return F.when(gap >= min_gap_days, 1).otherwise(0)


def new_visitor_first_days(log: DataFrame, order: Sequence[str]) -> DataFrame:
    """Per device (``_mid``) the day it counts as first seen, ``_first_day``, and its number of rows, ``_n``.

    The first row with a visitor flag decides: a new visitor's own day, or the day before for a device that was already
    old; without one the day is null.  Order, flag and day are one number, so this is a hash aggregate over one scan.
    """
    flag = F.col("common")["is_new"]
    day = F.unix_date(F.to_date(F.timestamp_millis("ts")))
    first_day = F.when(flag == "1", day).otherwise(day - 1).cast("decimal(38,0)")
    # times in milliseconds take 43 bits; with the second order column (64) and the day (20) they stay below 10^38
    days = F.lit(_DAYS).cast("decimal(7,0)")
    packed = (packed_order(log, order) * days + first_day + F.lit(_DAYS // 2)).cast("decimal(38,0)")
    decides = flag.isin("0", "1") & F.col(order[0]).isNotNull()
    return (
        log.select(F.col("common")["mid"].alias("_mid"), F.when(decides, packed).alias("_p"))
        .groupBy("_mid")
        .agg(F.min("_p").alias("_p"), F.count(F.lit(1)).alias("_n"))
        .select("_mid", F.date_from_unix_date((F.pmod("_p", days) - F.lit(_DAYS // 2)).cast("int")).alias("_first_day"), "_n")
    )
