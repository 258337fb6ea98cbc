"""Change log, behaviour log, fact topics and event topics as typed frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import datetime_to_timestamp, from_millis, from_seconds
from freshet.schemas import (
    BEHAVIOR,
    CHANGE,
    METRIC_COLUMNS,
    METRIC_EVENT,
    ORDER_DETAIL_FACT,
    SHOP_EVENT,
)
from freshet.sources.jsonlines import parse

#: What a line of each log must have to be a row of it.
CHANGE_NEEDS = ("table", "type", "ts")
BEHAVIOR_NEEDS = ("common", "ts")
SHOP_NEEDS = ("userId", "eventType")
METRIC_NEEDS = ("event_time",)

FACT_DELAY = "3 seconds"
SUMMARY_DELAY = "5 seconds"
METRIC_DELAY = "1 second"


def watermarked(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Bounded out-of-orderness; it only matters on streams.

    Rows later than that are dropped by the windows and joins that follow.  The
    watermark is the newest time over all partitions, so an idle partition
    does not hold it back.
    """
    return df.withWatermark(column, delay) if df.isStreaming else df


def change_log(lines: DataFrame) -> DataFrame:
    """``topic_db``: change rows with event time ``et`` and processing time ``pt``."""
    rows = parse(lines, CHANGE).where(F.col("table").isNotNull())
    return watermarked(with_times(rows), "et", FACT_DELAY)


def with_times(changes: DataFrame) -> DataFrame:
    return changes.withColumn("et", from_seconds("ts")).withColumn(
        "pt", F.current_timestamp()
    )


def behavior_log(lines: DataFrame) -> DataFrame:
    """The app log: one row per readable line."""
    return parse(lines, BEHAVIOR)


def page_log(lines: DataFrame) -> DataFrame:
    """Page views with event time ``et``."""
    rows = parse(lines, BEHAVIOR).where(F.col("page").isNotNull())
    return watermarked(rows.withColumn("et", from_millis("ts")), "et", SUMMARY_DELAY)


def order_detail_facts(lines: DataFrame, delay: str = FACT_DELAY) -> DataFrame:
    """The order-detail topic re-read; tombstones carry no value and are left out."""
    rows = parse(lines.where(F.col("value").isNotNull()), ORDER_DETAIL_FACT)
    return watermarked(rows.withColumn("et", from_seconds("ts")), "et", delay)


def metric_rows(events: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Metric events cut to the used columns, with event time ``et``."""
    return events.select(*carried, *METRIC_COLUMNS).withColumn("et", datetime_to_timestamp("event_time"))


def metric_events(lines: DataFrame) -> DataFrame:
    """Metric events cut to the used columns, with event time ``et``."""
    return watermarked(metric_rows(parse(lines, METRIC_EVENT)), "et", METRIC_DELAY)


def shop_event_time() -> Column:
    """Each event type has its own time field."""
    return F.coalesce(
        *[
            F.try_to_timestamp(F.col(name))
            for name in ("loginTime", "redemptionTime", "browseTime", "purchaseTime")
        ]
    )


def shop_rows(events: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Shop events as ``user_id, event_type, et``."""
    return events.select(
        *carried,
        F.col("userId").alias("user_id"),
        F.col("eventType").alias("event_type"),
        shop_event_time().alias("et"),
    )


def shop_events(lines: DataFrame, delay: str = "5 seconds") -> DataFrame:
    """Shop events as ``user_id, event_type, et``."""
    return watermarked(shop_rows(parse(lines, SHOP_EVENT)), "et", delay)
