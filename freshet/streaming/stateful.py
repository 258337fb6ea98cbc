"""DataFrame operators over the state machines in ``processors``.

The input must carry a watermark on its event-time column; the output carries
it on, so a window can follow.

Rows are first aggregated to one per key and pane of event time, in the JVM.  Spark keeps the panes in its state store and
hands each on when the watermark has passed its end, so a pane that comes later is later in event time too: how rows are
spread over micro-batches, one row each or all at once, does not change the result.  The event time of what comes out is
the last instant of its pane.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators.pattern import MESSAGE
from freshet.streaming.processors import DaySeen, FirstVisit, FollowedBy, SessionStart

SESSION_TTL_SECONDS = 3600
#: Divides every metric's window, and no day begins inside a pane.
PANE_SECONDS = 5
#: Over how many groups sessions are spread; a group's marks are one entry of state.  A checkpoint keeps its number.
SESSION_GROUPS = 4096


def _schema(df: DataFrame, *extra: T.StructField) -> T.StructType:
    """The frame's plain fields (no watermark metadata) and some more."""
    fields = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType([*fields, *extra])


def _keyed(df: DataFrame, keys: Sequence[str], ts: str, processor, schema) -> DataFrame:
    return df.groupBy(*keys).transformWithState(
        statefulProcessor=processor,
        outputStructType=schema,
        outputMode="Append",
        timeMode="EventTime",
        eventTimeColumnName=ts,
    )


def _pane(ts: str) -> Column:
    return F.window(ts, f"{PANE_SECONDS} seconds")


def panes(df: DataFrame, keys: Sequence[str], ts: str, *measures: Column) -> DataFrame:
    """One row per key and pane: the keys, ``at`` (the pane's last instant, with the watermark), ``day``, ``measures``."""
    made = df.groupBy(*keys, _pane(ts).alias("_pane")).agg(*measures)
    named = [name for name in made.columns if name not in (*keys, "_pane")]
    return made.select(
        *keys,
        F.window_time("_pane").alias("at"),
        F.unix_date(F.col("_pane.start").cast("date")).alias("day"),
        *named,
    )


def day_seen(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """The rows, one per key and pane, whose ``day`` differs from the key's last one, ``prev_day``; ``ts`` is the pane's."""
    keys = list(keys)
    per_pane = panes(df, keys, ts, F.count(F.lit(1)).alias("_n")).drop("_n")
    schema = _schema(per_pane, T.StructField("prev_day", T.IntegerType()))
    seen = _keyed(per_pane, keys, "at", DaySeen(["at"], per_pane.columns), schema)
    changed = seen.where(~F.col("day").eqNullSafe(F.col("prev_day")))
    return changed.select(
        *keys, F.col("at").alias(ts), *[F.date_from_unix_date(name).alias(name) for name in ("day", "prev_day")]
    )


def repair_new_visitors(log: DataFrame, ts: str, tie: Sequence[str] = ()) -> DataFrame:
    """Sets ``common['is_new']`` to 0 where a device was first seen on another day.

    Only one row per device and pane passes through the state machine; the log rows wait in a join for their pane's first
    day.  Rows without a device or without a time come out unchanged; late rows are dropped.  ``ts`` becomes the last
    instant of the row's pane, with the watermark.
    """
    common = F.col("common")
    device = log.withColumn("_mid", common["mid"])
    flag = common["is_new"]
    first = F.min(F.when(flag.isin("0", "1"), F.struct(F.col(ts).alias("_t"), *tie, flag.alias("flag")))).alias("_first")
    per_pane = panes(device.where(F.col("_mid").isNotNull()), ["_mid"], ts, first)
    per_pane = per_pane.select("_mid", "at", "day", F.col("_first.flag").alias("flag"))
    schema = _schema(per_pane, T.StructField("first_day", T.IntegerType()))
    known = _keyed(per_pane, ["_mid"], "at", FirstVisit(["at"], per_pane.columns), schema)
    known = known.select(F.col("_mid").alias("_device"), F.col("at").alias("_until"), "day", "first_day")
    waiting = device.withColumn("_at", F.window_time(_pane(ts))).drop(ts)
    joined = waiting.join(known, (F.col("_mid") == F.col("_device")) & (F.col("_at") == F.col("_until")))
    wrong = (flag == "1") & (F.col("day") != F.col("first_day"))
    fixed = F.transform_values("common", lambda key, value: F.when(key == "is_new", F.lit("0")).otherwise(value))
    names = [name for name in log.columns if name not in (ts, "common")]
    repaired = joined.select(F.when(wrong, fixed).otherwise(common).alias("common"), *names, F.col("_at").alias(ts))
    unknown = log.where(common["mid"].isNull() | F.col(ts).isNull())
    return repaired.select(*log.columns).unionByName(unknown.select(*log.columns))


def first_of_day_and_session(
    facts: DataFrame,
    device: str,
    session: str,
    by: Sequence[str],
    ts: str,
    order: Sequence[str],
    micros: str,
    *measures: Column,
    ttl_seconds: int = SESSION_TTL_SECONDS,
) -> DataFrame:
    """Panes of (device, session, ``by``) with ``measures``; ``uv`` marks a device's first of the day, ``starts`` a session's.

    Among the rows of a pane the earliest by ``order`` takes the mark.  ``micros`` is a row's time in microseconds.
    """
    keys = [device, session, *by]
    first = F.min(F.struct(*order, F.col(micros).alias("_micros"))).alias("_first")
    per_pane = panes(facts, keys, ts, first, *measures)
    made = [name for name in per_pane.columns if name not in (*keys, "at", "day", "_first")]
    ranked = [F.col(f"_first.{name}").alias(f"_o{k}") for k, name in enumerate(order)]
    flat = per_pane.select(*keys, "at", "day", *made, *ranked, F.col("_first._micros").alias("micros"))
    sorted_by = ["at", *[f"_o{k}" for k in range(len(order))]]
    seen = _keyed(
        flat, [device], "at", DaySeen(sorted_by, flat.columns), _schema(flat, T.StructField("prev_day", T.IntegerType()))
    )
    marked = seen.withColumn("uv", (~F.col("day").eqNullSafe(F.col("prev_day"))).cast("int")).drop("day", "prev_day")
    marked = marked.withColumn("pane_end", F.unix_micros("at"))
    session_type = marked.schema[session].dataType.simpleString()
    processor = SessionStart(sorted_by, marked.columns, session, session_type, ttl_seconds, PANE_SECONDS)
    grouped = marked.withColumn("_group", F.pmod(F.xxhash64(session), F.lit(SESSION_GROUPS)))
    out = _keyed(grouped, ["_group"], "at", processor, _schema(marked, T.StructField("starts", T.IntegerType())))
    return out.drop("pane_end", *sorted_by[1:])


def followed_by(
    events: DataFrame,
    user: str,
    ts: str,
    kind: str,
    tie: str,
    first: str,
    second: str,
    within_seconds: int,
) -> DataFrame:
    """Streaming form of ``operators.pattern.followed_by``."""
    staged = events.select(
        F.col(user).alias("user_id"),
        F.col(ts),
        F.unix_micros(F.col(ts)).alias("micros"),
        F.col(tie).cast("bigint").alias("tie"),
        F.col(kind).alias("kind"),
    ).where(F.col(ts).isNotNull())
    user_type = staged.schema["user_id"].dataType
    out = T.StructType(
        [
            T.StructField("user_id", user_type),
            T.StructField("first_micros", T.LongType()),
            T.StructField("second_micros", T.LongType()),
            T.StructField("message", T.StringType()),
        ]
    )
    alerts = staged.groupBy("user_id").transformWithState(
        statefulProcessor=FollowedBy(first, second, within_seconds, MESSAGE),
        outputStructType=out,
        outputMode="Append",
        timeMode="EventTime",
    )
    return alerts.select(
        "user_id",
        F.timestamp_micros("first_micros").alias("first_ts"),
        F.timestamp_micros("second_micros").alias("second_ts"),
        "message",
    )
