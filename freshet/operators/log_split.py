"""Cleaning of the behaviour log and its five outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.maps import overlay
from freshet.operators.skew import skew_join
from freshet.operators.visits import new_visitor_first_days

OUTPUTS = ("start", "display", "action", "err", "page")


def repair_new_visitors(log: DataFrame, order: list[str]) -> DataFrame:
    """Sets ``is_new`` to 0 where a device was first seen on another day."""
    firsts = new_visitor_first_days(log, order)
    keyed = log.withColumn("_mid", F.col("common")["mid"])
    joined = skew_join(keyed, firsts.drop("_n"), ["_mid"], "left", counts=firsts.select("_mid", "_n"))
    day = F.to_date(F.timestamp_millis("ts"))
    wrong = (F.col("common")["is_new"] == "1") & (day != F.col("_first_day"))
    fixed = F.transform_values(
        "common", lambda key, value: F.when(key == "is_new", F.lit("0")).otherwise(value)
    )
    return joined.withColumn(
        "common", F.when(wrong, fixed).otherwise(F.col("common"))
    ).drop("_mid", "_first_day")


def starts(log: DataFrame) -> DataFrame:
    """Start records, whole."""
    return log.where(F.col("start").isNotNull())


def displays(log: DataFrame) -> DataFrame:
    """One record per display, overlaid by the common fields and given ``ts``."""
    return log.select(
        *_carried(log), "ts", F.explode("displays").alias("_item"), "common"
    ).select(
        *_carried(log),
        overlay(
            overlay(F.col("_item"), F.col("common")),
            F.create_map(F.lit("ts"), F.col("ts").cast("string")),
        ).alias("record"),
    )


def actions(log: DataFrame) -> DataFrame:
    """One record per action, overlaid by the common fields; its own ``ts`` stays."""
    return log.select(
        *_carried(log), F.explode("actions").alias("_item"), "common"
    ).select(
        *_carried(log), overlay(F.col("_item"), F.col("common")).alias("record")
    )


def errors(log: DataFrame) -> DataFrame:
    """Records with an error, without displays and actions."""
    return log.where(F.col("err").isNotNull()).drop("displays", "actions")


def pages(log: DataFrame) -> DataFrame:
    """Page views, without displays, actions and error."""
    return log.where(F.col("page").isNotNull()).drop("displays", "actions", "err")


def _carried(log: DataFrame) -> list[str]:
    """Columns beside the log's own, such as an arrival number."""
    own = {"common", "start", "page", "displays", "actions", "err", "sid", "ts"}
    return [name for name in log.columns if name not in own]


def split(log: DataFrame) -> dict[str, DataFrame]:
    return {
        "start": starts(log),
        "display": displays(log),
        "action": actions(log),
        "err": errors(log),
        "page": pages(log),
    }


def as_json(df: DataFrame) -> DataFrame:
    """Each output row as one JSON text, the way it goes to a topic."""
    if "record" in df.columns:
        return df.select(F.to_json("record").alias("value"))
    return df.select(F.to_json(F.struct("*")).alias("value"))


def tagged(log: DataFrame) -> DataFrame:
    """All five outputs as (``topic``, ``value``) rows from one pass over the log."""
    record = {
        "start": F.to_json(F.struct(*_present(log, drop=()))),
        "err": F.to_json(F.struct(*_present(log, drop=("displays", "actions")))),
        "page": F.to_json(F.struct(*_present(log, drop=("displays", "actions", "err")))),
    }
    ts = F.create_map(F.lit("ts"), F.col("ts").cast("string"))

    def entry(topic, value):
        return F.struct(F.lit(f"dwd_traffic_{topic}").alias("topic"), value.alias("value"))

    none = F.array().cast("array<struct<topic:string,value:string>>")
    each_display = F.transform(
        "displays",
        lambda item: entry(
            "display", F.to_json(overlay(overlay(item, F.col("common")), ts))
        ),
    )
    each_action = F.transform(
        "actions", lambda item: entry("action", F.to_json(overlay(item, F.col("common"))))
    )
    parts = [
        F.when(F.col(name).isNotNull(), F.array(entry(name, record[name]))).otherwise(none)
        for name in ("start", "err", "page")
    ]
    out = F.concat(
        *parts, F.coalesce(each_display, none), F.coalesce(each_action, none)
    )
    return log.select(F.explode(out).alias("out")).select("out.*")


def _present(log: DataFrame, drop: tuple[str, ...]) -> list[str]:
    own = ("common", "start", "page", "displays", "actions", "err", "sid", "ts")
    return [name for name in own if name not in drop and name in log.columns]
