"""Two events right after one another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.ordered import neighbour_value, time_chunk

# Fixed value: the text of an alert.
MESSAGE = "Suspicious behavior detected"


def followed_by(
    events: DataFrame,
    user: str,
    ts: str,
    kind: str,
    tie: str,
    first: str,
    second: str,
    within_seconds: int,
    chunk_seconds: int = 60,
) -> DataFrame:
    """Alerts where a user's ``first`` event is directly followed by ``second``.

    Directly: no other event of the user lies between.  The gap must be less
    than ``within_seconds``.  A user's events are looked at minute by minute.
    """
    staged = events.select(
        F.col(user).alias("user_id"),
        F.col(ts).alias("first_ts"),
        F.col(tie).alias("_tie"),
        F.col(kind).alias("_kind"),
    )
    paired = neighbour_value(
        staged,
        ["user_id"],
        ["first_ts", "_tie"],
        F.struct(F.col("first_ts").alias("ts"), F.col("_kind").alias("kind")),
        time_chunk("first_ts", chunk_seconds),
        "_next",
        ahead=True,
    )

    def micros(column):
        return F.unix_micros(column.cast("timestamp"))

    gap = micros(F.col("_next.ts")) - micros(F.col("first_ts"))
    return paired.where(
        (F.col("_kind") == first)
        & (F.col("_next.kind") == second)
        & (gap < within_seconds * 1_000_000)
    ).select(
        "user_id",
        "first_ts",
        F.col("_next.ts").alias("second_ts"),
        F.lit(MESSAGE).alias("message"),
    )
