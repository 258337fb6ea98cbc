"""Fact joins, interval joins and dictionary lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.operators.rule_log import in_force
from freshet.operators.skew import skew_join

#: Over how many parts a stream join spreads the rows of one key; the other side's rows are kept that often.
STREAM_SALTS = 4
#: Over how many parts rows without a key are spread; nothing is copied for them.
NULL_SALTS = 64


def fact_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    bound_seconds: int,
    sample_of: DataFrame | None = None,
    left_unique: bool = False,
) -> DataFrame:
    """Equi-join of two fact frames that both carry event time ``et``.

    On batch frames all rows are there, so no time bound is needed.  On
    streams a row waits for partners whose event time is at most
    ``bound_seconds`` away; the watermark then frees its state, and an
    unmatched outer row is emitted once.  ``left_unique`` says that ``keys`` are
    the left side's primary key, so no key can be hot; otherwise a key's state is spread over
    ``STREAM_SALTS`` parts, as which keys are hot cannot be counted beforehand.  Rows without a key, which an outer join
    has to hold, are spread too.  The right side's ``et`` (and ``ts``) are dropped, which chained stream joins require.
    """
    keys = list(keys)
    if not (left.isStreaming or right.isStreaming):
        right = right.drop("et", "ts")
        if left_unique:
            return left.join(right, keys, how)
        return skew_join(left, right, keys, how, sample_of=sample_of)
    left, renamed = _salted(left, right.drop("ts"), keys, 1 if left_unique else STREAM_SALTS)
    for key in keys:
        renamed = renamed.withColumnRenamed(key, f"_r_{key}")
    renamed = renamed.withColumnRenamed("et", "_r_et")
    bound = F.expr(f"interval {bound_seconds} seconds")
    matched = (F.col("_r_et") >= F.col("et") - bound) & (
        F.col("_r_et") <= F.col("et") + bound
    )
    for key in keys:
        matched &= F.col(key) == F.col(f"_r_{key}")
    matched &= F.col("_salt") == F.col("_r_salt")
    joined = left.join(renamed, matched, "left_outer" if how == "left" else how)
    return joined.drop("_r_et", "_salt", "_r_salt", *[f"_r_{key}" for key in keys])


def _salted(left: DataFrame, right: DataFrame, keys: list[str], salts: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of a stream join with a part of the key's state: ``_salt`` on the left, every ``_r_salt`` on the right."""
    plain = [c for c, kind in left.dtypes if not kind.startswith("map")]
    number = F.xxhash64(*plain)
    unkeyed = F.greatest(*[F.col(key).isNull() for key in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    salt = F.when(unkeyed, F.pmod(number, F.lit(NULL_SALTS))).otherwise(F.pmod(number, F.lit(salts)))
    every = F.array(*[F.lit(k).cast("bigint") for k in range(salts)])
    return left.withColumn("_salt", salt), right.withColumn("_r_salt", F.explode(every))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    lower_seconds: int,
    upper_seconds: int,
    left_time: str = "et",
    right_time: str = "right_et",
    sample_of: DataFrame | None = None,
) -> DataFrame:
    """Pairs of equal keys with ``right_time`` in
    ``[left_time - lower, left_time + upper]``.

    On batch frames time is cut into buckets as long as the interval.  A right
    row is in one bucket and a left row looks into at most two, so no pair is
    found twice, and one busy key is spread over its buckets instead of being
    paired with itself over all time.  ``sample_of`` is a cheaper frame with
    the right side's keys and time.
    """
    keys = list(keys)
    lower = F.expr(f"interval {lower_seconds} seconds")
    upper = F.expr(f"interval {upper_seconds} seconds")
    near = (F.col(right_time) >= F.col(left_time) - lower) & (
        F.col(right_time) <= F.col(left_time) + upper
    )
    if left.isStreaming or right.isStreaming:
        # which side is busy is not known; the right one is spread
        renamed, left = _salted(right, left, keys, STREAM_SALTS)
        matched = near & (F.col("_salt") == F.col("_r_salt"))
        for key in keys:
            renamed = renamed.withColumnRenamed(key, f"_r_{key}")
            matched &= F.col(key) == F.col(f"_r_{key}")
        return left.join(renamed, matched, "inner").drop("_salt", "_r_salt", *[f"_r_{k}" for k in keys])

    width = max(1, lower_seconds + upper_seconds) * 1_000_000

    def bucket(column):
        return F.floor(F.unix_micros(column.cast("timestamp")) / F.lit(width))

    looks = left.withColumn(
        "_bucket",
        F.explode(
            F.sequence(bucket(F.col(left_time) - lower), bucket(F.col(left_time) + upper))
        ),
    )
    def place(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", bucket(F.col(right_time)))

    return (
        skew_join(
            place(right),
            looks,
            [*keys, "_bucket"],
            sample_of=None if sample_of is None else place(sample_of),
        )
        .where(near)
        .drop("_bucket")
    )


def lookup(df: DataFrame, dictionary: DataFrame, code: str, name: str) -> DataFrame:
    """Adds ``name`` from the dictionary; rows with an unknown code vanish.

    Whether the dictionary is broadcast follows from its measured bytes.
    """
    entries = dictionary.select(
        F.col("dic_code").alias(code), F.col("info.dic_name").alias(name)
    )
    return df.join(entries, code, "inner")


def dictionary_versions_of(changes: DataFrame) -> DataFrame:
    """One row per code with its ``versions`` (``since`` in milliseconds, ``op``, ``dic_name``), oldest first.

    ``changes`` has ``dic_code, dic_name, op, ts_ms, seq``; a ``d`` removes a code.
    """
    version = F.struct(F.col("ts_ms").alias("since"), "seq", "op", "dic_name")
    return changes.groupBy("dic_code").agg(F.array_sort(F.collect_list(version)).alias("versions"))


def lookup_at(df: DataFrame, versions: DataFrame, code: str, name: str, ts: str = "ts") -> DataFrame:
    """``lookup`` with the name that held at each row's time ``ts`` (seconds), so a renamed code changes later rows only."""
    entries = versions.withColumnsRenamed({"dic_code": code, "versions": "_versions"})
    at = F.col(ts).cast("bigint") * 1000
    found = df.join(entries, code, "inner").withColumn("_now", in_force("_versions", at)).where(F.col("_now").isNotNull())
    return found.withColumn(name, F.col("_now.dic_name")).drop("_versions", "_now")
