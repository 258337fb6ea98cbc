"""Joins whose heavy side may hold one key in a large share of its rows.

The heavy side's rows are counted per key first, partially on every task, from
the key columns alone.  A key with too many rows for one task is hot: its rows
are spread over sub-keys, one per ``rows_per_task`` rows, and only its partner
rows are copied.  Counts are exact and repeat exactly, so both sides always
agree on which keys are hot, also when tasks are run again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROWS_PER_TASK = 1_000_000

# Rows with a null key match nothing; they are spread this wide.
NULL_SPREAD = 4096


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))


def _hot(counts: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    return counts.where(F.col("_n") > rows_per_task).select(
        *keys, F.ceil(F.col("_n") / F.lit(rows_per_task)).cast("int").alias("_parts")
    )


def hot_keys(df: DataFrame, keys: Sequence[str], rows_per_task: int) -> DataFrame:
    """Hot keys and over how many sub-keys to spread each (``_parts``).

    Each stands for more than ``rows_per_task`` rows, so there are fewer of them
    than rows / ``rows_per_task``.
    """
    return _hot(_counted(df, keys), keys, rows_per_task)


def _hashable(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _hashable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_hashable(field.dataType) for field in kind.fields)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _spread(df: DataFrame, parts: Column) -> Column:
    """A sub-key from the row's own content: the same again if a task is rerun."""
    plain = [F.col(f.name) for f in df.schema.fields if _hashable(f.dataType)]
    return F.pmod(F.xxhash64(*plain), parts).cast("int")


def skew_join(
    heavy: DataFrame,
    light: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    *,
    sample_of: DataFrame | None = None,
    counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Equi-join on ``keys``, equal to ``heavy.join(light, keys, how)``.

    ``how`` is ``inner`` or ``left``.  ``sample_of`` is a cheaper frame with
    the same key columns to count in, such as the bare scan below a long plan;
    it should hold about as many rows per key as ``heavy``.  ``counts`` (keys and ``_n``) saves
    the count where the plan has it already.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"cannot copy the light side of a {how} join")
    keys = list(keys)
    if counts is None:
        counts = _counted(heavy if sample_of is None else sample_of, keys)
    # fewer than one row for ``rows_per_task`` of the heavy side; without the hint that side is shuffled once more to look them up
    hot = F.broadcast(_hot(counts, keys, rows_per_task))
    no_key = reduce(Column.__or__, [F.col(key).isNull() for key in keys])
    part = F.when(F.col("_parts").isNotNull(), _spread(heavy, F.col("_parts")))
    if how == "left":
        part = F.when(no_key, _spread(heavy, F.lit(NULL_SPREAD))).otherwise(part)
    spread = (
        heavy.join(hot, keys, "left")
        .withColumn("_part", F.coalesce(part, F.lit(0)))
        .drop("_parts")
    )
    last = F.coalesce(F.col("_parts"), F.lit(1)) - 1
    copied = (
        light.join(hot, keys, "left")
        .withColumn("_part", F.explode(F.sequence(F.lit(0), last)))
        .drop("_parts")
    )
    return spread.join(copied, [*keys, "_part"], how).drop("_part")
