"""An order of one or two columns as one number of fixed width.

The least or largest row of a key is then found by a hash aggregate; a struct or a text would make Spark sort.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Stands before every number; an order column may be up to 2^62 away from zero.
_NONE = -(2**62)


def _whole(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = F.unix_micros(F.col(name).cast("timestamp"))
    elif isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        value = F.col(name).cast("bigint")
    else:
        raise TypeError(f"{name} is neither a time nor a whole number")
    return F.coalesce(value, F.lit(_NONE)).cast("decimal(20,0)")


def packed_order(df: DataFrame, order: Sequence[str], tie: Column | None = None) -> Column:
    """``order`` as a number that sorts alike; nulls come first.  ``tie`` (a bigint) follows a single column."""
    if len(order) > 2 or (len(order) == 2 and tie is not None):
        raise ValueError("at most two columns make an order")
    if len(order) == 2:
        second = _whole(df, order[1])
    else:
        second = (F.lit(0) if tie is None else tie).cast("decimal(20,0)")
    return (_whole(df, order[0]) * F.lit(str(2**64)).cast("decimal(20,0)") + second).cast("decimal(38,0)")
