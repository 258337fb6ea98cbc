"""Time conversions and window labels.

Epoch numbers turn into text in the session time zone; text turns into epoch
numbers at a fixed offset, as the warehouse's own writers do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DATE = "yyyy-MM-dd"
COMPACT_DATE = "yyyyMMdd"
DATETIME = "yyyy-MM-dd HH:mm:ss"
WRITER_OFFSET = "+08:00"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def from_seconds(seconds: Column | str) -> Column:
    return F.timestamp_seconds(_col(seconds))


def from_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(_col(millis))


def millis_to_date(millis: Column | str) -> Column:
    return F.date_format(from_millis(millis), DATE)


def millis_to_datetime(millis: Column | str) -> Column:
    return F.date_format(from_millis(millis), DATETIME)


def millis_to_compact_date(millis: Column | str) -> Column:
    return F.date_format(from_millis(millis), COMPACT_DATE)


def datetime_to_timestamp(text: Column | str, offset: str = WRITER_OFFSET) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` written at ``offset``; null if it does not parse."""
    return F.try_to_timestamp(
        F.concat(_col(text), F.lit(offset)), F.lit("yyyy-MM-dd HH:mm:ssXXX")
    )


def datetime_to_millis(text: Column | str, offset: str = WRITER_OFFSET) -> Column:
    return F.unix_millis(datetime_to_timestamp(text, offset))


def date_to_millis(text: Column | str, offset: str = WRITER_OFFSET) -> Column:
    return datetime_to_millis(F.concat(_col(text), F.lit(" 00:00:00")), offset)


def date_of_text(text: Column | str) -> Column:
    """The ``yyyy-MM-dd`` part of a date or datetime string; null if it has none."""
    return F.date_format(_col(text).try_cast("date"), DATE)


def window_labels(window: str = "window", date_pattern: str = DATE) -> list[Column]:
    """``stt``, ``edt`` and ``cur_date`` of a window column, as text."""
    start, end = F.col(f"{window}.start"), F.col(f"{window}.end")
    return [
        F.date_format(start, DATETIME).alias("stt"),
        F.date_format(end, DATETIME).alias("edt"),
        F.date_format(start, date_pattern).alias("cur_date"),
    ]
