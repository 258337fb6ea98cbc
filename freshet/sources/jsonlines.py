"""JSON text to typed rows, with the unreadable lines kept apart.

A line is read as the only element of a JSON array.  That makes the reader
look at the whole line: text after the object, or a second object, is an error
and not silently dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _elements(text: Column, kind: T.DataType) -> Column:
    return F.from_json(F.concat(F.lit("["), text, F.lit("]")), T.ArrayType(kind))


def _only(elements: Column) -> Column:
    """The line's object, or null if the line is not exactly one object."""
    return F.when(F.size(elements) == 1, elements[0])


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df.withColumn(name, value)`` with ``value`` worked out once a row.

    The optimizer copies a column's expression into each filter and field that reads it, and the line would be parsed
    anew for each; it does not look through ``explode``.
    """
    others = [F.col(column) for column in df.columns if column != name]
    return df.select(*others, F.explode(F.array(value)).alias(name))


def is_json_object(text: Column | str) -> Column:
    """Whether the text is one well-formed JSON object."""
    text = F.col(text) if isinstance(text, str) else text
    return _only(_elements(text, T.MapType(T.StringType(), T.StringType()))).isNotNull()


def well_formed(lines: DataFrame) -> DataFrame:
    return lines.where(is_json_object("value"))


def malformed(lines: DataFrame) -> DataFrame:
    """The lines ``well_formed`` leaves out, for a second output."""
    return lines.where(~is_json_object("value"))


def checked(lines: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()) -> DataFrame:
    """Every line with its ``row`` or the ``error`` that keeps it from being one, in one pass.

    Errors: ``empty`` (null or blank), ``malformed`` (not exactly one object), ``missing <field>`` (the first of
    ``required`` that is absent, null or of another type).  A field of another type than expected is null; a number
    written as text is accepted.  Columns beside ``value`` are carried.
    """

    def is_number(field: T.StructField) -> bool:
        return isinstance(field.dataType, T.LongType)

    relaxed = T.StructType(
        [T.StructField(f.name, T.StringType() if is_number(f) else f.dataType) for f in schema]
    )
    text = once(lines, "value", F.col("value")).select(*lines.columns)
    read = once(text, "_all", _elements(F.col("value"), relaxed)).withColumn("_raw", _only(F.col("_all"))).drop("_all")
    fields = [
        (F.col("_raw")[f.name].try_cast(f.dataType) if is_number(f) else F.col("_raw")[f.name])
        .alias(f.name)
        for f in schema
    ]
    typed = read.withColumn("row", F.when(F.col("_raw").isNotNull(), F.struct(*fields))).drop("_raw")
    error = F.when(F.length(F.trim(F.coalesce("value", F.lit("")))) == 0, "empty").when(
        F.col("row").isNull(), "malformed"
    )
    for name in required:
        error = error.when(F.col("row")[name].isNull(), f"missing {name}")
    return typed.withColumn("error", error)


def good_rows(lines: DataFrame) -> DataFrame:
    """The rows of ``checked`` lines without an error; carried columns first."""
    carried = [name for name in lines.columns if name not in ("value", "row", "error")]
    return lines.where(F.col("error").isNull()).select(*carried, "row.*")


def bad_lines(lines: DataFrame) -> DataFrame:
    """The ``checked`` lines with an error, as they came."""
    return lines.where(F.col("error").isNotNull()).drop("row")


def every_line(lines: DataFrame) -> DataFrame:
    """All ``checked`` lines in one pass: carried columns, ``error``, and the row's fields, null where there is an error."""
    carried = [name for name in lines.columns if name not in ("value", "row", "error")]
    row = F.when(F.col("error").isNull(), F.col("row")).alias("row")
    return lines.select(*carried, "error", row).select(*carried, "error", "row.*")


def line_counts(lines: DataFrame) -> DataFrame:
    """How many ``checked`` lines are good (``error`` null) and how many have which error."""
    return lines.groupBy("error").agg(F.count(F.lit(1)).alias("lines"))


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Readable lines as ``schema``; see ``checked``."""
    return good_rows(checked(lines, schema))
