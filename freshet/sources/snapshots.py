"""Configuration tables and the dictionary: snapshots and their changes."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.sources.jsonlines import parse


def camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(part.capitalize() for part in rest)


def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", name).lower()


def camel_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[camel(name) for name in df.columns])


def snake_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[snake(name) for name in df.columns])


def jdbc_options(url: str, query: str, user: str, password: str, driver: str) -> dict[str, str]:
    return {"url": url, "query": query, "user": user, "password": password, "driver": driver}


def read_snapshot(spark: SparkSession, options: dict[str, str], rename: bool = False) -> DataFrame:
    """Rows of a database query; ``rename`` turns snake_case into camelCase."""
    rows = spark.read.format("jdbc").options(**options).load()
    return camel_columns(rows) if rename else rows


def rule_changes(lines: DataFrame, rule: T.StructType) -> DataFrame:
    """Captured changes of a rule table.

    The row is the one before a delete and the one after any other change; the columns before it have ``old_`` in
    front.  ``ts_ms`` is the time of the change.  Columns beside ``value``, such as an offset, are carried.
    """
    event = T.StructType(
        [
            T.StructField("op", T.StringType()),
            T.StructField("before", rule),
            T.StructField("after", rule),
            T.StructField("ts_ms", T.LongType()),
        ]
    )
    carried = [name for name in lines.columns if name != "value"]
    rows = parse(lines, event).where(F.col("op").isNotNull())
    row = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    old = [F.col(f"before.{name}").alias(f"old_{name}") for name in rule.names]
    return rows.select(*carried, "op", "ts_ms", row.alias("_row"), *old).select(
        *carried, "op", "ts_ms", *[f"old_{name}" for name in rule.names], "_row.*"
    )


def dictionary(entries: DataFrame, code: str, name: str) -> DataFrame:
    """Any two columns as the dictionary ``base_dic``."""
    return entries.select(
        F.col(code).cast("string").alias("dic_code"),
        F.struct(F.col(name).alias("dic_name")).alias("info"),
    )
