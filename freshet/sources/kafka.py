"""Topics as string streams.

Only options are built here; the Kafka connector is Spark's own package.  The
``text`` readers give the same one-column frame from files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_options(
    servers: str,
    topic: str,
    group: str,
    start: str = "latest",
    max_per_batch: int = 5_000_000,
) -> dict[str, str]:
    """``max_per_batch`` bounds what one micro-batch may bring to a single key."""
    if start not in ("latest", "earliest"):
        raise ValueError(f"unknown start position {start!r}")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "kafka.group.id": group,
        "startingOffsets": start,
        "maxOffsetsPerTrigger": str(max_per_batch),
        "kafka.isolation.level": "read_committed",
    }


def read_topic(spark: SparkSession, options: dict[str, str], numbered: bool = False) -> DataFrame:
    """The topic's values as text; null values (tombstones) are left out.

    ``numbered`` adds the offset as ``seq``, the order of a key's rows on equal times.
    """
    number = [F.col("offset").alias("seq")] if numbered else []
    return (
        spark.readStream.format("kafka")
        .options(**options)
        .load()
        .select(F.col("value").cast("string").alias("value"), *number)
        .where(F.col("value").isNotNull())
    )


def read_text_stream(spark: SparkSession, path: str, files_per_batch: int = 64) -> DataFrame:
    return (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", files_per_batch)
        .load(path)
    )


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
