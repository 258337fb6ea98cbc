"""Runs a streaming job over a stored table and hands back what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.session import ROCKSDB_PROVIDER, run_dir
from freshet.streaming import sinks

# Fixed value: later than any row, so that its arrival closes every window.
CLOSING_TIME = "2200-01-01 00:00:00"

NO_DATA_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"

#: A slice is written in files of at most so many rows.  A file in one row group is read by one task, however large it is.
FILE_ROWS = 10_000


@contextmanager
def _settings(spark: SparkSession, state_partitions: int | None) -> Iterator[None]:
    """State is cut into ``state_partitions``, or at most one per core, as each costs
    a store and a Python worker per batch; the session's settings come back after."""
    usual = {key: spark.conf.get(key) for key in (NO_DATA_BATCHES, PARTITIONS)}
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set(PARTITIONS, str(state_partitions or min(int(usual[PARTITIONS]), max(cores, 1))))
    try:
        yield
    finally:
        for key, value in usual.items():
            spark.conf.set(key, value)


def use_rocksdb(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)


def _time_slices(rows: DataFrame, time: str, slices: int) -> list[Callable[[Column], Column]]:
    """Conditions that cut rows by event time into about equal slices of ``rows``, earliest first.

    Equal times stay together; rows without a time are in the first slice.
    """
    shares = [k / slices for k in range(1, slices)]
    cuts = sorted(set(rows.agg(F.percentile_approx(time, shares)).first()[0] or [])) if shares else []
    edges = [None, *cuts, None]

    def between(low, high):
        def holds(at: Column) -> Column:
            inside = F.lit(True) if high is None else at <= F.lit(high)
            return F.coalesce(inside if low is None else (at > F.lit(low)) & inside, F.lit(low is None))

        return holds

    return [between(low, high) for low, high in zip(edges, edges[1:], strict=False)]


def replay(
    spark: SparkSession,
    name: str,
    path: str,
    closing: list[dict],
    job: Callable[..., DataFrame],
    *,
    writer: Callable[[str], sinks.BatchWriter] = sinks.to_parquet,
    files_per_batch: int = 64,
    time: str = "ts",
    state_partitions: int | None = None,
    batches: int | None = None,
    beside: Mapping[str, DataFrame] | None = None,
) -> str:
    """Streams the parquet table at ``path`` through ``job``; returns the output path.

    A table of up to ``files_per_batch`` files is one micro-batch.  A larger one is
    cut by ``time`` into slices of about as many files, which arrive one after the
    other, so how rows are spread over files does not change what is late.  Then the
    ``closing`` rows arrive and the query goes on from its checkpoint, which closes
    the last windows.  A checkpoint keeps its number of ``state_partitions``.

    ``batches`` asks for so many slices whatever the number of files.  Each table of ``beside`` becomes a stream that
    ``job`` takes by its name; its rows arrive with the slice that holds their ``time``.
    """
    use_rocksdb(spark)
    table = spark.read.parquet(path)
    schema = table.schema
    folder = run_dir(spark, name)
    late = f"{folder}/closing"
    spark.createDataFrame([], schema).write.parquet(late)
    beside = dict(beside or {})
    batches = batches or -(-len(table.inputFiles()) // files_per_batch)
    fed = f"{folder}/fed" if batches > 1 else path

    def source(location: str, kind: T.StructType = schema) -> DataFrame:
        return spark.readStream.schema(kind).parquet(location)

    out = f"{folder}/rows"

    def run(to_the_end: bool) -> None:
        # A batch without rows only moves the watermark on; the last run does it.
        spark.conf.set(NO_DATA_BATCHES, str(to_the_end).lower())
        more = {name: source(f"{folder}/{name}", rows.schema) for name, rows in beside.items()}
        rows = job(source(fed).unionByName(source(late)), **more)
        sinks.start(rows, f"{folder}/state", writer(out)).awaitTermination()

    with _settings(spark, state_partitions):
        slices = _time_slices(table, time, batches)
        for k, holds in enumerate(slices):
            if batches > 1:
                rows = table.where(holds(F.col(time)))
                rows.write.option("maxRecordsPerFile", FILE_ROWS).mode("append").parquet(fed)
            for name, rows in beside.items():
                rows.where(holds(F.col(time))).write.mode("append").parquet(f"{folder}/{name}")
            run(not closing and k == len(slices) - 1)
        if closing:
            rows = [{field.name: row.get(field.name) for field in schema} for row in closing]
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(late)
            run(True)
    return out
