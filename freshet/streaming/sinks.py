"""Where results go.

A batch writer puts each micro-batch into its own folder, named by the batch
number and overwritten if the batch is run again, so a retry leaves no
duplicates.  Readers see all folders as one table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.packing import packed_order
from freshet.operators import log_split
from freshet.operators.dimension import cells, covered_dropped, latest_cells, live_cells
from freshet.operators.rule_log import of_living_tables
from freshet.sources import jsonlines
from freshet.sources.snapshots import snake_columns
from freshet.streaming.run_store import RunStore

BatchWriter = Callable[[DataFrame, int], None]


def kafka_options(servers: str, topic: str | None = None) -> dict[str, str]:
    """Writer options; without a topic, each row's ``topic`` column decides."""
    options = {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.transaction.timeout.ms": str(15 * 60 * 1000),
    }
    if topic is not None:
        options["topic"] = topic
    return options


def as_messages(
    df: DataFrame, key: Sequence[str] = (), topic: str | None = None
) -> DataFrame:
    """Rows as (``topic``, ``key``, ``value``): JSON text, keyed for upserts.

    ``topic`` names the column that holds the target; it and ``op_type`` are
    not part of the value.
    """
    hidden = {topic, "op_type"}
    value = F.to_json(F.struct(*[c for c in df.columns if c not in hidden]))
    columns = [F.col(topic).alias("topic")] if topic else []
    if key:
        columns.append(F.concat_ws("\u0001", *key).alias("key"))
    return df.select(*columns, value.alias("value"))


def latest_by_key(changes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """An upsert log read as a table: each key's last row, unless it was removed.

    ``removed`` marks tombstones.  ``order`` is a time or number and, if need be, a second one that tells a key's rows
    apart (without it their hash does); a row that is repeated counts once.  The
    newest order of each key is found by a hash aggregate over keys and order alone; whole rows only meet that.
    """
    rest = [c for c in changes.columns if c not in keys]
    tie = F.xxhash64(*rest) if len(order) == 1 else None
    numbered = changes.withColumn("_order", packed_order(changes, order, tie))
    newest = numbered.groupBy(*keys).agg(F.max("_order").alias("_newest"))
    newest = newest.withColumnsRenamed({key: f"_n_{key}" for key in keys})
    same = F.col("_order") == F.col("_newest")
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_n_{key}"))
    last = numbered.join(newest, same).where(~F.col("removed"))
    return last.select(*keys, *[c for c in rest if c != "removed"]).distinct()


def upsert_table(messages: DataFrame, schema: T.StructType) -> DataFrame:
    """Messages (``key``, ``value``, ``ts``, ``seq``) of an upsert topic as a table; a null value removes its key."""
    log = messages.select("key", "value", F.col("value").isNull().alias("removed"), "ts", "seq")
    return jsonlines.parse(latest_by_key(log, ["key"], ["ts", "seq"]), schema)


def after(step: Callable[[DataFrame], DataFrame], writer: BatchWriter) -> BatchWriter:
    """Applies ``step`` to each micro-batch before it is written.

    What ``step`` reads, such as the rules or the dictionary, is read anew for
    every batch, so a change takes effect with the next one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        writer(step(batch), batch_id)

    return write


def parsed(
    schema: T.StructType,
    required: tuple[str, ...],
    rows: BatchWriter,
    bad: BatchWriter,
    counts: BatchWriter | None = None,
) -> BatchWriter:
    """Parses each batch of lines once: rows to one output, bad lines to a second, their numbers to a third."""

    def write(batch: DataFrame, batch_id: int) -> None:
        lines = jsonlines.checked(batch, schema, required).persist()
        try:
            rows(jsonlines.good_rows(lines), batch_id)
            bad(jsonlines.bad_lines(lines), batch_id)
            if counts is not None:
                counts(jsonlines.line_counts(lines), batch_id)
        finally:
            lines.unpersist()

    return write


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch_id={batch_id}"


def to_json_lines(path: str, hidden: Sequence[str] = ()) -> BatchWriter:
    """One JSON line per row with snake_case names, for the OLAP store."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = snake_columns(batch.drop(*hidden))
        rows.write.mode("overwrite").json(_folder(path, batch_id))

    return write


OLAP_FILE_BYTES = 128 << 20


def _line_store(spark: SparkSession, path: str, full_bytes: int = OLAP_FILE_BYTES, **options) -> RunStore:
    return RunStore(spark, path, lambda rows: rows.coalesce(1), full_bytes=full_bytes, kind="json", **options)


def to_olap_lines(path: str, hidden: Sequence[str] = (), **options) -> BatchWriter:
    """JSON lines with snake_case names for the OLAP store, each batch once, rolled up into files of a good size.

    Small batches gather in one file until it has ``full_bytes``; see ``RunStore``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = snake_columns(batch.drop(*hidden))
        _line_store(batch.sparkSession, path, **options).append(rows, batch_id)

    return write


def read_olap_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines of all committed batches; None before the first."""
    return _line_store(spark, path).read()


def to_parquet(path: str) -> BatchWriter:
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_folder(path, batch_id))

    return write


def to_topics(path: str) -> BatchWriter:
    """(``topic``, ``value``) rows into one folder per topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("topic").text(_folder(path, batch_id))

    return write


def to_kafka(options: dict[str, str]) -> BatchWriter:
    """Messages of each batch to the topics; a retry sends them again."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("kafka").options(**options).save()

    return write


def split_to_topics(path: str) -> BatchWriter:
    """The behaviour log's five outputs, from one pass over each batch."""
    to_folder = to_topics(path)

    def write(batch: DataFrame, batch_id: int) -> None:
        to_folder(log_split.tagged(batch), batch_id)

    return write


CELL_KEYS = ("sink_table", "generation", "row_key")


def _cell_store(spark: SparkSession, path: str, **options) -> RunStore:
    return RunStore(spark, path, merged_cells, by=["sink_table"], **options)


def merged_cells(all_cells: DataFrame) -> DataFrame:
    """Cells of several runs put together: the last write of each, without those a later delete of their row covers."""
    return covered_dropped(latest_cells(all_cells, CELL_KEYS), CELL_KEYS).select(*all_cells.columns)


def to_dimension_cells(path: str, order: Sequence[str], **options) -> BatchWriter:
    """Routed change rows into the dimension store, folded once per batch; see ``RunStore`` for the store.

    Rows without a ``generation`` are of generation 0.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if "generation" not in batch.columns:
            batch = batch.withColumn("generation", F.lit(0))
        folded = latest_cells(cells(batch, order, ["sink_table", "generation", "row_key"]), CELL_KEYS)
        _cell_store(batch.sparkSession, path, **options).append(folded, batch_id)

    return write


def read_dimension_cells(
    spark: SparkSession, path: str, resets: DataFrame | None = None, tables: DataFrame | None = None
) -> DataFrame:
    """The dimension store's live cells; deletes and resets are applied on read.

    With ``tables`` (see ``rule_log.generations``) only cells of each table's newest generation live.
    """
    stored = _cell_store(spark, path).read()
    if stored is None:
        stored = spark.createDataFrame([], "sink_table string, generation int, row_key string, col string, value string, at struct<ts:bigint>")
    if tables is not None:
        stored = of_living_tables(stored, tables)
    return live_cells(stored, resets, CELL_KEYS).drop("generation")


def compact_dimension_cells(spark: SparkSession, path: str, into: str) -> None:
    """The store folded to one entry per cell, as the first run of a new store to go on from."""
    stored = _cell_store(spark, path).read()
    if stored is not None:
        _cell_store(spark, into).append(merged_cells(stored), 0)


def start(
    df: DataFrame,
    state: str,
    writer: BatchWriter | None = None,
    *,
    mode: str = "append",
    available_now: bool = True,
    every: str = "5 seconds",
) -> StreamingQuery:
    """Starts a stream into ``writer``; without one, rows go to the console."""
    out = df.writeStream.outputMode(mode).option("checkpointLocation", state)
    out = out.foreachBatch(writer) if writer else out.format("console")
    out = (
        out.trigger(availableNow=True) if available_now else out.trigger(processingTime=every)
    )
    return out.start()
