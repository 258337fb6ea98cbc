"""Routing by rules that change while the job runs.

Rule changes and change rows come in one stream, so one checkpoint covers both.  Each micro-batch first adds its rule
changes to a log in the job's folder and then routes its rows by the versions in force at their times.  A batch that is
run again adds nothing twice and routes alike.  A rule change that arrives after rows of its time leaves those rows as
they were routed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.operators import joins, rule_log
from freshet.schemas import CHANGE, DICTIONARY_ENTRY, DIM_RULE, FACT_RULE
from freshet.sources import logs, snapshots
from freshet.sources.jsonlines import parse
from freshet.streaming.run_store import RunStore
from freshet.streaming.sinks import BatchWriter

RULES, ROWS = "rules", "rows"


@dataclass(frozen=True)
class Kind:
    rule: T.StructType
    keys: Sequence[str]
    route: Callable[[DataFrame, DataFrame, str], DataFrame]
    #: Whether target tables have a life of their own: created, emptied, dropped by rule changes.
    tables: bool


DIMENSIONS = Kind(DIM_RULE, rule_log.DIM_KEYS, rule_log.route_dimensions_at, True)
FACTS = Kind(FACT_RULE, rule_log.FACT_KEYS, rule_log.route_facts_at, False)


def fed(rows: DataFrame, rules: DataFrame) -> DataFrame:
    """Lines of both feeds as one stream (``feed, value, seq``); ``seq`` is null where the source has no numbers."""

    def of(lines: DataFrame, feed: str) -> DataFrame:
        seq = F.col("seq") if "seq" in lines.columns else F.lit(None)
        return lines.select(F.lit(feed).alias("feed"), "value", seq.cast("bigint").alias("seq"))

    return of(rows, ROWS).unionByName(of(rules, RULES))


def rules_of(spark: SparkSession, folder: str) -> DataFrame | None:
    """All rule changes the job at ``folder`` has seen, its snapshot among them; None before the first."""
    return RunStore(spark, f"{folder}/rules", lambda rows: rows.coalesce(1)).read()


def by_rules_in_force(
    kind: Kind, folder: str, snapshot: Callable[[], DataFrame] | None, database: str, writer: BatchWriter
) -> BatchWriter:
    """Routes each batch of ``fed`` lines and hands the routed rows to ``writer``.

    ``snapshot`` is read once, before the first batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        store = RunStore(spark, f"{folder}/rules", lambda rows: rows.coalesce(1))
        batch.persist()
        try:
            lines = batch.where(F.col("feed") == RULES).select("value", "seq")
            changes = snapshots.rule_changes(lines, kind.rule)
            if snapshot is not None and not store.manifest()["runs"]:
                store.append(rule_log.as_changes(snapshot()).select(*changes.columns).coalesce(1), -1)
            if not changes.isEmpty():
                store.append(changes.repartition(1), batch_id)  # coalesced, one task would read the whole batch
            known = store.read()
            if known is None:
                return
            rows = parse(batch.where(F.col("feed") == ROWS).select("value", "seq"), CHANGE)
            rows = logs.with_times(rows.where(F.col("table").isNotNull()))
            routed = kind.route(rows, rule_log.rule_log(known, kind.keys), database)
            if kind.tables:
                routed = rule_log.with_generation(routed, rule_log.generations(known))
            writer(routed, batch_id)
        finally:
            batch.unpersist()

    return write


def by_dictionary_of_the_time(
    folder: str,
    entries: Callable[[], DataFrame] | None,
    job: Callable[[DataFrame, DataFrame], DataFrame],
    writer: BatchWriter,
) -> BatchWriter:
    """``job`` over each batch of ``fed`` lines with the dictionary's versions known by then.

    The second feed brings captured changes of the dictionary table.  They are kept in the job's folder like rule
    changes; ``entries`` is read once, before the first batch.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        store = RunStore(batch.sparkSession, f"{folder}/dictionary", lambda rows: rows.coalesce(1))
        batch.persist()
        try:
            lines = batch.where(F.col("feed") == RULES).select("value", "seq")
            changes = snapshots.rule_changes(lines, DICTIONARY_ENTRY)
            if entries is not None and not store.manifest()["runs"]:
                first = entries().select("dic_code", F.col("info.dic_name").alias("dic_name"))
                store.append(rule_log.as_changes(first).select(*changes.columns).coalesce(1), -1)
            if not changes.isEmpty():
                store.append(changes.repartition(1), batch_id)  # coalesced, one task would read the whole batch
            known = store.read()
            if known is None:
                return
            rows = parse(batch.where(F.col("feed") == ROWS).select("value", "seq"), CHANGE)
            rows = logs.with_times(rows.where(F.col("table").isNotNull()))
            writer(job(rows, joins.dictionary_versions_of(known)), batch_id)
        finally:
            batch.unpersist()

    return write
