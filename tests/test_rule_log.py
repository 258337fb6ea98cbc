"""Versions of rules, and the store that grows by batches."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import rule_log
from freshet.schemas import DIM_RULE, FACT_RULE
from freshet.sources import logs, snapshots
from freshet.streaming.run_store import RunStore
from freshet.streaming.shared_files import SharedFiles


def event(op, ts_ms, before=None, after=None):
    return {"op": op, "ts_ms": ts_ms, "before": before, "after": after}


def fact(kind, target, columns="id"):
    return {"source_table": "t", "source_type": kind, "sink_table": target, "sink_columns": columns}


def change(kind, ts, seq):
    return {"database": "shop", "table": "t", "type": kind, "data": {"id": str(seq), "x": "y"}, "ts": ts}


def parsed(lines, *events, rule=FACT_RULE):
    return snapshots.rule_changes(lines(*events).withColumn("seq", F.monotonically_increasing_id()), rule)


def test_each_row_takes_the_rule_of_its_time(spark, lines):
    known = parsed(
        lines,
        event("c", 10_000, None, fact("insert", "a")),
        event("u", 20_000, fact("insert", "a"), fact("update", "b", "id,x")),  # moves to another key
        event("u", 30_000, fact("update", "b"), fact("update", "c")),
        event("d", 40_000, fact("update", "c"), None),
        event("c", 40_000, None, fact("update", "d")),  # same time, later in the log
    )
    early = spark.createDataFrame([("t", "update", "early", "id")], FACT_RULE)
    log = rule_log.rule_log(known.unionByName(rule_log.as_changes(early)), rule_log.FACT_KEYS)
    changes = logs.change_log(lines(
        *[change(kind, ts, ts) for kind in ("insert", "update") for ts in (0, 9, 10, 19, 20, 29, 30, 39, 40, 99)],
        change("update", None, 7), {**change("update", 50, 8), "database": "other"},
    ))
    got = rule_log.route_facts_at(changes, log, "shop").select("ts", "sink_table", F.size("data").alias("n"))
    assert rows(got) == sorted([
        (0, "early", 1), (9, "early", 1), (10, "early", 1), (19, "early", 1), (10, "a", 1), (19, "a", 1),
        (20, "b", 2), (29, "b", 2), (30, "c", 1), (39, "c", 1), (40, "d", 1), (99, "d", 1), (None, "d", 1),
    ], key=repr)
    assert rule_log.route_facts_at(changes, log.limit(0), "shop").count() == 0


def test_generations_follow_drops_moves_and_updates(spark, lines):
    def dim(target):
        return {"source_table": target, "sink_table": target, "sink_columns": "a", "sink_family": "i", "sink_row_key": "a"}

    known = parsed(
        lines, event("r", 0, None, dim("kept")), event("c", 1, None, dim("gone")), event("d", 5, dim("gone")),
        event("u", 6, dim("moved"), dim("target")), event("u", 7, dim("target"), dim("target")), event("c", 9, None, dim("gone2")),
        event("d", 10, dim("gone2")), event("c", 11, None, dim("gone2")), rule=DIM_RULE,
    )
    lives = rule_log.generations(known)
    got = {r.sink_table: (r.emptied, r.present) for r in lives.collect()}
    assert got == {"kept": ([], True), "gone": ([5], False), "moved": ([6], False), "target": ([6, 7], True), "gone2": ([10], True)}
    data = spark.createDataFrame([("target", None), ("kept", 1), ("unknown", 1)], "sink_table string, ts bigint")
    assert rows(rule_log.with_generation(data, lives), "sink_table", "generation") == [("kept", 0), ("target", 2), ("unknown", 0)]


def test_run_store_stays_in_few_runs_and_adds_batches_once(spark, tmp_path):
    store = RunStore(spark, str(tmp_path / "s"), lambda d: d.groupBy("k").agg(F.sum("n").alias("n")).coalesce(1), fan_in=3, grace=2)
    files = SharedFiles(spark)
    for number in range(40):
        batch = spark.range(1).select(F.lit(number % 2).alias("k"), F.lit(1).cast("bigint").alias("n"))
        store.append(batch, number)
        store.append(batch, number)  # a retry
        runs = store.manifest()["runs"]
        assert len(runs) <= 2 * (1 + math.ceil(math.log(number + 1, 3)))
    assert rows(store.read().groupBy("k").agg(F.sum("n"))) == [(0, 20), (1, 20)]
    kept = files.names(f"{store.path}/runs")
    assert len(kept) <= len(runs) + 3 * 2 * 2  # replaced runs go after two commits
    assert len(files.names(f"{store.path}/manifest")) <= 6


def test_a_manifest_is_never_overwritten(spark, tmp_path):
    files = SharedFiles(spark)
    path = str(tmp_path / "m" / "1.json")
    assert files.create(path, "one") and not files.create(path, "two")
    assert files.read(path) == "one" and files.names(str(tmp_path / "m")) == ["1.json"]
    store = RunStore(spark, str(tmp_path / "s"))
    old = store.manifest()
    store.append(spark.range(2), 0)
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(old, None, [], [])
