"""What one task or one key costs does not grow with the table."""

from pathlib import Path

from pyspark.sql import functions as F

from freshet.streaming import processors, replay, ruled, sinks


class State:
    def __init__(self, calls):
        self.calls, self.held = calls, []

    def exists(self):
        self.calls.append("exists")
        return bool(self.held)

    def get(self):
        self.calls.append("get")
        return iter(self.held)

    def put(self, rows):
        self.calls.append("put")
        self.held = list(rows)

    def clear(self):
        self.calls.append("clear")
        self.held = []


class Handle:
    def __init__(self):
        self.calls, self.timers = [], []

    def getListState(self, name, schema):
        self.state = State(self.calls)
        return self.state

    def registerTimer(self, at):
        self.calls.append("timer")
        self.timers.append(at)


class Now:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at

    getCurrentWatermarkInMs = getExpiryTimeInMs


def test_sessions_of_a_group_cost_few_state_calls():
    """A thousand sessions of two panes each; each is marked once, and the marks go when their hour is over."""
    handle, second = Handle(), 1_000_000
    machine = processors.SessionStart(["at"], ["sid", "at"], "sid", "string", 3600, 5)
    machine.init(handle)
    sids = [None, *[f"s{k}" for k in range(999)]]
    panes = [
        {"sid": sid, "at": at, "pane_end": at, "micros": at + k % 5}
        for k, sid in enumerate(sids) for at in (10 * second, (10 + k) * second + 3600 * second * (k % 2))
    ]
    got = list(machine.handleInputRows((1,), iter(panes), None))
    marked = {(row.sid, row.at) for row in got if row.starts}
    # every first pane, and the second ones of odd sessions, an hour and more later
    assert marked == {(sid, 10 * second) for sid in sids} | {
        (sid, (10 + k + 3600) * second) for k, sid in enumerate(sids) if k % 2
    }
    assert len(got) == 2000 and len(handle.state.held) == 1000
    list(machine.handleExpiredTimer((1,), Now(min(handle.timers)), Now(min(handle.timers))))
    assert len(handle.state.held) < 1000
    list(machine.handleExpiredTimer((1,), Now(10**10), Now(max(handle.timers))))
    assert handle.state.held == []
    assert len(handle.calls) < 20


def test_a_slice_is_read_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(replay, "FILE_ROWS", 10)
    spark.range(100).select("id", F.col("id").alias("ts")).coalesce(1).write.parquet(str(tmp_path / "table"))
    out = replay.replay(spark, "slices", str(tmp_path / "table"), [], lambda rows: rows, batches=2)
    fed = list(Path(out.removeprefix("file:")).parent.glob("fed/*.parquet"))
    assert len(fed) >= 10
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(100))


def test_changes_are_taken_out_of_a_batch_by_all_tasks(spark, tmp_path, monkeypatch):
    plans, append = [], ruled.RunStore.append

    def seen(store, rows, batch_id):
        if batch_id >= 0:
            plans.append(rows._jdf.queryExecution().logical().toString())
        append(store, rows, batch_id)

    monkeypatch.setattr(ruled.RunStore, "append", seen)
    line = '{"op": "c", "after": {"dic_code": "1", "dic_name": "n"}, "ts_ms": 1}'
    batch = spark.createDataFrame([(ruled.RULES, line, None)], "feed string, value string, seq bigint")
    write = ruled.by_dictionary_of_the_time(
        str(tmp_path), None, lambda rows, names: rows.select("ts"), sinks.to_parquet(str(tmp_path / "rows"))
    )
    write(batch, 0)
    assert plans and all("Repartition 1, true" in plan for plan in plans)
