import json

from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import log_split
from freshet.sources import logs
from freshet.streaming import sinks

DAY = 86_400_000
D1 = 1_704_067_200_000  # 2024-01-01 UTC


def entry(mid, is_new, ts, **more):
    return {"common": {"mid": mid, "is_new": is_new, "ch": "app"}, "ts": ts, **more}


LOG = [
    entry("a", "1", D1, start={"entry": "icon"}),
    entry("a", "1", D1 + 1000, page={"page_id": "home"},
          displays=[{"item": "1", "ch": "shown"}, {"item": "2"}],
          actions=[{"action_id": "fav", "ts": 77}], err={"code": "5"}),
    entry("a", "1", D1 + DAY, page={"page_id": "home"}),  # a day later: not new
    entry("b", "0", D1, page={"page_id": "list"}),  # old from the start
    entry("b", "1", D1 + 5, page={"page_id": "list"}),  # so this is not new either
    entry("c", "0", D1 + DAY, page={"page_id": "list"}),
    entry("c", "1", D1, page={"page_id": "list"}),  # first by time, and truly new
]


def fixed(lines):
    return log_split.repair_new_visitors(logs.behavior_log(lines(*LOG, "bad")), ["ts"])


def test_new_visitors_are_repaired(lines):
    got = rows(fixed(lines), F.col("common")["mid"], "ts", F.col("common")["is_new"])
    assert got == sorted(
        [("a", D1, "1"), ("a", D1 + 1000, "1"), ("a", D1 + DAY, "0"), ("b", D1, "0"),
         ("b", D1 + 5, "0"), ("c", D1 + DAY, "0"), ("c", D1, "1")],
        key=repr,
    )


def test_five_outputs(lines):
    parts = log_split.split(fixed(lines))
    assert set(parts) == set(log_split.OUTPUTS)
    assert {name: df.count() for name, df in parts.items()} == {
        "start": 1, "display": 2, "action": 1, "err": 1, "page": 6,
    }
    shown = [r.record for r in parts["display"].collect()]
    assert {r["item"] for r in shown} == {"1", "2"}
    assert all(r["ch"] == "app" and r["ts"] == str(D1 + 1000) for r in shown)  # common wins
    assert parts["action"].first().record["ts"] == "77"  # its own time stays
    assert "displays" not in parts["err"].columns and "err" in parts["err"].columns
    assert "err" not in parts["page"].columns


def test_one_pass_split_gives_the_same_records(lines):
    log = fixed(lines)
    got = rows(log_split.tagged(log).groupBy("topic").count())
    assert got == [
        ("dwd_traffic_action", 1), ("dwd_traffic_display", 2), ("dwd_traffic_err", 1),
        ("dwd_traffic_page", 6), ("dwd_traffic_start", 1),
    ]
    tagged = {
        topic: sorted(json.dumps(json.loads(v), sort_keys=True) for t, v in rows(log_split.tagged(log)) if t == topic)
        for topic, _ in got
    }
    for name, df in log_split.split(log).items():
        apart = sorted(json.dumps(json.loads(r.value), sort_keys=True) for r in log_split.as_json(df).collect())
        assert tagged[f"dwd_traffic_{name}"] == apart


def test_split_sink_writes_topics_once_per_batch(spark, lines, tmp_path):
    writer = sinks.split_to_topics(str(tmp_path / "topics"))
    log = fixed(lines)
    writer(log, 0)
    writer(log, 0)  # a batch run again leaves no duplicates
    got = spark.read.text(str(tmp_path / "topics"))
    assert got.count() == 11
