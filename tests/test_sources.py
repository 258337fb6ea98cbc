from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import rows
from freshet.schemas import DIM_RULE
from freshet.sources import jsonlines, kafka, logs, snapshots
from freshet.streaming import sinks


def test_malformed_lines_are_kept_apart(lines):
    df = lines('{"a": 1}', "bad {", "", None, "[1]", "null", '{"a": 1} x', "{}")
    good = rows(jsonlines.well_formed(df))
    assert good == [('{"a": 1}',), ("{}",)]
    assert jsonlines.malformed(df).count() == 6


def test_change_log_skips_unreadable_rows(lines):
    df = lines(
        {"database": "d", "table": "t", "type": "insert", "data": {"a": 1, "b": None}, "ts": 5},
        {"database": "d", "table": "t", "type": "update", "data": {}, "old": {"a": "x"}, "ts": "7"},
        "nonsense",
        {"other": 1},
    )
    got = logs.change_log(df)
    assert rows(got, "type", "ts", F.unix_seconds("et")) == [("insert", 5, 5), ("update", 7, 7)]
    data = {r.type: r.data for r in got.collect()}
    assert data["insert"] == {"a": "1", "b": None}


def test_behavior_and_page_log(lines):
    df = lines(
        {"common": {"mid": "m"}, "page": {"page_id": "home", "during_time": 12}, "ts": 1000},
        {"common": {"mid": "m"}, "start": {"entry": "icon"}, "ts": 2000},
        "}",
    )
    assert logs.behavior_log(df).count() == 2
    page = logs.page_log(df).collect()
    assert len(page) == 1 and page[0].page["during_time"] == "12"


def test_order_detail_facts_leave_out_tombstones(lines):
    got = logs.order_detail_facts(lines({"id": "1", "order_id": "9", "ts": 3}, None))
    assert rows(got, "id", "order_id", "ts") == [("1", "9", 3)]


def test_metric_events_are_cut_and_read_at_plus_eight(lines):
    event = {
        "event_id": "e", "user_id_int": 4, "event_name": "LOGIN_SUCCESS", "event_level": "x",
        "event_time": "2024-01-01 08:00:01",
        "event_context": {"device": {"ip": "1.1.1.1"}, "product": {"price": 9.5}},
    }
    got = logs.metric_events(lines(event))
    assert "event_level" not in got.columns
    assert rows(got, "user_id_int", F.unix_seconds("et"), "event_context.device.ip") == [
        (4, 1704067201, "1.1.1.1")
    ]


def test_shop_events_use_the_types_own_time_field(lines):
    got = logs.shop_events(
        lines(
            {"eventType": "login", "userId": "1", "loginTime": "2024-03-02T10:15:30Z"},
            {"eventType": "quickPurchase", "userId": "1", "purchaseTime": "2024-03-02T10:21:00Z"},
        )
    )
    assert rows(got, "event_type", "et") == [
        ("login", datetime(2024, 3, 2, 10, 15, 30)),
        ("quickPurchase", datetime(2024, 3, 2, 10, 21)),
    ]


def test_rule_changes_take_before_on_delete(lines):
    rule = {"source_table": "t", "sink_table": "s", "sink_columns": "a", "sink_family": "i",
            "sink_row_key": "a"}
    got = snapshots.rule_changes(
        lines(
            {"op": "d", "before": rule, "after": None},
            {"op": "u", "before": rule, "after": {**rule, "sink_table": "s2"}},
        ),
        DIM_RULE,
    )
    assert rows(got, "op", "sink_table", "old_sink_table") == [("d", "s", "s"), ("u", "s2", "s")]


def test_names():
    assert snapshots.camel("sink_row_key") == "sinkRowKey"
    assert snapshots.snake("sinkRowKey") == "sink_row_key"
    assert snapshots.snake("stt") == "stt"


def test_kafka_options():
    got = kafka.read_options("b:1", "topic_db", "g", max_per_batch=10)
    assert got["subscribe"] == "topic_db" and got["startingOffsets"] == "latest"
    assert got["maxOffsetsPerTrigger"] == "10" and got["kafka.group.id"] == "g"
    assert kafka.read_options("b", "t", "g", "earliest")["startingOffsets"] == "earliest"


def test_snapshot_rename(spark):
    df = spark.createDataFrame([(1,)], "source_table int")
    assert snapshots.camel_columns(df).columns == ["sourceTable"]
    assert snapshots.snake_columns(snapshots.camel_columns(df)).columns == ["source_table"]


def test_checked_lines_say_what_is_wrong(lines):
    schema = T.StructType.fromDDL("a string, n bigint, m map<string,string>")
    df = lines('{"a":"x","n":"7","m":{"k":1}}', "", None, "  ", "bad {", '{"a":"x"} {"a":"y"}', "[]", '{"n":1}', '{"a":"x"}',
               '{"a":"x","n":"seven"}', '{"a":"x","n":2,"m":3}')
    got = jsonlines.checked(df, schema, ("a", "n"))
    assert rows(jsonlines.good_rows(got)) == sorted([("x", 2, None), ("x", 7, {"k": "1"})], key=repr)
    assert rows(jsonlines.line_counts(got)) == sorted(
        [(None, 2), ("empty", 3), ("malformed", 3), ("missing a", 1), ("missing n", 2)], key=repr)
    assert jsonlines.bad_lines(got).count() == 9
    assert jsonlines.line_counts(jsonlines.checked(df.limit(0), schema)).count() == 0


def test_a_line_is_parsed_once_whatever_reads_it(lines):
    schema = T.StructType.fromDDL("a string, n bigint, m map<string,string>")
    df = lines('{"a":"x","n":"7","m":{"k":1}}', "bad {", None, '{"n":1}')
    got = jsonlines.checked(df, schema, ("a", "n"))
    every = jsonlines.every_line(got)
    for read in (every, jsonlines.good_rows(got).where((F.col("a") == "x") & (F.col("n") > 1))):
        assert read._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
    assert rows(every) == sorted(
        [(None, "x", 7, {"k": "1"}), ("malformed", None, None, None), ("empty", None, None, None), ("missing a", None, None, None)],
        key=repr)


def test_a_stream_writes_rows_bad_lines_and_counts(spark, tmp_path):
    place = tmp_path / "in"
    place.mkdir()
    (place / "a.txt").write_text('{"a":"1"}\nbroken\n{"b":"2"}')
    outs = {name: str(tmp_path / name) for name in ("rows", "bad", "counts")}
    writer = sinks.parsed(T.StructType.fromDDL("a string"), ("a",), *[sinks.to_parquet(path) for path in outs.values()])
    for _ in range(2):
        sinks.start(kafka.read_text_stream(spark, str(place)), str(tmp_path / "state"), writer).awaitTermination()
    assert rows(spark.read.parquet(outs["rows"]), "a") == [("1",)]
    assert rows(spark.read.parquet(outs["bad"]), "value", "error") == sorted([("broken", "malformed"), ('{"b":"2"}', "missing a")], key=repr)
    assert rows(spark.read.parquet(outs["counts"]), "error", "lines") == sorted([(None, 1), ("malformed", 1), ("missing a", 1)], key=repr)
