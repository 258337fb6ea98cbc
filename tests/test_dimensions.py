import random

from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import dimension, routing
from freshet.schemas import DIM_RULE, FACT_RULE
from freshet.sources import logs, snapshots
from freshet.streaming import sinks

RULES = [
    ("user_info", "dim_user", "id,name", "info", "id"),
    ("sku_info", "dim_sku", "id, price", "info", "id"),
]


def change(table, kind, data, ts, database="shop"):
    return {"database": database, "table": table, "type": kind, "data": data, "ts": ts}


def test_routing_keeps_listed_columns_of_ruled_tables(spark, lines):
    changes = logs.change_log(
        lines(
            change("user_info", "insert", {"id": "1", "name": "n", "phone": "x"}, 1),
            change("user_info", "bootstrap-start", {"id": "2"}, 1),
            change("user_info", "update", {}, 1),
            change("user_info", "update", {"id": "3"}, 1, database="other"),
            change("unknown", "insert", {"id": "4"}, 1),
            change("sku_info", "delete", {"id": "5", "price": "9"}, 1),
        )
    )
    got = routing.route_dimensions(changes, spark.createDataFrame(RULES, DIM_RULE), "shop")
    picked = {r.row_key: (r.sink_table, r.op_type, r.data) for r in got.collect()}
    assert picked == {
        "1": ("dim_user", "insert", {"id": "1", "name": "n"}),
        "5": ("dim_sku", "delete", {"id": "5"}),  # ' price' in the rule is not 'price'
    }


def test_rules_in_force(spark):
    snapshot = spark.createDataFrame(RULES, DIM_RULE)
    changes = spark.createDataFrame(
        [
            ("user_info", "dim_user_v2", "id", "info", "id", "u", 1),
            ("sku_info", "dim_sku", "id", "info", "id", "d", 2),
            ("spu_info", "dim_spu", "id", "info", "id", "c", 3),
            ("spu_info", "dim_spu", "id", "info", "id", "d", 4),
            ("spu_info", "dim_spu2", "id", "info", "id", "c", 5),
        ],
        "source_table string, sink_table string, sink_columns string, sink_family string, "
        "sink_row_key string, op string, seq int",
    )
    got = routing.current_rules(snapshot, changes, ["source_table"])
    assert rows(got, "source_table", "sink_table") == [
        ("spu_info", "dim_spu2"), ("user_info", "dim_user_v2"),
    ]
    assert routing.current_rules(snapshot, None, ["source_table"]).count() == 2


def test_fact_routing_needs_table_and_type(spark, lines):
    rules = spark.createDataFrame([("coupon_use", "insert", "get", "id,user")], FACT_RULE)
    changes = logs.change_log(
        lines(
            change("coupon_use", "insert", {"id": "1", "user": "u", "x": "y"}, 7),
            change("coupon_use", "update", {"id": "2"}, 7),
            change("coupon_use", "delete", {"id": "3"}, 7),
        )
    )
    got = routing.route_facts(changes, rules, "shop").collect()
    assert [(r.sink_table, r.data, r.ts) for r in got] == [("get", {"id": "1", "user": "u"}, 7)]


def routed(spark, data):
    return spark.createDataFrame(
        data, "sink_table string, row_key string, op_type string, data map<string,string>, ts bigint"
    )


PUTS = [
    ("t", "1", "insert", {"a": "x", "b": "y"}, 1),
    ("t", "1", "update", {"a": None, "b": "z"}, 2),  # the old 'a' survives
    ("t", "2", "insert", {"a": "x"}, 1),
    ("t", "2", "delete", {"a": "x"}, 2),
    ("t", "3", "insert", {"a": "old", "b": "old"}, 1),
    ("t", "3", "delete", {"a": "old"}, 2),
    ("t", "3", "insert", {"a": "new"}, 3),  # no 'b' comes back
]


def test_dimension_fold(spark):
    live = dimension.live_cells(dimension.cells(routed(spark, PUTS), ["ts"]))
    got = {r.row_key: r.info for r in dimension.dimension_rows(live).collect()}
    assert got == {"1": {"a": "x", "b": "z"}, "3": {"a": "new"}}
    table = dimension.dimension_table(live, "t", ["a", "b"])
    assert rows(table, "row_key", "a", "b") == [("1", "x", "z"), ("3", "new", None)]


def test_dimension_fold_equals_a_loop(spark):
    rng = random.Random(5)
    data = [
        (rng.choice(["t", "s"]), rng.choice("123"), rng.choice(["insert", "update", "update", "delete"]),
         {c: rng.choice([None, str(i)]) for c in "abc"}, i)
        for i in range(200)
    ]
    want = {}
    for table, key, op, cols, _ in data:
        if op == "delete":
            want.pop((table, key), None)
        else:
            written = {c: v for c, v in cols.items() if v is not None}
            if written:
                want.setdefault((table, key), {}).update(written)
    live = dimension.live_cells(dimension.cells(routed(spark, data).repartition(3), ["ts"]))
    got = {(r.sink_table, r.row_key): r.info for r in dimension.dimension_rows(live).collect()}
    assert got == want


def test_dimension_store_folds_across_batches_and_retries(spark, tmp_path):
    path = str(tmp_path / "dims")
    write = sinks.to_dimension_cells(path, ["ts"])
    write(routed(spark, PUTS[:4]), 0)
    write(routed(spark, PUTS[4:6]), 1)
    write(routed(spark, PUTS[4:6]), 1)
    write(routed(spark, PUTS[6:]), 2)
    live = sinks.read_dimension_cells(spark, path)
    got = {r.row_key: r.info for r in dimension.dimension_rows(live).collect()}
    assert got == {"1": {"a": "x", "b": "z"}, "3": {"a": "new"}}


def test_table_lifecycle(spark, lines):
    rule = {"source_table": "s", "sink_columns": "a", "sink_family": "i", "sink_row_key": "a"}

    def event(op, before, after):
        return {"op": op, "before": before and {**rule, "sink_table": before},
                "after": after and {**rule, "sink_table": after}}

    events = [
        event("r", None, "kept"), event("c", None, "gone"), event("d", "gone", None),
        event("c", None, "moved"), event("u", "moved", "target"),
        event("c", None, "reset"), event("u", "reset", "reset"),
    ]
    parsed = snapshots.rule_changes(
        lines(*events).withColumn("ts", F.monotonically_increasing_id()), DIM_RULE
    )
    got = dimension.table_lifecycle(parsed, ["ts"])
    state = {r.sink_table: (r.present, r.reset_at is not None) for r in got.collect()}
    assert state == {
        "kept": (True, False), "gone": (False, True), "moved": (False, True),
        "target": (True, True), "reset": (True, True),
    }


def test_reset_forgets_older_rows(spark):
    data = [(t, "1", "insert", {"a": t}, ts) for t, ts in (("kept", 1), ("gone", 1), ("reset", 1))]
    data += [("reset", "2", "insert", {"a": "after"}, 9)]
    resets = spark.sql(
        """SELECT * FROM VALUES ('kept', true, CAST(NULL AS STRUCT<ts: BIGINT>)),
           ('gone', false, named_struct('ts', 5L)), ('reset', true, named_struct('ts', 5L))
           AS t(sink_table, present, reset_at)"""
    )
    live = dimension.live_cells(dimension.cells(routed(spark, data), ["ts"]), resets)
    assert rows(live, "sink_table", "row_key") == [("kept", "1"), ("reset", "2")]


def test_upsert_log_read_as_a_table(spark):
    log = spark.createDataFrame(
        [("a", "1", False, 1), ("a", "2", False, 2), ("b", "1", False, 1), ("b", None, True, 2)],
        "id string, v string, removed boolean, ts int",
    )
    assert rows(sinks.latest_by_key(log, ["id"], ["ts"]), "id", "v") == [("a", "2")]


def test_upsert_log_ties_repeats_and_null_keys(spark):
    log = spark.createDataFrame(
        [("a", "1", False, 2, 1), ("a", "2", False, 2, 2), ("a", "2", False, 2, 2), (None, "n", False, 1, 1),
         (None, "m", False, -5, 9), ("c", "x", False, None, 1), ("d", "y", False, 3, 1), ("d", None, True, 3, 2)],
        "id string, v string, removed boolean, ts bigint, seq bigint",
    )
    got = sinks.latest_by_key(log, ["id"], ["ts", "seq"])
    assert rows(got, "id", "v") == sorted([("a", "2"), (None, "n"), ("c", "x")], key=repr)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
    one = sinks.latest_by_key(log.where("id = 'a'"), ["id"], ["ts"])
    assert one.count() == 1  # equal order: one of them, told apart by hash
    assert sinks.latest_by_key(log.limit(0), ["id"], ["ts"]).count() == 0


def test_olap_lines_are_written_once_and_rolled_up(spark, tmp_path):
    path = str(tmp_path / "olap")
    write = sinks.to_olap_lines(path, hidden=["ts"], fan_in=2, grace=1, full_bytes=150)
    for number in range(12):
        batch = spark.createDataFrame([(f"day {number}", number, 1)], "curDate string, uuCt int, ts int")
        write(batch, number)
        write(batch, number)
    got = sinks.read_olap_lines(spark, path)
    assert rows(got, "cur_date", "uu_ct") == sorted([(f"day {k}", k) for k in range(12)], key=repr)
    runs = sinks._line_store(spark, path).manifest()["runs"]
    assert len(runs) <= 4 and any(r["level"] == -1 for r in runs)


def test_messages(spark):
    df = spark.createDataFrame([("t1", "7", "insert", 1)], "sink string, id string, op_type string, v int")
    got = sinks.as_messages(df, key=["id"], topic="sink").first()
    assert (got.topic, got.key, got.value) == ("t1", "7", '{"id":"7","v":1}')
    options = sinks.kafka_options("b:1")
    assert "topic" not in options and options["kafka.transaction.timeout.ms"] == "900000"
    assert sinks.kafka_options("b:1", "t")["topic"] == "t"


def test_json_lines_sink(spark, tmp_path):
    path = str(tmp_path / "olap")
    write = sinks.to_json_lines(path, hidden=["ts"])
    df = spark.createDataFrame([("d", 5, 1)], "curDate string, uuCt int, ts int")
    write(df, 3)
    write(df, 3)
    got = spark.read.json(path).drop("batch_id")
    assert sorted(got.columns) == ["cur_date", "uu_ct"] and got.count() == 1
