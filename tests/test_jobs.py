"""Jobs wired to folders instead of topics: one job's output is the next one's input."""

import json
import shutil

import pytest
from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import dimension, routing, rule_log
from freshet.schemas import DIM_RULE, FACT_RULE
from freshet.streaming import jobs, processors, ruled, sinks
from test_facts import CHANGES, NAMES
from test_log_split import D1, DAY


class Folders:
    """Topics as folders of text files."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def put(self, topic, name, texts):
        place = self.root / topic
        place.mkdir(parents=True, exist_ok=True)
        (place / f"{name}.txt").write_text("\n".join(
            t if isinstance(t, str) else json.dumps(t) for t in texts))

    def lines(self, topic):
        (self.root / topic).mkdir(parents=True, exist_ok=True)
        return self.spark.readStream.format("text").load(str(self.root / topic))

    def run(self, name, writer, context=jobs.Context()):
        rows_ = jobs.JOBS[name].build(self.lines, context)
        folder = str(self.root / "_jobs" / name)
        writer = jobs.writer_of(name, folder, context, writer)
        sinks.start(rows_, f"{folder}/state", writer).awaitTermination()
        return folder


def visit(mid, flag, ts, **more):
    return {"common": {"mid": mid, "is_new": flag, "vc": "v", "ch": "c", "ar": "a", "uid": "u"},
            "ts": ts, **more}


def test_log_to_page_metrics(spark, tmp_path):
    """The behaviour log is split, and the page topic feeds the page metric."""
    home = Folders(spark, tmp_path)
    log = [
        visit("m", "1", D1 + 1000, page={"page_id": "home", "during_time": 5}, sid="s",
              displays=[{"item": "1"}], err={"code": "1"}),
        visit("m", "1", D1 + DAY, page={"page_id": "home", "during_time": 6}, sid="t"),
        "broken {",
        visit("end", "1", D1 + 900 * DAY),  # rows come out when the watermark has passed them
    ]
    out = tmp_path / "split"
    home.put(jobs.BEHAVIOR_LOG, "a", log)
    home.run("dwd_base_log", sinks.to_topics(str(out)))
    assert rows(spark.read.text(str(out)).groupBy("topic").count()) == [
        ("dwd_traffic_display", 1), ("dwd_traffic_err", 1), ("dwd_traffic_page", 2),
    ]

    pages = [r.value for r in spark.read.text(str(out)).where(f"topic = '{jobs.PAGE}'").collect()]
    home.put(jobs.PAGE, "a", pages)
    home.put(jobs.PAGE, "b", [visit("z", "0", D1 + 900 * DAY, page={"during_time": 1}, sid="z")])
    metric = str(tmp_path / "metric")
    home.run("dws_traffic_page_view_window", sinks.to_json_lines(metric))
    got = spark.read.json(metric)
    assert rows(got, "cur_date", "is_new", "uv_ct", "sv_ct", "pv_ct", "dur_sum") == [
        ("20240101", "1", 1, 1, 1, 5), ("20240102", "0", 1, 1, 1, 6),
    ]


def test_facts_by_rule(spark, tmp_path):
    home = Folders(spark, tmp_path)
    home.put(jobs.BUSINESS_DB, "a", CHANGES)
    rules = spark.createDataFrame([("comment_info", "insert", "dwd_comments", "id")], FACT_RULE)
    out = str(tmp_path / "facts")
    home.run("dwd_base_db", sinks.to_topics(out), jobs.Context(rules=lambda: rules))
    assert rows(spark.read.text(out), "topic", "value") == [
        ("dwd_comments", '{"id":"c1"}'), ("dwd_comments", '{"id":"c2"}'),
    ]


def test_comment_job_gives_keyless_messages(spark, tmp_path):
    home = Folders(spark, tmp_path)
    home.put(jobs.BUSINESS_DB, "a", CHANGES)
    dictionary = spark.createDataFrame(
        [(k, (v,)) for k, v in NAMES.items()], "dic_code string, info struct<dic_name:string>"
    )
    out = str(tmp_path / "comments")
    home.run("dwd_interaction_comment_info", sinks.to_parquet(out),
             jobs.Context(dictionary=lambda: dictionary))
    got = spark.read.parquet(out)
    assert "key" not in got.columns
    assert json.loads(got.first().value)["appraise_name"] == "GOOD"


def test_order_users_from_the_fact_topic(spark, tmp_path):
    home = Folders(spark, tmp_path)
    t0 = D1 // 1000
    home.put(jobs.ORDER_DETAIL, "a", [{"id": "1", "user_id": "u", "ts": t0},
                                      {"id": "2", "user_id": "u", "ts": t0 + 1},
                                      {"id": "3", "user_id": "w", "ts": t0 + 2}])
    home.put(jobs.ORDER_DETAIL, "b", [{"id": "9", "user_id": "z", "ts": t0 + 10**7}])
    out = str(tmp_path / "orders")
    home.run("dws_trade_order_window", sinks.to_json_lines(out))
    assert rows(spark.read.json(out), "stt", "order_unique_user_count", "order_new_user_count") == [
        ("2024-01-01 00:00:00", 2, 2)
    ]


def test_rules_are_read_anew_for_each_batch(spark, tmp_path):
    home = Folders(spark, tmp_path)
    rules_at = tmp_path / "rules"

    def set_rule(columns):
        shutil.rmtree(rules_at, ignore_errors=True)
        spark.createDataFrame([("user_info", "dim_user", columns, "info", "id")], DIM_RULE).write.json(
            str(rules_at)
        )

    def route(changes):
        rules = changes.sparkSession.read.schema(DIM_RULE).json(str(rules_at))
        return routing.route_dimensions(changes, rules, "shop")

    store = str(tmp_path / "dims")
    writer = sinks.after(route, sinks.to_dimension_cells(store, ["ts"]))
    for number, columns in enumerate(("id", "id,name")):
        set_rule(columns)
        home.put(jobs.BUSINESS_DB, str(number), [
            {"database": "shop", "table": "user_info", "type": "insert",
             "data": {"id": str(number), "name": "n"}, "ts": number}])
        from freshet.sources import logs

        sinks.start(
            logs.change_log(home.lines(jobs.BUSINESS_DB)), str(tmp_path / "state"), writer
        ).awaitTermination()
    info = {r.row_key: r.info for r in dimension.dimension_rows(
        sinks.read_dimension_cells(spark, store)).collect()}
    assert info == {"0": {"id": "0"}, "1": {"id": "1", "name": "n"}}

    smaller = str(tmp_path / "folded")
    sinks.compact_dimension_cells(spark, store, smaller)
    again = sinks.read_dimension_cells(spark, smaller)
    assert {r.row_key: r.info for r in dimension.dimension_rows(again).collect()} == info


def captured(op, ts_ms, before=None, after=None):
    return {"op": op, "before": before, "after": after, "ts_ms": ts_ms}


def test_rules_change_while_the_dimension_job_runs(spark, tmp_path):
    """Rules are created, moved and dropped between batches; rows follow the rule of their own time."""
    home = Folders(spark, tmp_path)
    store = str(tmp_path / "dims")
    writer = sinks.to_dimension_cells(store, ["ts", "seq"], fan_in=2)
    early = spark.createDataFrame([("user_info", "dim_user", "id", "info", "id")], DIM_RULE)
    context = jobs.Context(rules=lambda: early, database="shop")

    def rule(table, target, columns):
        return {"source_table": table, "sink_table": target, "sink_columns": columns,
                "sink_family": "info", "sink_row_key": "id"}

    def row(table, id_, ts):
        return {"database": "shop", "table": table, "type": "insert", "data": {"id": id_, "name": "n"}, "ts": ts}

    def batch(number, rules, data):
        home.put(jobs.DIM_RULES, str(number), rules)
        home.put(jobs.BUSINESS_DB, str(number), data)
        return home.run("dim_app", writer, context)

    batch(0, [captured("c", 5000, after=rule("sku_info", "dim_sku", "id,name")), "broken {"],
          [row("user_info", "1", 1), row("sku_info", "a", 4), row("sku_info", "b", 5), "{"])
    folder = batch(1, [captured("u", 10000, rule("user_info", "dim_user", "id"), rule("user_info", "dim_person", "id,name")),
                       captured("d", 20000, rule("sku_info", "dim_sku", "id,name"))],
                   [row("user_info", "2", 9), row("user_info", "3", 10), row("sku_info", "c", 19), row("sku_info", "d", 20)])
    folder = batch(2, [captured("c", 30000, after=rule("sku_info", "dim_sku", "id"))],
                   [row("sku_info", "e", 30), row("sku_info", "f", 18)])
    lives = rule_log.generations(ruled.rules_of(spark, folder))
    got = dimension.dimension_rows(sinks.read_dimension_cells(spark, store, tables=lives)).collect()
    assert {(r.sink_table, r.row_key): r.info for r in got} == {
        ("dim_person", "3"): {"id": "3", "name": "n"}, ("dim_sku", "e"): {"id": "e"},
    }
    written = sinks.read_dimension_cells(spark, store).select("sink_table", "row_key").distinct()
    assert rows(written) == [("dim_person", "3"), ("dim_sku", "b"), ("dim_sku", "c"), ("dim_sku", "e"),
                             ("dim_sku", "f"), ("dim_user", "1"), ("dim_user", "2")]


@pytest.mark.parametrize("name", jobs.JOBS)
def test_every_job_builds_a_stream(spark, tmp_path, name):
    home = Folders(spark, tmp_path)
    dictionary = spark.createDataFrame([("1", ("n",))], "dic_code string, info struct<dic_name:string>")
    schema = FACT_RULE if name == "dwd_base_db" else DIM_RULE
    context = jobs.Context(
        dictionary=lambda: dictionary, rules=lambda: spark.createDataFrame([], schema)
    )
    built = jobs.JOBS[name].build(home.lines, context)
    assert built.isStreaming and built.columns
    assert not built.select(F.lit(1)).isLocal()


def test_the_event_pattern_costs_few_state_calls_however_many_rows():
    """Thirty days of a key's rows in one batch, some to come after the watermark; each call to state counts."""
    calls = []

    class State:
        def __init__(self):
            self.held = None

        def exists(self):
            calls.append("exists")
            return self.held is not None

        def get(self):
            calls.append("get")
            return self.held

        def appendList(self, rows):
            calls.append("append")
            self.held = [*(self.held or []), *rows]

        def put(self, rows):
            calls.append("put")
            self.held = list(rows)

        update = put

        def clear(self):
            calls.append("clear")
            self.held = None

    class Handle:
        timers: list[int] = []

        def getListState(self, name, schema):
            return State()

        def getValueState(self, name, schema):
            return State()

        def registerTimer(self, at):
            calls.append("timer")
            self.timers.append(at)

    class Now:
        def __init__(self, at):
            self.at = at

        def getExpiryTimeInMs(self):
            return self.at

        getCurrentWatermarkInMs = getExpiryTimeInMs

    machine = processors.FollowedBy("click", "purchase", 3600, "m")
    machine.init(Handle())
    minute = 60_000_000
    given = [{"micros": 61 * minute * k, "tie": k, "kind": "click"} for k in range(700)]
    given += [{"micros": 61 * minute * k + minute, "tie": k, "kind": "purchase"} for k in range(700)]
    list(machine.handleInputRows((1,), iter(given), None))
    middle, end = 61 * 350 * 60_000, 10**10
    got = list(machine.handleExpiredTimer((1,), Now(middle), Now(min(Handle.timers))))
    assert len(got) == 350
    got += list(machine.handleExpiredTimer((1,), Now(end), Now(max(Handle.timers))))
    assert [(r.first_micros, r.second_micros) for r in got] == [(61 * minute * k, 61 * minute * k + minute) for k in range(700)]
    assert len(calls) < 30
