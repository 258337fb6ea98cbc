"""The windowed metrics over behaviour-log lines, batch and stream."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import log_split
from freshet.plans import summaries
from freshet.sources import logs
from freshet.streaming import sinks, stateful

D1 = 1_704_067_200_000  # 2024-01-01 00:00:00 UTC
DAY = 86_400_000


def view(mid, ts, page="home", last="x", uid=None, sid=None, **more):
    return {
        "common": {"mid": mid, "uid": uid, "vc": "v1", "ch": "c", "ar": "a", "is_new": "0",
                   "sid": sid},
        "page": {"page_id": page, "last_page_id": last, "during_time": 10, **more},
        "ts": ts,
    }


PAGES = [
    view("m1", D1 + 1000, sid="s1"),
    view("m1", D1 + 2000, sid="s1"),
    view("m2", D1 + 3000, page="good_detail", sid="s2"),
    view("m2", D1 + 4000, page="home", last="login", uid="u2", sid="s2"),
    view("m1", D1 + 6000, page="good_detail", last="login", uid="u1", sid="s3"),
    view("m1", D1 + DAY + 1000, last="login", uid="u1", sid="s3"),
    view("m2", D1 + 8 * DAY + 1000, last="login", uid="u2", sid="s4"),
    view("m3", D1 + 8 * DAY + 2000, last="search", item="Red red phone", item_type="keyword", sid="s5"),
    view("m3", D1 + 8 * DAY + 2500, last="home", item="phone", item_type="keyword", sid="s5"),
    view("m3", D1 + 8 * DAY + 3000, last="mine", item="nope", item_type="keyword", sid="s5"),
]
CLOSING = [view("zz", D1 + 4000 * DAY, page=p, last="login", uid="zz", item="zz", item_type="keyword",
                sid="zz") for p in ("home", "good_detail")]
CLOSING += [view("zz", D1 + 4000 * DAY, last="search", item="zz", item_type="keyword", sid="zz")]


def stamp(ms):
    return (datetime(1970, 1, 1) + timedelta(milliseconds=ms)).strftime("%Y-%m-%d %H:%M:%S")


def label(ms, size):
    start = ms - ms % (size * 1000)
    return (stamp(start), stamp(start + size * 1000), stamp(start)[:10])


def sid_order(pages):
    return summaries.page_views(pages, ["et"])


METRICS = {
    "home_detail": (
        summaries.home_detail_users,
        ["home_uv_ct", "good_detail_uv_ct"],
        [
            (*label(D1 + 1000, 5), 2, 1),
            (*label(D1 + 6000, 5), 0, 1),
            (*label(D1 + DAY + 1000, 5), 1, 0),
            (*label(D1 + 8 * DAY + 1000, 5), 2, 0),
        ],
    ),
    "logins": (
        summaries.login_users_of_pages,
        ["back_ct", "uu_ct"],
        [
            (*label(D1, 10), 0, 2),
            (*label(D1 + DAY, 10), 0, 1),
            (*label(D1 + 8 * DAY, 10), 1, 1),
        ],
    ),
    "keywords": (
        summaries.keyword_counts,
        ["keyword", "keyword_count"],
        [(*label(D1 + 8 * DAY, 5), "phone", 2), (*label(D1 + 8 * DAY, 5), "red", 1)],
    ),
    "page_views": (
        sid_order,
        ["uv_ct", "sv_ct", "pv_ct", "dur_sum"],
        [
            (*label(D1, 5)[:2], "20240101", 2, 2, 4, 40),
            (*label(D1 + 5000, 5)[:2], "20240101", 0, 1, 1, 10),
            (*label(D1 + DAY, 5)[:2], "20240102", 1, 1, 1, 10),  # a session's mark lasts an hour
            (*label(D1 + 8 * DAY, 5)[:2], "20240109", 2, 2, 4, 40),
        ],
    ),
}


@pytest.mark.parametrize("name", METRICS)
def test_batch(lines, name):
    job, measures, want = METRICS[name]
    got = job(logs.page_log(lines(*PAGES, "bad")))
    assert rows(got, "stt", "edt", "cur_date", *measures) == sorted(want, key=repr)


def stream(spark, tmp_path, name, batches, job):
    place = tmp_path / name / "in"
    place.mkdir(parents=True)
    for number, batch in enumerate(batches):
        (place / f"{number}.json").write_text("\n".join(json.dumps(row) for row in batch))
        source = spark.readStream.format("text").load(str(place))
        sinks.start(
            job(source), str(tmp_path / name / "state"),
            sinks.to_parquet(str(tmp_path / name / "out")),
        ).awaitTermination()
    return spark.read.parquet(str(tmp_path / name / "out")).drop("batch_id")


@pytest.mark.parametrize("name", METRICS)
def test_stream_equals_batch(spark, tmp_path, name):
    job, measures, want = METRICS[name]
    got = stream(
        spark, tmp_path, name, [PAGES[:5], PAGES[5:], CLOSING], lambda s: job(logs.page_log(s))
    )
    assert rows(got, "stt", "edt", "cur_date", *measures) == sorted(want, key=repr)


def test_late_rows_are_dropped(spark, tmp_path):
    batches = [[view("a", D1 + 60_000)], [view("b", D1)], [view("c", D1 + 58_000)], CLOSING]
    got = stream(
        spark, tmp_path, "late", batches, lambda s: summaries.home_detail_users(logs.page_log(s))
    )
    assert sum(r.home_uv_ct for r in got.collect()) == 2  # 'b' came a minute late


def test_days_arriving_out_of_order_are_put_in_order(spark, tmp_path):
    batches = [[view("a", D1 + DAY)], [view("a", D1 + DAY - 2000)], [view("a", D1 + DAY + 100)], CLOSING]
    got = stream(
        spark, tmp_path, "back", batches, lambda s: summaries.home_detail_users(logs.page_log(s))
    )
    assert rows(got, "cur_date", "home_uv_ct") == [("2024-01-01", 1), ("2024-01-02", 1)]


def test_visitor_repair_on_a_stream(spark, tmp_path):
    def row(mid, flag, ts):
        return {"common": {"mid": mid, "is_new": flag}, "page": {"page_id": "p"}, "ts": ts}

    first = [row("a", "1", D1), row("b", "0", D1), row(None, "1", D1 + 9), row("c", None, D1)]
    second = [row("a", "1", D1 + 5), row("a", "1", D1 + DAY), row("b", "1", D1 + 6), row("c", "1", D1 + DAY)]
    got = stream(
        spark, tmp_path, "repair", [first, second, [row("zz", "0", D1 + 99 * DAY)]],
        lambda s: stateful.repair_new_visitors(logs.page_log(s), "et"),
    )
    assert rows(got, F.col("common")["mid"], "ts", F.col("common")["is_new"]) == sorted(
        [("a", D1, "1"), ("a", D1 + 5, "1"), ("a", D1 + DAY, "0"), ("b", D1, "0"), ("b", D1 + 6, "0"),
         (None, D1 + 9, "1"), ("c", D1, None), ("c", D1 + DAY, "1")],
        key=repr,
    )


HOUR = 3_600_000


def sessions(source):
    facts = summaries.page_facts(logs.page_log(source), ["et"])
    return stateful.first_of_day_and_session(facts, "mid", "sid", [], "et", ["micros"], "micros").select("micros", "starts")


def test_session_mark_expires_after_an_hour_and_leaves_no_state(spark, tmp_path):
    times = [0, 10, HOUR - 1, HOUR, HOUR + 5, 2 * HOUR, 2 * HOUR + 1]
    batches = [[view("a", D1 + t, sid="s") for t in times[:2]], [view("a", D1 + t, sid="s") for t in times[2:]],
               [view("b", D1 + 40 * DAY, sid="t")], [view("b", D1 + 80 * DAY, sid="t")]]
    got = stream(spark, tmp_path, "sessions", batches, sessions)
    # rows of one pane are one: HOUR with HOUR + 5, 2 * HOUR with 2 * HOUR + 1
    found = {r.micros // 1000 - D1: r.starts for r in got.collect()}
    assert found == {0: 1, HOUR - 1: 0, HOUR: 1, 2 * HOUR: 1, 40 * DAY: 1}
    assert rows(summaries.session_starts(summaries.page_facts(logs.page_log(spark.createDataFrame(
        [(json.dumps(v),) for batch in batches[:3] for v in batch], "value string")), ["et"]), ["micros"], []),
        (F.col("micros") / 1000 - D1).cast("long")) == sorted([(0,), (HOUR,), (2 * HOUR,), (40 * DAY,)], key=repr)
    operators = [r.operatorId for r in spark.read.format("state-metadata").load(str(tmp_path / "sessions" / "state"))
                 .where("operatorName like 'transformWithState%'").select("operatorId").distinct().collect()]
    kept = [
        {r.key[0] for r in spark.read.format("statestore").option("operatorId", k).option("stateVarName", "state")
         .load(str(tmp_path / "sessions" / "state")).collect()}
        for k in operators
    ]
    assert sorted(kept, key=len) == [set(), {"a", "b"}]  # no mark of a session is left; devices keep their day


def shuffled(n, seed):
    """Page views of a few devices and sessions over three days, each at most four seconds out of order."""
    draw = random.Random(seed)
    times = sorted(draw.choice([0, DAY, 2 * DAY]) + draw.randrange(0, 2 * HOUR) for _ in range(n))
    made = [view(f"m{draw.randrange(3)}", D1 + t, page=draw.choice(["home", "good_detail"]), last="login",
                 uid=f"u{draw.randrange(3)}", sid=f"s{draw.randrange(4)}") for t in times]
    for v in made:
        v["common"]["is_new"] = draw.choice("01")
    return sorted(made, key=lambda v: v["ts"] + draw.randrange(0, 4000))


def chained(source):
    """The visitor flags repaired, then the page metrics."""
    fixed = stateful.repair_new_visitors(logs.page_log(source), "et")
    return summaries.page_views(fixed, ["ts"])


LIVE = {
    "home": summaries.home_detail_users,
    "logins": summaries.login_users_of_pages,
    "orders": lambda pages: summaries.order_users(pages.select(F.col("common")["uid"].alias("user_id"), "et")),
    "pages": lambda pages: summaries.page_views(pages, ["ts"]),
}


def live(spark, place, events, size, job):
    """``events`` as files of ``size`` rows, one file a micro-batch."""
    (place / "in").mkdir(parents=True)
    for number, start in enumerate(range(0, len(events), size)):
        file = place / "in" / f"{number:05d}.json"
        file.write_text("\n".join(json.dumps(row) for row in events[start : start + size]))
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))
    source = spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(place / "in"))
    sinks.start(job(source), str(place / "state"), sinks.to_parquet(str(place / "out"))).awaitTermination()
    return spark.read.parquet(str(place / "out")).drop("batch_id")


@pytest.mark.parametrize("name", LIVE)
def test_live_results_do_not_depend_on_the_batches(spark, tmp_path, lines, name):
    """One batch, a few, and one row each give what the batch job gives."""
    events = shuffled(16, 7)
    job, end = LIVE[name], [view(None, D1 + 400 * DAY, last="login", uid="end", sid="end")]
    want = rows(job(logs.page_log(lines(*events))))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    for size in (100, 5, 1) if name == "logins" else (100, 1):
        got = live(spark, tmp_path / f"{name}{size}", [*events, *end], size, lambda s: job(logs.page_log(s)))
        assert rows(got.where("stt < '2024-06'")) == want, size
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_a_live_chain_equals_the_batch_chain(spark, tmp_path, lines):
    events = shuffled(40, 8)
    log = logs.page_log(lines(*events))
    want = rows(summaries.page_views(log_split.repair_new_visitors(log, ["ts"]), ["ts"]))
    for size in (100, 9):
        got = live(spark, tmp_path / str(size), [*events, view(None, D1 + 400 * DAY, last="login", uid="end", sid="end")], size, chained)
        assert rows(got.where("stt < '2024-06'")) == want, size


def test_a_busy_key_costs_its_panes_not_its_rows(spark, tmp_path):
    place = tmp_path / "busy"
    ticks = spark.range(0, 400_000, 1, 4).select(F.timestamp_millis(F.lit(D1) + F.col("id") * 9).alias("et"), F.lit("u").alias("user_id"))
    ticks.union(spark.createDataFrame([(datetime(2025, 1, 1), "z")], ticks.schema)).write.parquet(str(place / "in"))
    source = spark.readStream.schema(ticks.schema).parquet(str(place / "in")).withWatermark("et", "5 seconds")
    query = sinks.start(summaries.order_users(source), str(place / "state"), sinks.to_parquet(str(place / "out")))
    query.awaitTermination()
    assert rows(spark.read.parquet(str(place / "out")), "stt", "order_unique_user_count") == [("2024-01-01 00:00:00", 1)]
    through = [op["customMetrics"].get("numValueStateVars") for p in query.recentProgress for op in json.loads(p.json)["stateOperators"]
               if op["operatorName"].startswith("transformWithState")]
    assert through  # the state machine is there


def test_pattern_on_a_stream_waits_for_late_neighbours(spark, tmp_path):
    def event(kind, field, second, user="1"):
        at = datetime(2024, 1, 17, 8) + timedelta(seconds=second)
        return {"eventType": kind, "userId": user, field: at.strftime("%Y-%m-%dT%H:%M:%SZ")}

    redeemed, bought, browsed = "redemptionTime", "purchaseTime", "browseTime"
    batches = [
        [event("couponRedemption", redeemed, 0), event("quickPurchase", bought, 4),
         event("couponRedemption", redeemed, 100, "2"), event("quickPurchase", bought, 130, "2")],
        [event("quickBrowse", browsed, 128, "2")],  # late, but within the delay
        [event("login", "loginTime", 99_999, "9")],
    ]

    def job(source):
        timed = logs.shop_events(source).withColumn("id", F.lit(0))
        return stateful.followed_by(
            timed, "user_id", "et", "event_type", "id", "couponRedemption", "quickPurchase", 60
        )

    got = stream(spark, tmp_path, "pattern", batches, job)
    assert rows(got, "user_id", "message") == [("1", "Suspicious behavior detected")]
    state = str(tmp_path / "pattern" / "state")
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(state)
    last = spark.read.format("statestore").option("stateVarName", "last").load(state)
    assert {r.key[0] for r in waiting.collect()} == {"9"} and last.count() == 0  # buckets and the last event are freed


def test_sliding_counts_and_registrations(spark):
    base = datetime(2024, 1, 1, 6, 2)
    df = spark.createDataFrame(
        [(1, base, "LOGIN_SUCCESS"), (1, base + timedelta(minutes=57), "LOGIN_SUCCESS"),
         (1, base + timedelta(minutes=58), "LOGIN_SUCCESS"), (1, base, "LOGIN_FAILED")],
        "u int, ts timestamp_ntz, event_name string",
    )
    got = {r.start: r.login_count for r in summaries.login_counts(df, "u", "ts").collect()}
    want = df.where("event_name = 'LOGIN_SUCCESS'").groupBy(F.window("ts", "1 hour", "5 minutes")).count()
    assert got == {r.window.start: r["count"] for r in want.collect()}
    assert got[datetime(2024, 1, 1, 6, 0)] == 2  # 06:02 and 06:59; 07:00 is outside

    users = spark.createDataFrame([(base,), (base + timedelta(seconds=4),), (base + timedelta(seconds=5),)],
                                  "et timestamp_ntz")
    assert rows(summaries.registrations(users), "stt", "edt", "cur_date", "register_ct") == [
        ("2024-01-01 06:02:00", "2024-01-01 06:02:05", "2024-01-01", 2),
        ("2024-01-01 06:02:05", "2024-01-01 06:02:10", "2024-01-01", 1),
    ]
