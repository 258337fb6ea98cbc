"""The fact jobs on a small hand-made change log, as a batch and as a stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import joins
from freshet.plans import facts
from freshet.sources import logs
from freshet.streaming import sinks


def change(table, kind, data, ts, old=None, database="gmall"):
    return {"database": database, "table": table, "type": kind, "data": data, "old": old, "ts": ts}


T0 = 1_705_449_600  # 2024-01-17 00:00:00 UTC


def detail(id_, order, ts, **more):
    data = {
        "id": id_, "order_id": order, "sku_id": "7", "sku_name": "phone", "sku_num": "3",
        "order_price": "7.00", "create_time": "2024-01-17 10:00:00", "source_id": None,
        "source_type": "x", "split_total_amount": "21.00", "split_activity_amount": "0.50",
        "split_coupon_amount": None,
    }
    return change("order_detail", "insert", {**data, **more}, ts)


CHANGES = [
    change("order_info", "insert", {"id": "1", "user_id": "u1", "province_id": "p1"}, T0),
    detail("11", "1", T0 + 1),
    detail("12", "1", T0 + 2, sku_id="8"),
    detail("13", "2", T0 + 2),  # an order that never comes
    change("order_info", "insert", {"id": "3", "user_id": "u3", "province_id": "p3"}, T0, database="other"),
    detail("14", "3", T0),
    change("order_detail_activity", "insert",
           {"order_detail_id": "11", "activity_id": "a1", "activity_rule_id": "r1"}, T0 + 3),
    change("order_detail_coupon", "insert", {"order_detail_id": "12", "coupon_id": "c1"}, T0 + 3),
    change("order_detail_coupon", "delete", {"order_detail_id": "11", "coupon_id": "c9"}, T0 + 3),
    # paid 20 minutes later, then cancelled
    change("payment_info", "update",
           {"user_id": "u1", "order_id": "1", "payment_type": "1101", "payment_status": "1602",
            "callback_time": "2024-01-17 10:20:00"}, T0 + 1200, {"payment_status": "1601"}),
    change("payment_info", "update",  # nothing changed in the status
           {"user_id": "u1", "order_id": "1", "payment_type": "1101", "payment_status": "1602",
            "callback_time": "x"}, T0 + 1201, {"callback_time": "y"}),
    change("payment_info", "update",  # code not in the dictionary
           {"user_id": "u1", "order_id": "1", "payment_type": "9999", "payment_status": "1602",
            "callback_time": "x"}, T0 + 1202, {"payment_status": "1601"}),
    change("order_info", "update",
           {"id": "1", "operate_time": "2024-01-17 10:10:00", "order_status": "1003"},
           T0 + 600, {"order_status": "1001"}),
    change("order_info", "update",  # cancelled from another status
           {"id": "1", "operate_time": "2024-01-17 10:11:00", "order_status": "1003"},
           T0 + 660, {"order_status": "1002"}),
    # refund asked for and paid out
    change("order_refund_info", "insert",
           {"id": "r1", "user_id": "u1", "order_id": "1", "sku_id": "7", "refund_type": "1501",
            "refund_num": "2", "refund_amount": "14.00", "refund_reason_type": "1301",
            "refund_reason_txt": "broken", "create_time": "2024-01-18 09:00:00"}, T0 + 2000),
    change("order_info", "update", {"id": "1", "province_id": "p1", "order_status": "1005"},
           T0 + 2001, {"order_status": "1002"}),
    change("refund_payment", "update",
           {"id": "rp1", "order_id": "1", "sku_id": "7", "payment_type": "1101",
            "callback_time": "2024-01-19 08:00:00", "total_amount": "14.00", "refund_status": "1602"},
           T0 + 3000, {"refund_status": "1601"}),
    change("order_refund_info", "update",
           {"order_id": "1", "sku_id": "7", "refund_num": "2", "refund_status": "0705"},
           T0 + 3001, {"refund_status": "0701"}),
    change("order_refund_info", "update",
           {"order_id": "1", "sku_id": "8", "refund_num": "1", "refund_status": "0705"},
           T0 + 3001, {"refund_status": "0701"}),
    change("order_info", "update",
           {"id": "1", "user_id": "u1", "province_id": "p1", "order_status": "1006"},
           T0 + 3002, {"order_status": "1005"}),
    # comments and cart
    change("comment_info", "insert",
           {"id": "c1", "user_id": "u1", "sku_id": "7", "appraise": "1201", "comment_txt": "good",
            "create_time": "x"}, T0 + 10),
    change("comment_info", "insert", {"id": "c2", "appraise": "none"}, T0 + 11),
    change("cart_info", "insert", {"id": "k1", "user_id": "u1", "sku_id": "7", "sku_num": "2"}, T0),
    change("cart_info", "update", {"id": "k1", "user_id": "u1", "sku_id": "7", "sku_num": "5"},
           T0 + 1, {"sku_num": "2"}),
    change("cart_info", "update", {"id": "k1", "user_id": "u1", "sku_id": "7", "sku_num": "1"},
           T0 + 2, {"sku_num": "5"}),
    change("cart_info", "update", {"id": "k1", "user_id": "u1", "sku_id": "7", "sku_num": "1"},
           T0 + 3, {"sku_id": "6"}),
]
NAMES = {"1101": "ALIPAY", "1501": "RETURN", "1301": "QUALITY", "1201": "GOOD"}


@pytest.fixture(scope="module")
def dictionary(spark):
    return spark.createDataFrame(
        [(code, (name,)) for code, name in NAMES.items()],
        "dic_code string, info struct<dic_name:string>",
    )


@pytest.fixture
def changes(lines):
    return logs.change_log(lines(*CHANGES, "not json", ""))


DETAIL_11 = ("11", "u1", "p1", "a1", "r1", None, "2024-01-17", "21.0000")
DETAIL_12 = ("12", "u1", "p1", None, None, "c1", "2024-01-17", "21.0000")
DETAIL_COLUMNS = [
    "id", "user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id", "date_id",
    "split_original_amount",
]


def test_order_detail(changes):
    got = facts.order_detail(changes)
    assert rows(got, *DETAIL_COLUMNS) == [DETAIL_11, DETAIL_12]


def test_order_cancel(changes):
    got = facts.order_cancel(changes, facts.order_detail(changes))
    assert len(got.columns) == 17
    assert rows(got, "id", "date_id", "cancel_time", "ts") == [
        ("11", "2024-01-17", "2024-01-17 10:10:00", T0 + 600),
        ("12", "2024-01-17", "2024-01-17 10:10:00", T0 + 600),
    ]


def test_payment_success(changes, dictionary):
    details = facts.order_detail(changes)
    got = facts.payment_success(changes, details, dictionary)
    want = [("11", "ALIPAY", "21.00", T0 + 1200), ("12", "ALIPAY", "21.00", T0 + 1200)]
    assert rows(got, "order_detail_id", "payment_type_name", "split_payment_amount", "ts") == want
    short = facts.payment_success(changes, details, dictionary, lower_seconds=1198)
    assert rows(short, "order_detail_id") == [("12",)]


def test_order_refund(changes, dictionary):
    got = facts.order_refund(changes, dictionary)
    assert rows(
        got, "id", "province_id", "date_id", "refund_type_name", "refund_reason_type_name",
        "refund_reason_txt", "ts",
    ) == [("r1", "p1", "2024-01-18", "RETURN", "QUALITY", "broken", T0 + 2000)]


def test_refund_payment_success(changes, dictionary):
    got = facts.refund_payment_success(changes, dictionary)
    assert rows(got, "id", "user_id", "refund_num", "refund_amount", "payment_type_name", "date_id") == [
        ("rp1", "u1", "2", "14.00", "ALIPAY", "2024-01-19")
    ]


def test_comment_and_cart(changes, dictionary):
    assert rows(facts.comment_info(changes, dictionary), "id", "appraise_name", "ts") == [
        ("c1", "GOOD", T0 + 10)
    ]
    assert rows(facts.cart_add(changes), "id", "sku_num", "sku_num_added", "ts") == [
        ("k1", 2, 2, T0), ("k1", 2, 3, T0 + 1),
    ]


# ---- the same jobs as streams ---------------------------------------------------


def run_stream(spark, tmp_path, job, name):
    """Streams the log as files, then a far-future row of each kind."""
    folder = tmp_path / name
    for number, batch in enumerate((CHANGES[:9], CHANGES[9:], closing())):
        place = folder / "in"
        place.mkdir(parents=True, exist_ok=True)
        (place / f"{number}.json").write_text(
            "\n".join([json.dumps(row) for row in batch] + ["bad line"])
        )
        source = spark.readStream.format("text").load(str(place))
        out = job(logs.change_log(source))
        sinks.start(
            out, str(folder / "state"), sinks.to_parquet(str(folder / "out"))
        ).awaitTermination()
    return spark.read.parquet(str(folder / "out")).drop("batch_id")


def closing():
    end = T0 + 10_000_000
    return [
        change("order_info", "insert", {"id": "z"}, end),
        detail("z", "zz", end),
        change("order_detail_activity", "insert", {"order_detail_id": "y"}, end),
        change("order_detail_coupon", "insert", {"order_detail_id": "y"}, end),
    ]


def test_order_detail_stream_equals_batch(spark, tmp_path):
    got = run_stream(spark, tmp_path, facts.order_detail, "detail")
    assert rows(got, *DETAIL_COLUMNS) == [DETAIL_11, DETAIL_12]


def test_payment_stream_equals_batch(spark, tmp_path, dictionary):
    details_in = tmp_path / "details"

    def job(changes):
        lines = filters_of_details(changes)
        return facts.payment_success(changes, lines, dictionary)

    def filters_of_details(changes):
        from freshet.operators import filters

        same = {n: n for n in ("id", "order_id", "sku_id", "sku_name", "sku_num",
                               "split_total_amount", "split_activity_amount", "split_coupon_amount")}
        lines = filters.inserts(changes, "gmall", "order_detail", same)
        extra = ("user_id", "province_id", "activity_id", "activity_rule_id", "coupon_id",
                 "split_original_amount")
        return lines.withColumns({n: F.lit(None).cast("string") for n in extra})

    got = run_stream(spark, tmp_path, job, "payment")
    assert rows(got, "order_detail_id", "payment_type_name", "ts") == [
        ("11", "ALIPAY", T0 + 1200), ("12", "ALIPAY", T0 + 1200),
    ]


def test_refund_payment_stream_equals_batch(spark, tmp_path, dictionary):
    got = run_stream(
        spark, tmp_path, lambda changes: facts.refund_payment_success(changes, dictionary), "refund"
    )
    assert rows(got, "id", "user_id", "refund_num") == [("rp1", "u1", "2")]


def test_lookup_at_takes_the_name_of_the_rows_time(spark):
    known = spark.createDataFrame(
        [("1", "old", "r", -(2**63), -1), ("1", "new", "u", 10_000, 1), ("2", "two", "r", -(2**63), -1), ("2", None, "d", 20_000, 2)],
        "dic_code string, dic_name string, op string, ts_ms bigint, seq bigint",
    )
    versions = joins.dictionary_versions_of(known)
    data = spark.createDataFrame([("1", 9), ("1", 10), ("2", 19), ("2", 20), ("3", 1), (None, 1), ("1", None)], "code string, ts bigint")
    got = joins.lookup_at(data, versions, "code", "name")
    assert rows(got, "code", "ts", "name") == sorted(
        [("1", 9, "old"), ("1", 10, "new"), ("2", 19, "two"), ("1", None, "new")], key=repr)


def test_stream_join_spreads_hot_and_null_keys(spark, tmp_path):
    base = datetime(2024, 1, 1)
    left = [(k, "hot" if k % 2 else None, base) for k in range(200)] + [(-1, "end", datetime(2100, 1, 1))]
    right = [("hot", "r1", base), ("hot", "late", datetime(2024, 1, 1, 0, 0, 6)), ("end2", "x", datetime(2100, 1, 1))]
    spark.createDataFrame(left, "id int, k string, et timestamp").write.parquet(str(tmp_path / "l"))
    spark.createDataFrame(right, "k string, v string, et timestamp").write.parquet(str(tmp_path / "r"))

    def read(name, schema):
        return spark.readStream.schema(schema).parquet(str(tmp_path / name)).withWatermark("et", "1 second")

    for how, want in (("inner", [(k, "r1") for k in range(1, 200, 2)]), ("left", [(k, "r1" if k % 2 else None) for k in range(200)])):
        joined = joins.fact_join(read("l", "id int, k string, et timestamp"), read("r", "k string, v string, et timestamp"), ["k"], how, bound_seconds=5)
        out = str(tmp_path / how)
        sinks.start(joined.select("id", "v"), f"{out}-state", sinks.to_parquet(out)).awaitTermination()
        assert rows(spark.read.parquet(out), "id", "v") == sorted(want, key=repr)


def test_stored_lines_go_through_shuffles_with_their_texts_as_one(spark, lines):
    """Odd texts come back as they were, and only ids and one text are carried."""
    odd = ["", None, 'say "x"', "a\\b\n\tc", " \u00e9\u624b\u673a\U0001f600 ", "null", "[1,2]", "\u0001,"]
    made = [detail(f"d{k}", "1", T0, sku_name=text, split_activity_amount=text) for k, text in enumerate(odd)]
    made += [detail("d0", "1", T0, sku_num=None), detail(None, "1", T0, order_price="x")]
    order = change("order_info", "insert", {"id": "1", "user_id": "u1", "province_id": None}, T0)
    wide = facts.order_detail(logs.change_log(lines(order, *made)))
    got = rows(wide, "id", "sku_name", "split_activity_amount", "split_original_amount", "split_coupon_amount")
    want = [(f"d{k}", text, text, "21.0000", None) for k, text in enumerate(odd)]
    want += [("d0", "phone", "0.50", None, None), (None, "phone", "0.50", None, None)]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert "_line" in wide._jdf.queryExecution().optimizedPlan().toString()
