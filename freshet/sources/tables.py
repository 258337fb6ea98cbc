"""The star-schema tables seen as the warehouse's logs.

Orders, order lines, events and documents become rows of one change log and
one behaviour log, so that every job runs unchanged on whole tables.  Each
branch of the change log has constant ``table`` and ``type`` columns: a job's
filter removes the other branches at planning time, and reading ``data['x']``
of a map just built reduces to the table's own column, so only the needed
parquet columns are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions.times import DATETIME
from freshet.schemas import DIM_RULE, FACT_RULE
from freshet.sources import snapshots

DATABASE = "gmall"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def string_map(entries: Mapping[str, Column | str]) -> Column:
    parts: list[Column] = []
    for key, value in entries.items():
        value = F.col(value) if isinstance(value, str) else value
        parts += [F.lit(key), value.cast("string")]
    return F.create_map(*parts)


def money_text(column: str) -> Column:
    return F.col(column).cast("decimal(16,2)").cast("string")


def seconds_of(column: str) -> Column:
    return F.unix_seconds(F.col(column).cast("timestamp"))


def change_rows(
    df: DataFrame,
    table: str | Column,
    kind: str | Column,
    data: Mapping[str, Column | str],
    ts: Column,
    old: Mapping[str, Column | str] | None = None,
    seq: Column | None = None,
) -> DataFrame:
    """Change rows of ``df``.

    The values are computed first and put into the maps by name after, which
    lets the optimizer replace ``data['x']`` by the one value and drop the map.
    """

    def constant(value):
        return F.lit(value) if isinstance(value, str) else value

    def text(entries, prefix):
        return [
            (F.col(v) if isinstance(v, str) else v).cast("string").alias(prefix + key)
            for key, v in entries.items()
        ]

    old = old or {}
    carried = [] if seq is None else [seq.alias("seq")]
    flat = df.select(
        constant(table).alias("table"),
        constant(kind).alias("type"),
        *text(data, "_new_"),
        *text(old, "_old_"),
        ts.cast("bigint").alias("ts"),
        *carried,
    )
    no_map = F.lit(None).cast("map<string,string>")
    return flat.select(
        F.lit(DATABASE).alias("database"),
        "table",
        "type",
        string_map({key: f"_new_{key}" for key in data}).alias("data"),
        (string_map({key: f"_old_{key}" for key in old}) if old else no_map).alias("old"),
        "ts",
        F.timestamp_seconds("ts").alias("et"),
        *[name for name in flat.columns if name == "seq"],
    )


def line_id() -> Column:
    return F.concat_ws(
        "-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def order_inserts(orders: DataFrame) -> DataFrame:
    return change_rows(
        orders,
        "order_info",
        "insert",
        {**_order_data(), "order_status": F.lit("1001")},
        seconds_of("o_orderdate"),
    )


def order_updates(orders: DataFrame) -> DataFrame:
    """Each order moves on once: cancelled, refund asked for, or refunded."""
    status = F.col("o_orderstatus")
    before = F.when(status == "F", "1001").when(status == "P", "1002").otherwise("1005")
    after = F.when(status == "F", "1003").when(status == "P", "1005").otherwise("1006")
    return change_rows(
        orders,
        "order_info",
        "update",
        {**_order_data(), "order_status": after},
        seconds_of("o_orderdate") + 600,
        {"order_status": before},
    )


def _order_data() -> dict[str, Column | str]:
    return {
        "id": "o_orderkey",
        "user_id": "o_custkey",
        "province_id": F.pmod(F.col("o_custkey"), F.lit(34)),
        "operate_time": F.date_format("o_orderdate", DATETIME),
    }


def payment_updates(orders: DataFrame) -> DataFrame:
    paid_at = seconds_of("o_orderdate") + F.pmod(F.col("o_orderkey"), F.lit(3600))
    return change_rows(
        orders,
        "payment_info",
        "update",
        {
            "user_id": "o_custkey",
            "order_id": "o_orderkey",
            "payment_type": F.pmod(F.col("o_orderkey"), F.lit(30)),
            "callback_time": F.date_format(F.timestamp_seconds(paid_at), DATETIME),
            "payment_status": F.when(F.col("o_orderpriority") == "5-LOW", "1601").otherwise(
                "1602"
            ),
        },
        paid_at,
        {"payment_status": F.lit("1601")},
    )


def _line_ts() -> Column:
    return seconds_of("l_shipdate") + F.col("l_linenumber") * 60


def line_inserts(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        lineitem,
        "order_detail",
        "insert",
        {
            "id": line_id(),
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "sku_name": F.concat(F.lit("sku#"), F.col("l_partkey")),
            "sku_num": F.col("l_quantity").cast("int"),
            "order_price": money_text("l_extendedprice"),
            "create_time": F.date_format("l_shipdate", DATETIME),
            "source_id": "l_suppkey",
            "source_type": "l_linestatus",
            "split_total_amount": money_text("l_extendedprice"),
            "split_activity_amount": money_text("l_discount"),
            "split_coupon_amount": money_text("l_tax"),
        },
        _line_ts(),
    )


def activity_inserts(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        lineitem.where(F.col("l_discount") >= 0.05),
        "order_detail_activity",
        "insert",
        {
            "order_detail_id": line_id(),
            "activity_id": F.pmod(F.col("l_suppkey"), F.lit(10)),
            "activity_rule_id": "l_suppkey",
        },
        _line_ts(),
    )


def coupon_inserts(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        lineitem.where(F.col("l_tax") >= 0.04),
        "order_detail_coupon",
        "insert",
        {"order_detail_id": line_id(), "coupon_id": F.pmod(F.col("l_partkey"), F.lit(100))},
        _line_ts(),
    )


def refund_inserts(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        lineitem.where(F.col("l_returnflag") == "R"),
        "order_refund_info",
        "insert",
        {
            "id": line_id(),
            "user_id": "l_suppkey",
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "refund_type": "l_linenumber",
            "refund_num": F.col("l_quantity").cast("int"),
            "refund_amount": money_text("l_extendedprice"),
            "refund_reason_type": F.pmod(F.col("l_partkey"), F.lit(30)),
            "refund_reason_txt": F.concat(F.lit("status "), F.col("l_linestatus")),
            "create_time": F.date_format("l_shipdate", DATETIME),
        },
        _line_ts(),
    )


def _returned_per_sku(lineitem: DataFrame) -> DataFrame:
    """What came back, one row per order and article."""
    return (
        lineitem.where(F.col("l_returnflag") == "R")
        .groupBy("l_orderkey", "l_partkey")
        .agg(
            F.sum(F.col("l_quantity").cast("int")).alias("num"),
            F.sum(F.col("l_extendedprice").cast("decimal(16,2)"))
            .cast("decimal(16,2)")
            .alias("amount"),
            F.min("l_shipdate").alias("back"),
        )
    )


def refund_updates(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        _returned_per_sku(lineitem),
        "order_refund_info",
        "update",
        {
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "refund_num": "num",
            "refund_status": F.lit("0705"),
        },
        seconds_of("back"),
        {"refund_status": F.lit("0701")},
    )


def refund_payment_updates(lineitem: DataFrame) -> DataFrame:
    return change_rows(
        _returned_per_sku(lineitem),
        "refund_payment",
        "update",
        {
            "id": F.concat_ws("-", "l_orderkey", "l_partkey"),
            "order_id": "l_orderkey",
            "sku_id": "l_partkey",
            "payment_type": F.pmod(F.col("l_orderkey"), F.lit(30)),
            "callback_time": F.date_format("back", DATETIME),
            "total_amount": "amount",
            "refund_status": F.when(
                F.pmod(F.col("l_orderkey"), F.lit(10)) == 0, "1601"
            ).otherwise("1602"),
        },
        seconds_of("back"),
        {"refund_status": F.lit("0701")},
    )


# Which of the two tables each kind of change is made from.
TRADE_CHANGES = {
    order_inserts: "orders",
    order_updates: "orders",
    payment_updates: "orders",
    line_inserts: "lineitem",
    activity_inserts: "lineitem",
    coupon_inserts: "lineitem",
    refund_inserts: "lineitem",
    refund_updates: "lineitem",
    refund_payment_updates: "lineitem",
}
DETAIL_CHANGES = (order_inserts, line_inserts, activity_inserts, coupon_inserts)


def trade_log(spark: SparkSession, sf_dir: str, *kinds) -> DataFrame:
    """One change log of the order, payment and refund tables.

    ``kinds`` names the changes a job subscribes to; by default all.
    """
    kinds = kinds or tuple(TRADE_CHANGES)
    read = {
        name: read_table(spark, sf_dir, name)
        for name in {TRADE_CHANGES[kind] for kind in kinds}
    }
    return reduce(DataFrame.unionByName, [kind(read[TRADE_CHANGES[kind]]) for kind in kinds])


def event_number() -> Column:
    """The number inside an event's JSON properties."""
    return F.get_json_object("props", "$.k").cast("bigint")


def comment_changes(documents: DataFrame) -> DataFrame:
    ts = F.col("doc_id") + 1_704_067_200
    return change_rows(
        documents,
        "comment_info",
        "insert",
        {
            "id": "doc_id",
            "user_id": F.pmod(F.col("doc_id"), F.lit(150)),
            "sku_id": F.pmod(F.col("n_chars"), F.lit(2000)),
            "appraise": F.pmod(F.col("n_chars"), F.lit(30)),
            "comment_txt": "text",
            "create_time": F.date_format(F.timestamp_seconds(ts), DATETIME),
        },
        ts,
    )


def cart_changes(events: DataFrame) -> DataFrame:
    """Clicks add a cart line, purchases change its quantity, views something else."""
    kind = F.col("event_type")
    amount = F.floor("value").cast("int")
    old_amount = F.when(kind == "purchase", event_number())
    return change_rows(
        events.where(kind.isin("click", "purchase", "view")),
        "cart_info",
        F.when(kind == "click", "insert").otherwise("update"),
        {
            "id": "event_id",
            "user_id": "user_id",
            "sku_id": event_number(),
            "sku_num": amount,
        },
        seconds_of("ts"),
        {"sku_num": old_amount},
    )


def profile_changes(events: DataFrame) -> DataFrame:
    """Versions of one profile row per user, with nulls and deletes among them."""
    events = events.withColumn("_k", event_number())
    kind, number = F.col("event_type"), F.col("_k")
    return change_rows(
        events,
        "user_profile",
        F.when(kind == "signup", "insert").when(kind == "error", "delete").otherwise("update"),
        {
            "id": "user_id",
            "last_k": F.when(number >= 10, number),
            "last_type": kind,
            "unlisted": F.lit("x"),
        },
        seconds_of("ts"),
        seq=F.col("event_id"),
    )


def dimension_changes(
    customer: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame
) -> DataFrame:
    """Changes of five source tables, of all four operation types."""
    start = F.lit(1_704_067_200)
    branches = [
        change_rows(
            customer,
            "user_info",
            "insert",
            {"id": "c_custkey", "name": "c_name", "segment": "c_mktsegment",
             "balance": money_text("c_acctbal")},
            start,
        ),
        change_rows(
            part,
            "sku_info",
            F.when(F.pmod(F.col("p_size"), F.lit(10)) == 0, "delete").otherwise(
                "bootstrap-insert"
            ),
            {"id": "p_partkey", "name": "p_name", "brand": "p_brand", "size": "p_size"},
            start,
        ),
        change_rows(
            supplier,
            "supplier_info",
            "update",
            {"id": "s_suppkey", "name": "s_name", "nation_id": "s_nationkey"},
            start,
        ),
        change_rows(
            nation,
            "base_province",
            "insert",
            {"id": "n_nationkey", "name": "n_name", "region_id": "n_regionkey"},
            start,
        ),
        change_rows(region, "base_region", "insert", {"id": "r_regionkey", "name": "r_name"}, start),
    ]
    return reduce(DataFrame.unionByName, branches)


def dimension_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimension_changes(
        *[
            read_table(spark, sf_dir, name)
            for name in ("customer", "part", "supplier", "nation", "region")
        ]
    )


def _rows(spark: SparkSession, data: list[tuple], schema: T.StructType) -> DataFrame:
    """A few fixed rows as part of the plan, so that their size is known to it."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(schema.names, row)]) for row in data]
    return spark.range(1).select(F.inline(F.array(*structs)))


def dimension_rules(spark: SparkSession) -> DataFrame:
    """Rules for all tables but one; one list has a space after its comma."""
    return _rows(
        spark,
        [
            ("user_info", "dim_user_info", "id,name,segment", "info", "id"),
            ("sku_info", "dim_sku_info", "id,name,brand", "info", "id"),
            ("supplier_info", "dim_supplier_info", "id,name, nation_id", "info", "id"),
            ("base_province", "dim_base_province", "id,name,region_id", "info", "id"),
            ("user_profile", "dim_user_profile", "id,last_k,last_type", "info", "id"),
        ],
        DIM_RULE,
    )


KINDS = ("click", "error", "purchase", "signup", "view")


def rule_events(nation: DataFrame) -> DataFrame:
    """Twenty-five changes of the rules for five source tables, one a day, as captured lines of both rule tables.

    Each source table's rule is created, changed (which empties its target), removed, created for a new target, and
    changed again, which moves two of them to one shared target.  Columns: ``feed``, ``value``, ``ts``.
    """
    number = F.col("n_nationkey")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (number % 5 + 1).cast("int"))
    step = F.floor(number / 5)
    op = F.when(step.isin(0, 3), "c").when(step == 2, "d").otherwise("u")
    first, again = F.concat(F.lit("dim_"), kind), F.concat(F.lit("dim_"), kind, F.lit("_again"))
    shared = F.when(number % 5 < 2, F.lit("dim_shared")).otherwise(again)
    listed = F.when(step == 1, "id,k,kind").when(step == 3, "id,kind").otherwise("id,k")
    common = [F.concat(F.lit("t_"), kind).alias("source_table")]
    fixed = [F.lit("info").alias("sink_family"), F.lit("id").alias("sink_row_key")]

    def dim(target, columns):
        return F.struct(*common, target.alias("sink_table"), columns.alias("sink_columns"), *fixed)

    def fact(at):
        kind_of_row = F.when((at * 5 + number % 5) % 2 == 0, "insert").otherwise("update")  # moves with every step
        target = F.concat(F.lit("dwd_"), kind, F.lit("_"), at)
        own = F.when(at % 2 == 0, "id,k").otherwise("id,kind")
        return F.struct(*common, kind_of_row.alias("source_type"), target.alias("sink_table"), own.alias("sink_columns"))

    dim_before = dim(F.when(step == 4, again).otherwise(first), F.lit("id"))
    dim_after = dim(F.when(step < 2, first).when(step == 3, again).otherwise(shared), listed)
    ts = F.timestamp_seconds(F.lit(1_704_067_200) + (number + 1) * 86_400)
    millis = F.unix_millis(ts).alias("ts_ms")

    def line(before, after):
        old = F.when(op != "c", before).alias("before")
        return F.to_json(F.struct(op.alias("op"), old, F.when(op != "d", after).alias("after"), millis))

    lines = F.array(
        F.struct(F.lit("dim").alias("feed"), line(dim_before, dim_after).alias("value")),
        F.struct(F.lit("fact").alias("feed"), line(fact(step - 1), fact(step)).alias("value")),
    )
    return nation.select(F.explode(lines).alias("_l"), ts.alias("ts")).select("_l.*", F.col("ts").cast("timestamp_ntz").alias("ts"))


def early_rules(spark: SparkSession) -> DataFrame:
    """The rule table before its first captured change: two source tables have a rule."""
    rules = [(f"t_{kind}", f"dim_{kind}", "id", "info", "id") for kind in KINDS[:2]]
    return _rows(spark, rules, DIM_RULE)


def early_fact_rules(spark: SparkSession) -> DataFrame:
    return _rows(spark, [("t_view", "insert", "dwd_view_early", "id")], FACT_RULE)


def ruled_changes(events: DataFrame) -> DataFrame:
    """Events as changes of five source tables, deletes and null columns among them."""
    events = events.withColumn("_k", event_number())
    number = F.col("_k")
    return change_rows(
        events,
        F.concat(F.lit("t_"), F.col("event_type")),
        F.when(number % 10 == 0, "delete").when(number % 3 == 0, "update").otherwise("insert"),
        {
            "id": "user_id",
            "k": F.when(number >= 10, number),
            "kind": "event_type",
            "unlisted": F.lit("x"),
        },
        seconds_of("ts"),
        seq=F.col("event_id"),
    )


def fact_changes_of_events(events: DataFrame) -> DataFrame:
    """Events as inserts and updates of the tables that need no join."""
    kind = F.col("event_type")
    table = (
        F.when(kind.isin("purchase", "click"), "coupon_use")
        .when(kind == "view", "favor_info")
        .when(kind == "signup", "user_info")
        .otherwise("order_status_log")
    )
    return change_rows(
        events,
        table,
        F.when(kind == "click", "update").otherwise("insert"),
        {"id": "event_id", "user_id": "user_id", "k": event_number(), "extra": "event_type"},
        seconds_of("ts"),
    )


def fact_rules(spark: SparkSession) -> DataFrame:
    return _rows(
        spark,
        [
            ("coupon_use", "insert", "dwd_tool_coupon_get", "id,user_id,k"),
            ("coupon_use", "update", "dwd_tool_coupon_use", "id,user_id"),
            ("favor_info", "insert", "dwd_interaction_favor_add", "id,user_id,k"),
            ("user_info", "insert", "dwd_user_register", "id"),
        ],
        FACT_RULE,
    )


def nation_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as the code dictionary, codes 0 to 24."""
    return snapshots.dictionary(read_table(spark, sf_dir, "nation"), "n_nationkey", "n_name")


def dictionary_events(nation: DataFrame) -> DataFrame:
    """A rename of every second code and a removal of every seventh while the documents come, as captured lines."""
    number = F.col("n_nationkey").cast("bigint")
    op = F.when(number % 7 == 3, "d").when(number % 2 == 0, "u")
    entry = [F.col("n_nationkey").cast("string").alias("dic_code")]
    before = F.struct(*entry, F.col("n_name").alias("dic_name"))
    after = F.struct(*entry, F.concat(F.lit("NEW "), F.col("n_name")).alias("dic_name"))
    seconds = F.lit(1_704_067_200) + 10 * (number + 1)
    line = F.to_json(F.struct(op.alias("op"), before.alias("before"), F.when(op != "d", after).alias("after"), (seconds * 1000).alias("ts_ms")))
    return nation.where(op.isNotNull()).select(line.alias("value"), (seconds - 1_704_067_200).alias("doc_id"))


def behavior_rows(events: DataFrame) -> DataFrame:
    """Events as behaviour-log records; ``seq`` is the arrival number."""
    events = events.withColumn("_k", event_number())
    kind, number = F.col("event_type"), F.col("_k")
    no_map = F.lit(None).cast("map<string,string>")
    no_list = F.lit(None).cast("array<map<string,string>>")
    odd = F.pmod(number, F.lit(2))
    common = {
        "mid": F.concat(F.lit("mid_"), F.col("user_id")),
        "uid": F.when(F.pmod(number, F.lit(10)) != 0, F.col("user_id")),
        "vc": F.concat(F.lit("v"), F.pmod(number, F.lit(3))),
        "ch": kind,
        "ar": F.pmod(number, F.lit(7)),
        "is_new": odd,
    }
    page = {
        "page_id": F.when(kind == "view", "home")
        .when(kind == "click", "good_detail")
        .otherwise("payment"),
        "last_page_id": F.when(F.pmod(number, F.lit(5)) == 0, "login")
        .when(odd == 1, "search")
        .otherwise("home"),
        "item": F.concat(F.lit("Item "), number, F.lit(" for "), kind),
        "item_type": F.when(F.pmod(number, F.lit(4)) == 0, "keyword").otherwise("sku_id"),
        "during_time": F.floor("value").cast("bigint"),
    }
    shown = [
        string_map({"item": number + place, "pos_id": F.lit(place), "ch": F.lit("display")})
        for place in (1, 2)
    ]
    acted = string_map({"action_id": F.lit("cart_add"), "item": number, "ts": "event_id"})
    failed = string_map({"error_code": number + 1000, "msg": F.lit("failed")})
    return events.select(
        string_map(common).alias("common"),
        F.when(kind == "signup", string_map({"entry": F.lit("icon"), "loading_time": number}))
        .otherwise(no_map)
        .alias("start"),
        F.when(kind.isin("view", "click", "purchase"), string_map(page))
        .otherwise(no_map)
        .alias("page"),
        F.when(kind.isin("view", "purchase"), F.array(*shown)).otherwise(no_list).alias("displays"),
        F.when(kind == "click", F.array(acted)).otherwise(no_list).alias("actions"),
        F.when(kind == "error", failed).otherwise(no_map).alias("err"),
        F.concat_ws("_", F.lit("s"), "user_id", number).alias("sid"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_id").alias("seq"),
    )


def behavior(spark: SparkSession, sf_dir: str) -> DataFrame:
    return behavior_rows(read_table(spark, sf_dir, "events"))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = behavior(spark, sf_dir).where(F.col("page").isNotNull())
    return rows.withColumn("et", F.timestamp_millis("ts"))


def spoiled(lines: DataFrame, number: str = "seq") -> DataFrame:
    """Every fiftieth line each is empty, null, cut short, followed by text, a list, a null, doubled, or lacks all fields."""
    kind, value = F.pmod(F.col(number), F.lit(50)), F.col("value")
    shapes = [
        F.lit(""), F.lit(None).cast("string"), F.expr("substring(value, 1, length(value) - 1)"),
        F.concat(value, F.lit(" x")), F.concat(F.lit("["), value, F.lit("]")), F.lit("null"),
        F.concat(value, value), F.lit('{"other": 1}'),
    ]
    out = value
    for k, shape in enumerate(shapes):
        out = F.when(kind == k, shape).otherwise(out)
    return lines.withColumn("value", out)


def change_lines(events: DataFrame) -> DataFrame:
    """The events' change rows as (``seq``, ``value``) lines, some spoiled; ``ts`` is text on every third."""
    rows = fact_changes_of_events(events).drop("et")
    row = rows.withColumn("seq", F.col("data")["id"].cast("bigint"))
    whole = F.struct("database", "table", "type", "data", "ts")
    as_text = F.struct("database", "table", "type", "data", F.col("ts").cast("string").alias("ts"))
    value = F.when(F.col("seq") % 3 == 0, F.to_json(as_text)).otherwise(F.to_json(whole))
    return spoiled(row.select("seq", value.alias("value")))


def behavior_lines(events: DataFrame) -> DataFrame:
    """The behaviour log as (``seq``, ``value``) lines, some spoiled."""
    rows = behavior_rows(events)
    value = F.to_json(F.struct(*[name for name in rows.columns if name != "seq"]))
    return spoiled(rows.select("seq", value.alias("value")))


def shop_lines(events: DataFrame) -> DataFrame:
    """Events as shop events, each type with a time field of its own, as lines, some spoiled."""
    kind = F.col("event_type")
    at = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    named = F.when(kind == "signup", "login").when(kind == "click", "couponRedemption").when(
        kind == "view", "quickBrowse").when(kind == "purchase", "quickPurchase").otherwise("other")
    times = [("signup", "loginTime"), ("click", "redemptionTime"), ("view", "browseTime"), ("purchase", "purchaseTime")]
    fields = [F.when(kind == k, at).alias(name) for k, name in times]
    value = F.to_json(F.struct(F.col("user_id").cast("string").alias("userId"), named.alias("eventType"), *fields, F.lit("10.0.0.1").alias("ipAddress")))
    return spoiled(events.select(F.col("event_id").alias("seq"), value.alias("value")))


def metric_lines(events: DataFrame) -> DataFrame:
    """Events as metric events with their nested context, times written at the writer's offset, as lines, some spoiled."""
    at = F.date_format(F.col("ts") + F.expr("interval 8 hours"), DATETIME)
    context = F.struct(
        F.struct(F.lit("10.0.0.1").alias("ip"), F.concat(F.lit("p"), event_number()).alias("province")).alias("device"),
        F.struct(F.lit("gold").alias("grade")).alias("profile"),
        F.struct(F.col("value").cast("decimal(16,2)").alias("price")).alias("product"),
    )
    named = F.when(F.col("event_type") == "signup", "LOGIN_SUCCESS").otherwise(F.upper("event_type"))
    value = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("event_id"), F.col("user_id").cast("int").alias("user_id_int"),
        named.alias("event_name"), F.col("event_type"), F.lit("x").alias("event_level"), at.alias("event_time"), context.alias("event_context"),
    ))
    return spoiled(events.select(F.col("event_id").alias("seq"), value.alias("value")))


def trade_moments(events: DataFrame) -> DataFrame:
    """Events as orders and refunds whose parts come seconds or minutes apart, some of them too far apart to meet.

    A purchase is an order line; its order comes -1 to 7 s later, its activity 0 to 7 s later, its coupon 0 to 6 s before,
    a cancellation up to 33 minutes later.  A view is a paid refund; the refund's end comes 0 to 7 s later, its order's
    0 to 6 s before.  Every eleventh line has no order.
    """
    events = events.withColumn("_k", event_number()).withColumn("_s", seconds_of("ts"))
    k, s = F.col("_k"), F.col("_s")
    bought, viewed = events.where(F.col("event_type") == "purchase"), events.where(F.col("event_type") == "view")
    line = {
        "id": "event_id",
        "order_id": F.when(k % 11 != 0, F.col("event_id")),
        "sku_id": k,
        "sku_name": F.concat(F.lit("sku#"), k),
        "sku_num": F.lit(2),
        "order_price": money_text("value"),
        "create_time": F.date_format(F.timestamp_seconds(s), DATETIME),
        "split_total_amount": money_text("value"),
        "split_activity_amount": F.lit("0.00"),
        "split_coupon_amount": F.lit("0.00"),
    }
    order = {"id": "event_id", "user_id": "user_id", "province_id": k % 34, "operate_time": F.date_format(F.timestamp_seconds(s), DATETIME)}
    refund = {"id": "event_id", "order_id": "event_id", "sku_id": k, "payment_type": k % 25,
              "callback_time": F.date_format(F.timestamp_seconds(s), DATETIME), "total_amount": money_text("value")}
    parts = [
        change_rows(bought, "order_detail", "insert", line, s),
        change_rows(bought, "order_info", "insert", {**order, "order_status": F.lit("1001")}, s + k % 9 - 1),
        change_rows(bought.where(k % 2 == 0), "order_detail_activity", "insert",
                    {"order_detail_id": "event_id", "activity_id": k % 10, "activity_rule_id": k}, s + k % 8),
        change_rows(bought.where(k % 3 == 0), "order_detail_coupon", "insert",
                    {"order_detail_id": "event_id", "coupon_id": k % 100}, s - k % 7),
        change_rows(bought.where(k % 4 == 0), "order_info", "update", {**order, "order_status": F.lit("1003")}, s + k * 20,
                    {"order_status": F.lit("1001")}),
        change_rows(viewed, "refund_payment", "update", {**refund, "refund_status": F.lit("1602")}, s, {"refund_status": F.lit("0701")}),
        change_rows(viewed, "order_refund_info", "update",
                    {"order_id": "event_id", "sku_id": k, "refund_num": F.lit(1), "refund_status": F.lit("0705")}, s + k % 8,
                    {"refund_status": F.lit("0701")}),
        change_rows(viewed, "order_info", "update", {**order, "order_status": F.lit("1006")}, s - k % 7, {"order_status": F.lit("1005")}),
    ]
    return reduce(DataFrame.unionByName, parts)


def closing_moments(at: datetime) -> list[dict]:
    """One far-future row for every kind of change in ``trade_moments``, each of its own order, so that all of them move on."""
    kinds = [
        ("order_detail", "insert", {}, None),
        ("order_info", "insert", {"order_status": "1001"}, None),
        ("order_detail_activity", "insert", {}, None),
        ("order_detail_coupon", "insert", {}, None),
        ("order_info", "update", {"order_status": "1003"}, {"order_status": "1001"}),
        ("refund_payment", "update", {"refund_status": "1602"}, {"refund_status": "0701"}),
        ("order_refund_info", "update", {"refund_status": "0705"}, {"refund_status": "0701"}),
        ("order_info", "update", {"order_status": "1006"}, {"order_status": "1005"}),
    ]
    return [
        {"database": DATABASE, "table": table, "type": kind, "old": old, "ts": 0, "et": at,
         "data": {**data, **dict.fromkeys(("id", "order_id", "order_detail_id", "sku_id"), f"end {k}")}}
        for k, (table, kind, data, old) in enumerate(kinds)
    ]


PROFILE_VALUE = "user_id string, k string, kind string"


def profile_messages(events: DataFrame) -> DataFrame:
    """Events as an upsert topic keyed by user: the newest profile replaces older ones, an error removes it."""
    row = F.struct(F.col("user_id").cast("string").alias("user_id"), event_number().cast("string").alias("k"), F.col("event_type").alias("kind"))
    return events.select(
        F.col("user_id").cast("string").alias("key"),
        F.when(F.col("event_type") != "error", F.to_json(row)).alias("value"),
        seconds_of("ts").alias("ts"),
        F.col("event_id").alias("seq"),
    )


def document_searches(documents: DataFrame) -> DataFrame:
    """Whole document texts as search phrases, one second apart."""
    seconds = F.col("doc_id") + 1_704_067_200
    return documents.select(
        string_map(
            {
                "last_page_id": F.when(F.pmod("doc_id", F.lit(2)) == 0, "search").otherwise("home"),
                "item_type": F.lit("keyword"),
                "item": "text",
            }
        ).alias("page"),
        F.timestamp_seconds(seconds).alias("et"),
    )
