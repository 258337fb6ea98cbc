"""Every job over the star-schema tables, by query name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freshet.functions import times
from freshet.functions.text import register_kw_split
from freshet.operators import dimension, joins, log_split, pattern, routing, rule_log, visits
from freshet.operators.joins import interval_join
from freshet.operators.ordered import number_chunk
from freshet.plans import facts, summaries
from freshet.schemas import BEHAVIOR, CHANGE, DICTIONARY_ENTRY, DIM_RULE, FACT_RULE, METRIC_EVENT, SHOP_EVENT
from freshet.session import run_dir
from freshet.sources import jsonlines, logs, snapshots, tables
from freshet.streaming import sinks

Query = Callable[[SparkSession, str], DataFrame]

DAY_SECONDS = 86_400


def _events(spark: SparkSession, sf_dir: str, *kinds: str) -> DataFrame:
    events = tables.read_table(spark, sf_dir, "events")
    return events.where(F.col("event_type").isin(*kinds)) if kinds else events


def order_users_10s(spark, sf_dir):
    return summaries.order_users(_events(spark, sf_dir, "purchase"), ts="ts")


def payment_users_10s(spark, sf_dir):
    """Users whose order was paid, from the payment changes themselves."""
    paid = facts.paid_orders(tables.trade_log(spark, sf_dir, tables.payment_updates))
    return summaries.payment_users(paid)


def cart_users_5s(spark, sf_dir):
    added = tables.cart_changes(tables.read_table(spark, sf_dir, "events"))
    return summaries.cart_users(
        facts.cart_add(added).withColumn("et", F.timestamp_seconds("ts"))
    )


def login_returning_10s(spark, sf_dir):
    return summaries.login_users(_events(spark, sf_dir, "signup"), "user_id", "ts", 8)


def login_returning_7d(spark, sf_dir):
    return summaries.login_users(_events(spark, sf_dir, "signup"), "user_id", "ts", 7)


def login_pages_10s(spark, sf_dir):
    return summaries.login_users_of_pages(tables.page_views(spark, sf_dir))


def home_detail_uv_5s(spark, sf_dir):
    return summaries.home_detail_users(tables.page_views(spark, sf_dir))


def page_multi_dim_5s(spark, sf_dir):
    return summaries.page_views(tables.page_views(spark, sf_dir), ["et", "seq"])


def register_count_5s(spark, sf_dir):
    return summaries.registrations(_events(spark, sf_dir, "signup"), "ts")


def login_sliding_1h_5m(spark, sf_dir):
    logins = _events(spark, sf_dir).select(
        "user_id",
        "ts",
        F.when(F.col("event_type") == "signup", "LOGIN_SUCCESS").alias("event_name"),
    )
    counted = summaries.login_counts(logins, "user_id", "ts")
    return counted.select(
        "user_id",
        F.date_format("start", times.DATETIME).alias("stt"),
        F.date_format("end", times.DATETIME).alias("edt"),
        "login_count",
    )


def keyword_counts(spark, sf_dir):
    return summaries.keyword_counts(
        tables.document_searches(tables.read_table(spark, sf_dir, "documents"))
    )


def keyword_lateral(spark, sf_dir):
    """The table function joined laterally, counted per source."""
    register_kw_split(spark)
    return spark.sql(
        """
        SELECT source, keyword, count(*) AS keyword_count
        FROM {documents} AS d, LATERAL kw_split(d.text)
        GROUP BY source, keyword
        """,
        documents=tables.read_table(spark, sf_dir, "documents"),
    )


def coupon_abuse(spark, sf_dir):
    return pattern.followed_by(
        _events(spark, sf_dir), "user_id", "ts", "event_type", "event_id",
        "click", "purchase", 60,
    )


def coupon_abuse_1h(spark, sf_dir):
    return pattern.followed_by(
        _events(spark, sf_dir), "user_id", "ts", "event_type", "event_id",
        "click", "purchase", 3600,
    )


def order_detail_wide(spark, sf_dir):
    return facts.order_detail(tables.trade_log(spark, sf_dir, *tables.DETAIL_CHANGES)).drop("et")


def order_cancel(spark, sf_dir):
    log = tables.trade_log(spark, sf_dir, tables.order_updates, *tables.DETAIL_CHANGES)
    return facts.order_cancel_of_log(log)


def payment_interval(spark, sf_dir):
    log = tables.trade_log(spark, sf_dir, tables.payment_updates, *tables.DETAIL_CHANGES)
    names = tables.nation_dictionary(spark, sf_dir)
    return facts.payment_success_of_log(log, names, lower_seconds=30 * DAY_SECONDS)


def payment_interval_minutes(spark, sf_dir):
    """Purchases and the clicks of the same user in the half hour before."""
    paid = _events(spark, sf_dir, "purchase").select(
        "user_id", F.col("event_id").alias("payment_id"), F.col("ts").alias("et")
    )
    clicked = _events(spark, sf_dir, "click").select(
        "user_id", F.col("event_id").alias("detail_id"), F.col("ts").alias("right_et")
    )
    pairs = interval_join(
        paid, clicked, ["user_id"], facts.PAY_BEFORE_SECONDS, facts.PAY_AFTER_SECONDS
    )
    return pairs.select("user_id", "payment_id", "detail_id")


def order_refund(spark, sf_dir):
    log = tables.trade_log(spark, sf_dir, tables.refund_inserts, tables.order_updates)
    return facts.order_refund(log, tables.nation_dictionary(spark, sf_dir))


def refund_payment(spark, sf_dir):
    log = tables.trade_log(
        spark, sf_dir, tables.refund_payment_updates, tables.refund_updates, tables.order_updates
    )
    return facts.refund_payment_success(log, tables.nation_dictionary(spark, sf_dir))


def comment_lookup(spark, sf_dir):
    changes = tables.comment_changes(tables.read_table(spark, sf_dir, "documents"))
    return facts.comment_info(changes, tables.nation_dictionary(spark, sf_dir))


def comment_lookup_at(spark, sf_dir):
    """Comments with the name their rating had at the comment's time, while codes are renamed and removed."""
    nation = tables.read_table(spark, sf_dir, "nation")
    changes = tables.comment_changes(tables.read_table(spark, sf_dir, "documents"))
    lines = tables.dictionary_events(nation).select("value", F.lit(None).cast("bigint").alias("seq"))
    first = nation.select(F.col("n_nationkey").cast("string").alias("dic_code"), F.col("n_name").alias("dic_name"))
    known = snapshots.rule_changes(lines, DICTIONARY_ENTRY).unionByName(rule_log.as_changes(first))
    return facts.comment_info(changes, joins.dictionary_versions_of(known)).drop("comment_txt")


def cart_add(spark, sf_dir):
    return facts.cart_add(tables.cart_changes(tables.read_table(spark, sf_dir, "events")))


def new_visitor_fix(spark, sf_dir):
    fixed = log_split.repair_new_visitors(tables.behavior(spark, sf_dir), ["ts", "seq"])
    return fixed.select(
        "seq", F.col("common")["mid"].alias("mid"), F.col("common")["is_new"].alias("is_new")
    )


def _log(spark, sf_dir):
    return log_split.repair_new_visitors(tables.behavior(spark, sf_dir), ["ts", "seq"])


def _common() -> list:
    return [
        F.col("common")[name].alias(name) for name in ("mid", "uid", "ch", "is_new")
    ]


def _overlaid(*names: str) -> list:
    return [F.col("record")[name].alias(name) for name in names]


def log_split_start(spark, sf_dir):
    rows = log_split.starts(_log(spark, sf_dir))
    return rows.select(
        "seq", *_common(), F.col("start")["loading_time"].alias("loading_time"), "ts"
    )


def log_split_display(spark, sf_dir):
    rows = log_split.displays(_log(spark, sf_dir))
    return rows.select("seq", *_overlaid("item", "pos_id", "ch", "mid", "uid", "is_new", "ts"))


def log_split_action(spark, sf_dir):
    rows = log_split.actions(_log(spark, sf_dir))
    return rows.select("seq", *_overlaid("item", "action_id", "ch", "mid", "is_new", "ts"))


def log_split_err(spark, sf_dir):
    rows = log_split.errors(_log(spark, sf_dir))
    return rows.select(
        "seq", *_common(), F.col("err")["error_code"].alias("error_code"), "ts"
    )


def log_split_page(spark, sf_dir):
    rows = log_split.pages(_log(spark, sf_dir))
    page = F.col("page")
    return rows.select(
        "seq",
        *_common(),
        page["page_id"].alias("page_id"),
        page["last_page_id"].alias("last_page_id"),
        page["item"].alias("item"),
        page["during_time"].alias("during_time"),
        "sid",
        "ts",
    )


def log_fan_out(spark, sf_dir):
    """Records per topic out of the one-pass split."""
    return (
        log_split.tagged(_log(spark, sf_dir))
        .groupBy("topic")
        .agg(F.count("value").alias("records"))
    )


def dim_routing(spark, sf_dir):
    routed = routing.route_dimensions(
        tables.dimension_log(spark, sf_dir), tables.dimension_rules(spark), tables.DATABASE
    )
    return routed.select(
        "sink_table", "sink_family", "row_key", "op_type", F.explode("data").alias("col", "value")
    )


def dim_upsert(spark, sf_dir):
    """The live cells of all five dimension tables, folded from one log."""
    log = tables.profile_changes(tables.read_table(spark, sf_dir, "events")).unionByName(
        tables.dimension_log(spark, sf_dir), allowMissingColumns=True
    )
    routed = routing.route_dimensions(log, tables.dimension_rules(spark), tables.DATABASE)
    live = dimension.live_cells(dimension.cells(routed, ["ts", "seq"]))
    return live.select("sink_table", "row_key", "col", "value")


def rule_changes_of(spark, sf_dir, kind):
    """All versions of the test tables' rules of one kind, the early ones among them."""
    lines = tables.rule_events(tables.read_table(spark, sf_dir, "nation")).where(F.col("feed") == kind)
    schema, early = (
        (DIM_RULE, tables.early_rules) if kind == "dim" else (FACT_RULE, tables.early_fact_rules)
    )
    changes = snapshots.rule_changes(lines.select("value", F.lit(None).cast("bigint").alias("seq")), schema)
    return changes.unionByName(rule_log.as_changes(early(spark)))


def routed_columns(rows):
    """What the rule-change queries show of a routed row."""
    data = F.col("data")
    op_type = F.col("op_type") if "op_type" in rows.columns else F.lit(None).cast("string").alias("op_type")
    return rows.select("seq", "sink_table", op_type, *[data[n].alias(n) for n in ("id", "k", "kind", "unlisted")])


def rules_change(spark, sf_dir):
    """Every change row under the rules of its moment, dimensions and facts."""
    changes = tables.ruled_changes(tables.read_table(spark, sf_dir, "events"))
    dims = rule_log.rule_log(rule_changes_of(spark, sf_dir, "dim"), rule_log.DIM_KEYS)
    facts_ = rule_log.rule_log(rule_changes_of(spark, sf_dir, "fact"), rule_log.FACT_KEYS)
    return routed_columns(rule_log.route_dimensions_at(changes, dims, tables.DATABASE)).unionByName(
        routed_columns(rule_log.route_facts_at(changes, facts_, tables.DATABASE))
    )


def dim_lifecycle(spark, sf_dir):
    """Live cells of dimension tables that are created, emptied, moved and dropped on the way."""
    known = rule_changes_of(spark, sf_dir, "dim")
    changes = tables.ruled_changes(tables.read_table(spark, sf_dir, "events"))
    routed = rule_log.route_dimensions_at(
        changes, rule_log.rule_log(known, rule_log.DIM_KEYS), tables.DATABASE
    )
    lives = rule_log.generations(known)
    keys = ("sink_table", "generation", "row_key")
    written = dimension.cells(rule_log.with_generation(routed, lives), ["ts", "seq"], keys)
    live = dimension.live_cells(rule_log.of_living_tables(written, lives), None, keys)
    return live.select("sink_table", "row_key", "col", "value")


def fact_routing(spark, sf_dir):
    events = tables.read_table(spark, sf_dir, "events")
    routed = routing.route_facts(
        tables.fact_changes_of_events(events), tables.fact_rules(spark), tables.DATABASE
    )
    data = F.col("data")
    return routed.select(
        "sink_table",
        data["id"].alias("id"),
        data["user_id"].alias("user_id"),
        data["k"].alias("k"),
        data["extra"].alias("extra"),
        "ts",
    )


def _checked(spark, sf_dir, lines, schema, required):
    return jsonlines.checked(lines(tables.read_table(spark, sf_dir, "events")), schema, required)


def change_log_json(spark, sf_dir):
    """Every line of the change log, as a row or with what is wrong with it."""
    lines = _checked(spark, sf_dir, tables.change_lines, CHANGE, logs.CHANGE_NEEDS)
    data = F.col("data")
    return logs.with_times(jsonlines.every_line(lines)).select(
        "seq", "error", "table", "type",
        *[data[name].alias(name) for name in ("id", "user_id", "k")], "ts", F.unix_seconds("et").alias("et_s"),
    )


def behavior_log_json(spark, sf_dir):
    """Every line of the behaviour log, as a row or with what is wrong with it."""
    lines = _checked(spark, sf_dir, tables.behavior_lines, BEHAVIOR, logs.BEHAVIOR_NEEDS)
    common = F.col("common")

    def many(name):
        return F.when(F.col("error").isNull(), F.size(F.coalesce(name, F.array()))).alias(name)

    return jsonlines.every_line(lines).select(
        "seq", "error",
        *[common[name].alias(name) for name in ("mid", "uid", "is_new")],
        F.col("start")["loading_time"].alias("loading_time"), F.col("page")["page_id"].alias("page_id"),
        F.col("page")["during_time"].alias("during_time"), many("displays"),
        many("actions"), F.col("err")["error_code"].alias("error_code"), "sid", "ts",
    )


def shop_events_json(spark, sf_dir):
    """Every line of the shop's events, with the time its type names."""
    lines = _checked(spark, sf_dir, tables.shop_lines, SHOP_EVENT, logs.SHOP_NEEDS)
    return logs.shop_rows(jsonlines.every_line(lines), ["seq", "error"]).select(
        "seq", "error", "user_id", "event_type", F.unix_seconds("et").alias("et_s")
    )


def metric_events_json(spark, sf_dir):
    """Every line of the metric events, cut to the used columns early."""
    lines = _checked(spark, sf_dir, tables.metric_lines, METRIC_EVENT, logs.METRIC_NEEDS)
    rows = logs.metric_rows(jsonlines.every_line(lines), ["seq", "error"])
    context = F.col("event_context")
    return rows.select(
        "seq", "error", "user_id_int", "event_name", "event_type",
        context["device"]["province"].alias("province"), context["profile"]["grade"].alias("grade"),
        context["product"]["price"].cast("double").alias("price"), F.unix_seconds("et").alias("et_s"),
    )


def upsert_log_table(spark, sf_dir):
    """An upsert topic read as a table: each user's newest message, unless it is a tombstone."""
    messages = tables.profile_messages(tables.read_table(spark, sf_dir, "events"))
    return sinks.upsert_table(messages, T.StructType.fromDDL(tables.PROFILE_VALUE)).drop("ts", "seq", "removed")


def olap_lines(spark, sf_dir):
    """Metric rows through the OLAP sink in eight batches, one of them run twice, read back from its lines."""
    path = run_dir(spark, "olap-lines")
    write = sinks.to_olap_lines(path, hidden=["part"], fan_in=4)
    counted = order_users_10s(spark, sf_dir).select(
        "stt", "edt", F.col("cur_date").alias("curDate"), F.col("order_unique_user_count").alias("orderUniqueUserCount"),
        F.col("order_new_user_count").alias("orderNewUserCount"), F.pmod(F.xxhash64("stt"), F.lit(8)).alias("part"),
    ).persist()
    try:
        for number in (0, 1, 2, 2, 3, 4, 5, 6, 7):
            write(counted.where(F.col("part") == number), number)
    finally:
        counted.unpersist()
    return sinks.read_olap_lines(spark, path)


def arrival_day_changes(spark, sf_dir):
    """Day changes per user when rows arrive out of time order.

    Here every thousand events arrive last one first.
    """
    number = F.col("event_id")
    block = F.floor(number / F.lit(1000)) * 1000
    events = _events(spark, sf_dir).select(
        "user_id", "ts", (block + 999 - F.pmod(number, F.lit(1000))).alias("arrival")
    )
    changed = visits.day_changes(
        events, ["user_id"], "ts", ["arrival"], number_chunk("arrival", 100_000)
    )
    return changed.groupBy("user_id").agg(
        F.count_if("changed").alias("unique_days"),
        F.count_if(F.col("prev_day").isNull()).alias("first_seen"),
    )


def event_time_texts(spark, sf_dir):
    """Epoch numbers to text and back at the writer's offset."""
    events = _events(spark, sf_dir).withColumn(
        "ms", F.unix_millis(F.col("ts").cast("timestamp"))
    )
    text = F.col("datetime_text")
    return events.select(
        "event_id",
        times.millis_to_date("ms").alias("date_text"),
        times.millis_to_datetime("ms").alias("datetime_text"),
        times.millis_to_compact_date("ms").alias("compact_text"),
    ).select(
        "*",
        times.datetime_to_millis(text).alias("writer_millis"),
        times.date_to_millis("date_text").alias("writer_day_millis"),
    )


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        order_users_10s,
        payment_users_10s,
        cart_users_5s,
        login_returning_10s,
        login_returning_7d,
        login_pages_10s,
        home_detail_uv_5s,
        page_multi_dim_5s,
        register_count_5s,
        login_sliding_1h_5m,
        keyword_counts,
        keyword_lateral,
        coupon_abuse,
        coupon_abuse_1h,
        order_detail_wide,
        order_cancel,
        payment_interval,
        payment_interval_minutes,
        order_refund,
        refund_payment,
        comment_lookup,
        comment_lookup_at,
        cart_add,
        new_visitor_fix,
        log_split_start,
        log_split_display,
        log_split_action,
        log_split_err,
        log_split_page,
        log_fan_out,
        dim_routing,
        dim_upsert,
        fact_routing,
        rules_change,
        dim_lifecycle,
        change_log_json,
        behavior_log_json,
        shop_events_json,
        metric_events_json,
        upsert_log_table,
        olap_lines,
        arrival_day_changes,
        event_time_texts,
    )
}
