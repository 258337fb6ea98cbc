"""The warehouse's jobs: which topics each reads, what it does, where it writes.

A job's ``build`` takes a function from topic to lines (a one-column text
stream) and gives the rows to write.  ``start`` wires a job to Kafka; tests
wire the same jobs to folders.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from freshet.functions.times import datetime_to_timestamp, from_seconds
from freshet.operators import log_split
from freshet.plans import facts, summaries
from freshet.sources import kafka, logs
from freshet.sources.jsonlines import parse
from freshet.streaming import ruled, sinks, stateful
from freshet.streaming.replay import use_rocksdb

Lines = Callable[[str], DataFrame]
Snapshot = Callable[[], DataFrame]

# Topics.
BUSINESS_DB = "business_db"
BEHAVIOR_LOG = "behavior_log"
PAGE = "dwd_traffic_page"
ORDER_DETAIL = "dwd_trade_order_detail"
PAYMENT_SUCCESS = "dwd_trade_order_payment_success"
CART_ADD = "dwd_trade_cart_add"
USER_REGISTER = "dwd_user_register"
SHOP_EVENTS = "ecommerce-events"
METRIC_EVENTS = "metric-events"
DIM_RULES = "table_process_dim"
FACT_RULES = "table_process_dwd"
DICTIONARY = "base_dic"


@dataclass(frozen=True)
class Context:
    """What a job may look up; each call reads it afresh.

    ``rules`` is the rule table as it stood before the rule topic begins.
    """

    dictionary: Snapshot | None = None
    rules: Snapshot | None = None
    database: str = facts.DATABASE
    min_gap_days: int = 8


@dataclass(frozen=True)
class Job:
    build: Callable[[Lines, Context], DataFrame]
    # Fact rows go to a topic, by key where later rows replace earlier ones;
    # metric rows go to the OLAP store as JSON lines.
    topic: str | None = None
    key: tuple[str, ...] = ()
    start_from: str = "latest"
    # The kind of rules that route the job's micro-batches, if any.
    ruled: ruled.Kind | None = None
    # A job without state of its own that looks names up as they were at a row's time, done per micro-batch.
    dated: Callable[[DataFrame, DataFrame, str], DataFrame] | None = None


def _changes(lines: Lines) -> DataFrame:
    return logs.change_log(lines(BUSINESS_DB))


def _seconds_fact(lines: Lines, topic: str, schema: str) -> DataFrame:
    """A fact topic whose ``ts`` is in seconds."""
    rows = parse(lines(topic), T.StructType.fromDDL(schema))
    return logs.watermarked(rows.withColumn("et", from_seconds("ts")), "et", logs.SUMMARY_DELAY)


def base_log(lines: Lines, context: Context) -> DataFrame:
    log = logs.behavior_log(lines(BEHAVIOR_LOG)).withColumn("et", F.timestamp_millis("ts"))
    log = logs.watermarked(log, "et", logs.SUMMARY_DELAY)
    fixed = stateful.repair_new_visitors(log, "et") if log.isStreaming else (
        log_split.repair_new_visitors(log, ["ts"])
    )
    return log_split.tagged(fixed)


def base_db(lines: Lines, context: Context) -> DataFrame:
    """Change rows and rule changes; ``writer_of`` routes them batch by batch."""
    return ruled.fed(lines(BUSINESS_DB), lines(FACT_RULES))


def dimensions(lines: Lines, context: Context) -> DataFrame:
    """Change rows and rule changes; ``writer_of`` routes them batch by batch."""
    return ruled.fed(lines(BUSINESS_DB), lines(DIM_RULES))


def order_detail(lines: Lines, context: Context) -> DataFrame:
    return facts.order_detail(_changes(lines), context.database).drop("et")


def order_cancel(lines: Lines, context: Context) -> DataFrame:
    details = logs.order_detail_facts(lines(ORDER_DETAIL))
    return facts.order_cancel(_changes(lines), details, context.database)


def payment_success(lines: Lines, context: Context) -> DataFrame:
    details = logs.order_detail_facts(lines(ORDER_DETAIL))
    return facts.payment_success(
        _changes(lines), details, context.dictionary(), context.database
    )


def order_refund(lines: Lines, context: Context) -> DataFrame:
    return facts.order_refund(_changes(lines), context.dictionary(), context.database)


def refund_payment_success(lines: Lines, context: Context) -> DataFrame:
    return facts.refund_payment_success(_changes(lines), context.dictionary(), context.database)


def comment_info(lines: Lines, context: Context) -> DataFrame:
    """Change rows and dictionary changes; ``writer_of`` looks names up batch by batch."""
    return ruled.fed(lines(BUSINESS_DB), lines(DICTIONARY))


def cart_add(lines: Lines, context: Context) -> DataFrame:
    return facts.cart_add(_changes(lines), context.database)


def keywords(lines: Lines, context: Context) -> DataFrame:
    return summaries.keyword_counts(logs.page_log(lines(PAGE)))


def page_views(lines: Lines, context: Context) -> DataFrame:
    return summaries.page_views(logs.page_log(lines(PAGE)), ["et"])


def home_detail(lines: Lines, context: Context) -> DataFrame:
    return summaries.home_detail_users(logs.page_log(lines(PAGE)))


def logins(lines: Lines, context: Context) -> DataFrame:
    return summaries.login_users_of_pages(logs.page_log(lines(PAGE)), context.min_gap_days)


def registrations(lines: Lines, context: Context) -> DataFrame:
    users = parse(lines(USER_REGISTER), T.StructType.fromDDL("create_time string"))
    timed = users.select(datetime_to_timestamp("create_time").alias("et"))
    return summaries.registrations(logs.watermarked(timed, "et", logs.SUMMARY_DELAY))


def cart_users(lines: Lines, context: Context) -> DataFrame:
    return summaries.cart_users(_seconds_fact(lines, CART_ADD, "user_id string, ts bigint"))


def payment_users(lines: Lines, context: Context) -> DataFrame:
    return summaries.payment_users(
        _seconds_fact(lines, PAYMENT_SUCCESS, "user_id string, ts bigint")
    )


def order_users(lines: Lines, context: Context) -> DataFrame:
    return summaries.order_users(
        logs.order_detail_facts(lines(ORDER_DETAIL), logs.SUMMARY_DELAY)
    )


def coupon_abuse(lines: Lines, context: Context) -> DataFrame:
    events = logs.shop_events(lines(SHOP_EVENTS)).withColumn("tie", F.lit(0))
    return stateful.followed_by(
        events, "user_id", "et", "event_type", "tie", "couponRedemption", "quickPurchase", 60
    ).select("user_id", "message")


def login_counts(lines: Lines, context: Context) -> DataFrame:
    return summaries.login_counts(logs.metric_events(lines(METRIC_EVENTS)), "user_id_int", "et")


JOBS: dict[str, Job] = {
    "dwd_base_log": Job(base_log, topic="topic"),
    "dwd_base_db": Job(base_db, topic="topic", ruled=ruled.FACTS),
    "dim_app": Job(dimensions, ruled=ruled.DIMENSIONS),
    ORDER_DETAIL: Job(order_detail, ORDER_DETAIL, key=("id",)),
    "dwd_trade_order_cancel": Job(order_cancel, "dwd_trade_order_cancel"),
    PAYMENT_SUCCESS: Job(payment_success, PAYMENT_SUCCESS),
    "dwd_trade_order_refund": Job(order_refund, "dwd_trade_order_refund"),
    "dwd_trade_refund_payment_success": Job(
        refund_payment_success, "dwd_trade_refund_payment_success"
    ),
    "dwd_interaction_comment_info": Job(
        comment_info, "dwd_interaction_comment_info", dated=facts.comment_info
    ),
    CART_ADD: Job(cart_add, CART_ADD),
    "dws_traffic_source_keyword_page_view_window": Job(keywords),
    "dws_traffic_page_view_window": Job(page_views),
    "dws_traffic_home_detail_page_view_window": Job(home_detail),
    "dws_user_user_login_window": Job(logins),
    "dws_user_user_register_window": Job(registrations),
    "dws_trade_cart_add_uu_window": Job(cart_users),
    "dws_trade_payment_suc_window": Job(payment_users),
    "dws_trade_order_window": Job(order_users),
    "coupon_abuse": Job(coupon_abuse, start_from="earliest"),
    "login_counts": Job(login_counts, start_from="earliest"),
}


def messages(name: str, rows: DataFrame) -> DataFrame:
    """A job's rows as Kafka messages; a ``topic`` column decides where there is one."""
    job = JOBS[name]
    if job.ruled is ruled.FACTS:
        return rows.select(F.col("sink_table").alias("topic"), F.to_json("data").alias("value"))
    if job.topic == "topic":
        return rows.select("topic", "value")
    return sinks.as_messages(rows, key=job.key)


def writer_of(name: str, folder: str, context: Context, writer: sinks.BatchWriter) -> sinks.BatchWriter:
    """``writer`` behind what the job does to each micro-batch: routing by the rules in force, and making messages."""
    job = JOBS[name]
    if job.topic is not None:
        writer = sinks.after(lambda rows: messages(name, rows), writer)
    if job.dated is not None:
        def step(rows: DataFrame, names: DataFrame) -> DataFrame:
            return job.dated(rows, names, context.database)

        return ruled.by_dictionary_of_the_time(folder, context.dictionary, step, writer)
    if job.ruled is None:
        return writer
    return ruled.by_rules_in_force(job.ruled, folder, context.rules, context.database, writer)


def start(
    spark: SparkSession,
    name: str,
    servers: str,
    folder: str,
    context: Context = Context(),
) -> StreamingQuery:
    """Runs a job from Kafka; ``folder`` is shared and holds its state, and its
    rows where they do not go to a topic."""
    use_rocksdb(spark)
    job = JOBS[name]
    by_batch = job.ruled is not None or job.dated is not None

    def lines(topic: str) -> DataFrame:
        # a rule change counts from its time on, however long ago, so its topic is read from the start
        begin = "earliest" if topic in (DIM_RULES, FACT_RULES, DICTIONARY) else job.start_from
        options = kafka.read_options(servers, topic, name, begin)
        return kafka.read_topic(spark, options, numbered=by_batch)

    rows = job.build(lines, context)
    state = f"{folder}/state"
    target = None if job.topic == "topic" else job.topic
    if job.topic is not None and not by_batch:
        return (
            messages(name, rows)
            .writeStream.format("kafka")
            .options(**sinks.kafka_options(servers, target))
            .option("checkpointLocation", state)
            .trigger(processingTime="5 seconds")
            .start()
        )
    if name == "dim_app":
        writer = sinks.to_dimension_cells(f"{folder}/rows", ["ts", "seq"])
    elif job.topic is None:
        writer = sinks.to_olap_lines(f"{folder}/rows")
    else:
        writer = sinks.to_kafka(sinks.kafka_options(servers, target))
    return sinks.start(rows, state, writer_of(name, folder, context, writer), available_now=False)
