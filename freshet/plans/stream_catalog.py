"""Streaming jobs run over the stored tables, by query name.

Each replays its table through Structured Streaming into the shared folder and
returns the written rows.  A table of many files is fed in event-time order,
as a topic would bring it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.times import DATETIME
from freshet.operators import log_split, routing, rule_log
from freshet.operators.joins import interval_join
from freshet.plans import facts, summaries
from freshet.plans.catalog import Query, routed_columns
from freshet.sources import tables
from freshet.session import run_dir
from freshet.sources.logs import FACT_DELAY, SUMMARY_DELAY, watermarked
from freshet.streaming import ruled, sinks, stateful
from freshet.streaming.replay import CLOSING_TIME, replay


def _closing(*kinds: str) -> list[dict]:
    """One far-future event of each kind, so that it passes the job's filters."""
    at = datetime.strptime(CLOSING_TIME, "%Y-%m-%d %H:%M:%S")
    return [
        {"event_id": -1, "ts": at, "user_id": -1, "event_type": kind, "value": 0.0,
         "props": '{"k": 0}'}
        for kind in kinds
    ]


def _timed(events: DataFrame) -> DataFrame:
    return watermarked(
        events.withColumn("et", F.col("ts").cast("timestamp")), "et", SUMMARY_DELAY
    )


def _events_path(sf_dir: str) -> str:
    """A pattern: a file stream takes folders and patterns, not one file."""
    return f"{sf_dir}/[e]vents.parquet"


def stream_order_users_10s(spark, sf_dir):
    def job(events):
        orders = _timed(events.where(F.col("event_type") == "purchase"))
        return summaries.order_users(orders)

    return spark.read.parquet(
        replay(spark, "order_users", _events_path(sf_dir), _closing("purchase"), job)
    ).drop("batch_id")


def stream_login_returning_10s(spark, sf_dir):
    def job(events):
        logins = _timed(events.where(F.col("event_type") == "signup"))
        return summaries.login_users(logins, "user_id", "et", 8)

    return spark.read.parquet(
        replay(spark, "login_users", _events_path(sf_dir), _closing("signup"), job)
    ).drop("batch_id")


def _stream_pages(events: DataFrame) -> DataFrame:
    log = tables.behavior_rows(events).withColumn("et", F.timestamp_millis("ts"))
    return watermarked(log, "et", SUMMARY_DELAY)


def stream_page_multi_dim_5s(spark, sf_dir):
    """The whole path: repair visitors, keep page views, count per window."""

    def job(events):
        fixed = stateful.repair_new_visitors(_stream_pages(events), "et", ["seq"])
        return summaries.page_views(log_split.pages(fixed), ["ts", "seq"])

    return spark.read.parquet(
        replay(spark, "page_views", _events_path(sf_dir), _closing("view"), job)
    ).drop("batch_id")


def stream_login_sliding_1h_5m(spark, sf_dir):
    def job(events):
        logins = _timed(events.where(F.col("event_type") == "signup"))
        named = logins.withColumn("event_name", F.lit("LOGIN_SUCCESS"))
        return summaries.login_counts(named, "user_id", "et")

    counted = spark.read.parquet(
        replay(spark, "login_counts", _events_path(sf_dir), _closing("signup"), job)
    )
    return counted.select(
        "user_id",
        F.date_format("start", DATETIME).alias("stt"),
        F.date_format("end", DATETIME).alias("edt"),
        "login_count",
    )


def stream_payment_interval_minutes(spark, sf_dir):
    def job(events):
        timed = _timed(events)
        paid = timed.where(F.col("event_type") == "purchase").select(
            "user_id", F.col("event_id").alias("payment_id"), "et"
        )
        clicked = timed.where(F.col("event_type") == "click").select(
            "user_id", F.col("event_id").alias("detail_id"), F.col("et").alias("right_et")
        )
        return interval_join(
            paid, clicked, ["user_id"], facts.PAY_BEFORE_SECONDS, facts.PAY_AFTER_SECONDS
        ).select("user_id", "payment_id", "detail_id")

    return spark.read.parquet(
        replay(spark, "payment_interval", _events_path(sf_dir), [], job)
    ).drop("batch_id")


def stream_coupon_abuse_1h(spark, sf_dir):
    def job(events):
        return stateful.followed_by(
            _timed(events), "user_id", "et", "event_type", "event_id", "click", "purchase", 3600
        )

    alerts = spark.read.parquet(
        replay(spark, "coupon_abuse", _events_path(sf_dir), _closing("view"), job)
    )
    return alerts.select(
        "user_id",
        F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
        F.col("second_ts").cast("timestamp_ntz").alias("second_ts"),
        "message",
    )


def stream_log_fan_out(spark, sf_dir):
    """Records per topic, counted from the written topics."""
    out = replay(
        spark,
        "log_fan_out",
        _events_path(sf_dir),
        [],
        tables.behavior_rows,
        writer=sinks.split_to_topics,
    )
    return spark.read.text(out).groupBy("topic").agg(F.count("value").alias("records"))


def stream_dim_upsert(spark, sf_dir):
    """Each batch is routed with the rules of its moment, then folded on reading."""

    def route(changes):
        rules = tables.dimension_rules(changes.sparkSession)
        return routing.route_dimensions(changes, rules, tables.DATABASE)

    def job(events, others):
        others = others.drop("ts").withColumnRenamed("at_s", "ts").withColumn("seq", F.lit(None).cast("bigint"))
        return tables.profile_changes(events).unionByName(others)

    others = tables.dimension_log(spark, sf_dir).withColumnRenamed("ts", "at_s")
    out = replay(
        spark,
        "dim_upsert",
        _events_path(sf_dir),
        [],
        job,
        writer=lambda path: sinks.after(route, sinks.to_dimension_cells(path, ["ts", "seq"])),
        beside={"others": others.withColumn("ts", F.col("et").cast("timestamp_ntz"))},
    )
    return sinks.read_dimension_cells(spark, out).select("sink_table", "row_key", "col", "value")


def _moments(spark, sf_dir, name, job):
    """A fact job over change rows that come seconds or minutes apart."""
    path = run_dir(spark, f"{name}-changes")
    tables.trade_moments(tables.read_table(spark, sf_dir, "events")).write.parquet(path)
    closing = tables.closing_moments(datetime.strptime(CLOSING_TIME, "%Y-%m-%d %H:%M:%S"))
    out = replay(
        spark, name, path, closing, lambda changes: job(watermarked(changes, "et", FACT_DELAY)), time="et"
    )
    return spark.read.parquet(out).drop("batch_id")


def stream_order_detail_moments(spark, sf_dir):
    """Lines with their order, and activity and coupon where these come within five seconds."""
    return _moments(spark, sf_dir, "order_detail", lambda changes: facts.order_detail(changes).drop("et"))


def stream_order_cancel_moments(spark, sf_dir):
    """Lines of orders that are cancelled within 905 seconds, behind the three joins that make a line."""
    return _moments(
        spark, sf_dir, "order_cancel", lambda changes: facts.order_cancel(changes, facts.order_detail(changes))
    )


def stream_refund_payment_moments(spark, sf_dir):
    """Paid refunds that meet the refund's end and their order within five seconds."""
    names = tables.nation_dictionary(spark, sf_dir)
    return _moments(
        spark, sf_dir, "refund_payment", lambda changes: facts.refund_payment_success(changes, names)
    )


def _ruled_feed(events: DataFrame, rules: DataFrame, kind: str) -> DataFrame:
    """Change rows and rule changes as the lines their topics would bring."""
    lines = tables.ruled_changes(events).drop("et")
    value = F.to_json(F.struct("database", "table", "type", "data", "old", "ts"))
    return ruled.fed(lines.select(value.alias("value"), "seq"), rules.where(F.col("feed") == kind).select("value"))


def _ruled_replay(spark, sf_dir, kind, early, writer):
    """A routing job with rules that change in mid-stream: four slices of events, each with its rule changes."""
    wanted = ruled.DIMENSIONS if kind == "dim" else ruled.FACTS
    return replay(
        spark,
        f"rules_{kind}",
        _events_path(sf_dir),
        [],
        lambda events, rules: _ruled_feed(events, rules, kind),
        writer=lambda path: ruled.by_rules_in_force(
            wanted, path, lambda: early(spark), tables.DATABASE, writer(f"{path}/rows")
        ),
        batches=4,
        beside={"rules": tables.rule_events(tables.read_table(spark, sf_dir, "nation"))},
    )


def stream_rules_change(spark, sf_dir):
    dims, facts_ = (
        spark.read.parquet(f"{_ruled_replay(spark, sf_dir, kind, early, sinks.to_parquet)}/rows")
        for kind, early in (("dim", tables.early_rules), ("fact", tables.early_fact_rules))
    )
    return routed_columns(dims).unionByName(routed_columns(facts_))


def stream_dim_lifecycle(spark, sf_dir):
    out = _ruled_replay(
        spark, sf_dir, "dim", tables.early_rules, lambda path: sinks.to_dimension_cells(path, ["ts", "seq"], fan_in=2)
    )
    lives = rule_log.generations(ruled.rules_of(spark, out))
    live = sinks.read_dimension_cells(spark, f"{out}/rows", tables=lives)
    return live.select("sink_table", "row_key", "col", "value")


def stream_comment_lookup_at(spark, sf_dir):
    """The same while it runs: documents arrive in four slices, each with the dictionary changes of its time."""

    def feed(documents, entries):
        lines = tables.comment_changes(documents)
        return ruled.fed(
            lines.select(F.to_json(F.struct("database", "table", "type", "data", "old", "ts")).alias("value")),
            entries.select("value"),
        )

    out = replay(
        spark,
        "comment_lookup_at",
        f"{sf_dir}/[d]ocuments.parquet",
        [],
        feed,
        writer=lambda path: ruled.by_dictionary_of_the_time(
            path, lambda: tables.nation_dictionary(spark, sf_dir), facts.comment_info, sinks.to_parquet(f"{path}/rows")
        ),
        time="doc_id",
        batches=4,
        beside={"entries": tables.dictionary_events(tables.read_table(spark, sf_dir, "nation"))},
    )
    return spark.read.parquet(f"{out}/rows").drop("batch_id", "comment_txt")


STREAM_QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        stream_order_users_10s,
        stream_login_returning_10s,
        stream_page_multi_dim_5s,
        stream_login_sliding_1h_5m,
        stream_payment_interval_minutes,
        stream_coupon_abuse_1h,
        stream_log_fan_out,
        stream_dim_upsert,
        stream_rules_change,
        stream_dim_lifecycle,
        stream_order_detail_moments,
        stream_order_cancel_moments,
        stream_refund_payment_moments,
        stream_comment_lookup_at,
    )
}
