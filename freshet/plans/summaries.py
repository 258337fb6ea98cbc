"""Windowed metrics, on batch frames and on streams with a watermark on ``et``.

On batch frames the rows a metric counts (first of a day, first of a session)
are found by aggregation alone, see ``operators.visits``; raw rows are never
sorted per user.  On streams they are found by keyed state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freshet.functions.packing import packed_order
from freshet.functions.text import tokens
from freshet.functions.times import COMPACT_DATE, window_labels
from freshet.operators import visits
from freshet.operators.filters import is_login, search_phrases
from freshet.operators.windows import sliding_counts, total, tumbling


def order_users(orders: DataFrame, user: str = "user_id", ts: str = "et") -> DataFrame:
    """Users with an order today, and users ordering for the first time, per 10 s."""
    seen = visits.daily_first(orders, [user], ts).withColumn("_new", visits.is_new())
    return tumbling(
        seen,
        ts,
        "10 seconds",
        [
            F.count(F.lit(1)).alias("order_unique_user_count"),
            total("_new", "order_new_user_count"),
        ],
    )


def payment_users(payments: DataFrame, user: str = "user_id", ts: str = "et") -> DataFrame:
    """Users with a payment today, and users paying for the first time, per 10 s."""
    seen = visits.daily_first(payments, [user], ts).withColumn("_new", visits.is_new())
    return tumbling(
        seen,
        ts,
        "10 seconds",
        [
            F.count(F.lit(1)).alias("payment_suc_unique_user_count"),
            total("_new", "payment_suc_new_user_count"),
        ],
    )


def cart_users(additions: DataFrame, user: str = "user_id", ts: str = "et") -> DataFrame:
    """Users adding to the cart for the first time today, per 5 s."""
    seen = visits.daily_first(additions, [user], ts)
    return tumbling(seen, ts, "5 seconds", [F.count(F.lit(1)).alias("cart_add_uu_ct")])


def login_users(logins: DataFrame, user: str, ts: str, min_gap_days: int = 8) -> DataFrame:
    """Users logging in today, and users back after a break, per 10 s."""
    seen = visits.daily_first(logins, [user], ts).withColumn(
        "_back", visits.is_returning(min_gap_days)
    )
    return tumbling(
        seen,
        ts,
        "10 seconds",
        [total("_back", "back_ct"), F.count(F.lit(1)).alias("uu_ct")],
    )


def login_users_of_pages(pages: DataFrame, min_gap_days: int = 8) -> DataFrame:
    """``login_users`` over page views that arrived from the login page."""
    logins = pages.where(is_login()).select(F.col("common")["uid"].alias("uid"), "et")
    return login_users(logins, "uid", "et", min_gap_days)


def home_detail_users(pages: DataFrame) -> DataFrame:
    """Devices seeing the home page, and a product page, first today, per 5 s."""
    hits = pages.select(
        F.col("common")["mid"].alias("mid"), F.col("page")["page_id"].alias("page_id"), "et"
    ).where(F.col("page_id").isin("home", "good_detail"))
    seen = visits.daily_first(hits, ["mid", "page_id"], "et")
    return tumbling(
        seen,
        "et",
        "5 seconds",
        [
            F.count_if(F.col("page_id") == "home").alias("home_uv_ct"),
            F.count_if(F.col("page_id") == "good_detail").alias("good_detail_uv_ct"),
        ],
    )


PAGE_DIMENSIONS = ["vc", "ch", "ar", "is_new"]


def page_facts(pages: DataFrame, order: list[str]) -> DataFrame:
    """The columns of a page view the page metrics need; ``micros`` is its time, whatever pane ``et`` is in."""
    common = F.col("common")
    session = F.coalesce(F.col("sid"), common["sid"])
    micros = F.col("ts").cast("bigint") * 1000 if "ts" in pages.columns else F.unix_micros("et")
    return pages.select(
        common["mid"].alias("mid"),
        session.alias("sid"),
        *[common[name].alias(name) for name in PAGE_DIMENSIONS],
        F.col("page")["during_time"].try_cast("bigint").alias("during_time"),
        "et",
        *[name for name in order if name != "et"],
        micros.alias("micros"),
    )


def session_starts(facts: DataFrame, order: list[str], keep: list[str], ttl_seconds: int = 3600) -> DataFrame:
    """The rows that start a session: ``order``, ``keep`` and ``micros``; ``facts`` has ``et``, or panes as ``window``.

    A session starts with its first row; its mark holds for ``ttl_seconds``, and the first row after that starts it
    again.  Once per five seconds the session's earliest row decides, so a session is folded over as many rows as it has
    such panes, and in one pass over them.
    """
    pane = (F.col("window") if "window" in facts.columns else F.window("et", "5 seconds")).alias("_pane")
    fields = list(dict.fromkeys([*order, "micros", *keep]))
    firsts = facts.groupBy("sid", pane).agg(F.min(F.struct(*fields)).alias("_row"))
    ordered = firsts.groupBy("sid").agg(F.array_sort(F.collect_list("_row")).alias("_rows"))
    kind = firsts.schema["_row"].dataType.simpleString()

    def step(state, row):
        starts = state["since"].isNull() | (row["micros"] - state["since"] >= ttl_seconds * 1_000_000)
        return F.struct(
            F.when(starts, row["micros"]).otherwise(state["since"]).alias("since"),
            F.when(starts, F.concat(state["found"], F.array(row))).otherwise(state["found"]).alias("found"),
        )

    none = F.struct(F.lit(None).cast("bigint").alias("since"), F.array().cast(f"array<{kind}>").alias("found"))
    found = F.aggregate("_rows", none, step, lambda state: state["found"])
    return ordered.select(F.explode(found).alias("_row")).select("_row.*")


def page_views(pages: DataFrame, order: list[str]) -> DataFrame:
    """Visitors, sessions, views and time spent per version, channel, area and
    visitor kind, per 5 s.

    Rows are counted per window, device and session first; the first ones of a day and of a session are then looked
    for among these counts, and added up per window.
    """
    facts = page_facts(pages, order)
    if facts.isStreaming:
        return _page_views_of_stream(facts, order)

    # One scan: all three counts go on from the same panes, whose exchange Spark makes once.
    panes = (
        facts.withColumn("_order", packed_order(facts, order))
        .groupBy(F.window("et", "5 seconds").alias("window"), "mid", "sid", *PAGE_DIMENSIONS)
        .agg(
            F.count(F.lit(1)).alias("pv"),
            F.sum("during_time").alias("during"),
            F.min("_order").alias("_order"),
            F.min("micros").alias("micros"),
        )
    )

    def part(rows: DataFrame, uv: Column, sv: Column, pv: Column, dur: Column) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        return rows.groupBy("window", *PAGE_DIMENSIONS).agg(
            *[
                F.coalesce(F.sum(value), zero).cast("bigint").alias(name)
                for name, value in (
                    ("uv_ct", uv), ("sv_ct", sv), ("pv_ct", pv), ("dur_sum", dur),
                )
            ]
        )

    one, none = F.lit(1), F.lit(0)
    kept = ["window", *PAGE_DIMENSIONS]
    by_day = visits.first_rows(panes, ["mid", visits.day_of(F.col("window.start"))], ["_order"], kept)
    by_session = session_starts(panes, ["_order"], kept)
    added = (
        part(panes, none, none, F.col("pv"), F.col("during"))
        .unionByName(part(by_day, one, none, none, none))
        .unionByName(part(by_session, none, one, none, none))
    )
    sums = added.groupBy("window", *PAGE_DIMENSIONS).agg(
        *[F.sum(name).alias(name) for name in ("uv_ct", "sv_ct", "pv_ct", "dur_sum")]
    )
    return sums.select(
        *window_labels("window", COMPACT_DATE),
        *PAGE_DIMENSIONS,
        "uv_ct",
        "sv_ct",
        "pv_ct",
        "dur_sum",
    )


def _page_views_of_stream(facts: DataFrame, order: list[str]) -> DataFrame:
    from freshet.streaming.stateful import first_of_day_and_session

    plain = facts.withColumn("_time", F.unix_micros("et"))
    by = ["_time" if name == "et" else name for name in order]
    marked = first_of_day_and_session(
        plain, "mid", "sid", PAGE_DIMENSIONS, "et", by, "micros",
        F.count(F.lit(1)).alias("pv"), F.sum("during_time").alias("during"),
    )
    return tumbling(
        marked,
        "at",
        "5 seconds",
        [
            total("uv", "uv_ct"),
            total("starts", "sv_ct"),
            total("pv", "pv_ct"),
            total("during", "dur_sum"),
        ],
        by=PAGE_DIMENSIONS,
        date_pattern=COMPACT_DATE,
    )


def registrations(users: DataFrame, ts: str = "et") -> DataFrame:
    """New registrations per 5 s."""
    return tumbling(users, ts, "5 seconds", [F.count(F.lit(1)).alias("register_ct")])


def keyword_counts(pages: DataFrame, segment=None) -> DataFrame:
    """How often each keyword was searched for, per 5 s."""
    words = search_phrases(pages).select(
        F.explode(tokens("phrase", segment)).alias("keyword"), "et"
    )
    return tumbling(
        words,
        "et",
        "5 seconds",
        [F.count(F.lit(1)).alias("keyword_count")],
        by=["keyword"],
    )


def login_counts(events: DataFrame, user: str, ts: str, event_name: str = "LOGIN_SUCCESS") -> DataFrame:
    """Successful logins per user over the last hour, every five minutes."""
    logins = events.where(F.col("event_name") == event_name)
    return sliding_counts(logins, ts, [user], panes=12, slide_seconds=300, name="login_count")
