"""Fact tables built from the change log.

Every function takes change rows with ``database, table, type, data, old, ts``
and ``et`` and returns the fact table.  The same code runs on batch frames and
streams; ``fact_join`` picks the join that fits.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freshet.functions.amounts import line_amount
from freshet.functions.times import date_of_text
from freshet.operators import filters
from freshet.operators.joins import fact_join, interval_join, lookup, lookup_at
from freshet.schemas import ORDER_DETAIL_FACT

DATABASE = "gmall"

# Status codes of the business database.
ORDER_CREATED = "1001"
ORDER_CANCELLED = "1003"
ORDER_REFUND_ASKED = "1005"
ORDER_REFUNDED = "1006"
PAID = "1602"
REFUND_DONE = "0705"

# How long join partners may be apart.
REORDER_SECONDS = 5
CANCEL_SECONDS = 905
PAY_BEFORE_SECONDS = 1800
PAY_AFTER_SECONDS = 5


def _same(*names: str) -> dict[str, str]:
    return {name: name for name in names}


def order_detail(
    changes: DataFrame,
    database: str = DATABASE,
    *,
    lines_of: Callable[[DataFrame], DataFrame] | None = None,
    orders_of: Callable[[DataFrame], DataFrame] | None = None,
    carried: Sequence[str] = (),
    sample_of: DataFrame | None = None,
) -> DataFrame:
    """Order lines with their order, and activity and coupon where there is one.

    Carries ``et`` behind the fact columns for the jobs that read it next.  A job over stored tables that needs few of
    the details leaves the rest out before they are made wide: ``lines_of`` and ``orders_of`` join the bare lines or the
    orders with what it looks for, whose columns ``carried`` then come along.
    """
    lines = filters.inserts(
        changes,
        database,
        "order_detail",
        _same(
            "id", "order_id", "sku_id", "sku_name", "sku_num", "order_price", "create_time",
            "split_total_amount", "split_activity_amount", "split_coupon_amount",
        ),
    )
    amount = line_amount(F.col("sku_num"), F.col("order_price"))
    # a stored line goes through two shuffles with its texts as one; where the job leaves lines out, few go
    packed = [] if lines.isStreaming or lines_of or carried else [c for c in lines.columns if c not in ("id", "order_id", "ts", "et")]
    if packed:
        lines = lines.select("id", "order_id", "ts", "et", F.to_json(F.array(*packed)).alias("_line"))
    else:
        lines = lines.withColumn("split_original_amount", amount).drop("order_price")
    orders = filters.inserts(
        changes,
        database,
        "order_info",
        {"order_id": "id", "user_id": "user_id", "province_id": "province_id"},
    )
    sample = lines.select("order_id") if sample_of is None else sample_of
    lines = lines if lines_of is None else lines_of(lines)
    orders = orders if orders_of is None else orders_of(orders)
    activities = filters.inserts(
        changes,
        database,
        "order_detail_activity",
        {"id": "order_detail_id", "activity_id": "activity_id",
         "activity_rule_id": "activity_rule_id"},
    )
    coupons = filters.inserts(
        changes,
        database,
        "order_detail_coupon",
        {"id": "order_detail_id", "coupon_id": "coupon_id"},
    )
    wide = fact_join(
        lines, orders, ["order_id"], bound_seconds=REORDER_SECONDS, sample_of=sample,
    )
    wide = fact_join(
        wide, activities, ["id"], "left", bound_seconds=REORDER_SECONDS, left_unique=True
    )
    wide = fact_join(
        wide, coupons, ["id"], "left", bound_seconds=REORDER_SECONDS, left_unique=True
    )
    if packed:
        texts = F.from_json("_line", "array<string>")
        wide = wide.withColumn("_line", texts).select("*", *[F.col("_line")[k].alias(c) for k, c in enumerate(packed)])
        wide = wide.withColumn("split_original_amount", amount)
    return wide.withColumn("date_id", date_of_text("create_time")).select(
        *[name for name in ORDER_DETAIL_FACT.names if name not in carried], "et", *carried
    )


def order_lines(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """The bare order lines, to look for busy orders in before details are built."""
    return filters.inserts(changes, database, "order_detail", _same("order_id"))


def order_cancel(
    changes: DataFrame,
    details: DataFrame,
    database: str = DATABASE,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Order lines of orders that went from created to cancelled.

    ``lines`` saves building ``details`` twice where they are not a stored table.
    """
    joined = fact_join(
        details.drop("ts"), _cancels(changes, database), ["order_id"], bound_seconds=CANCEL_SECONDS,
        sample_of=details if lines is None else lines,
    )
    return _cancelled(joined)


def order_cancel_of_log(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """``order_cancel`` of a stored log that holds the details too.

    Orders are first joined with their cancellation, so only cancelled lines are made wide, and the lines are
    shuffled by order once.
    """

    def cancelled(orders: DataFrame) -> DataFrame:
        cancels = _cancels(changes, database).drop("et", "ts")
        return fact_join(orders, cancels, ["order_id"], bound_seconds=CANCEL_SECONDS, left_unique=True)

    return _cancelled(order_detail(changes, database, orders_of=cancelled, carried=["operate_time", "cancel_ts"]))


def _cancels(changes: DataFrame, database: str) -> DataFrame:
    return filters.transitions(
        changes,
        database,
        "order_info",
        {"order_id": "id", "operate_time": "operate_time"},
        "order_status",
        ORDER_CANCELLED,
        ORDER_CREATED,
    ).withColumn("cancel_ts", F.col("ts"))


def _cancelled(joined: DataFrame) -> DataFrame:
    return joined.select(
        "id", "order_id", "user_id", "sku_id", "sku_name", "province_id",
        "activity_id", "activity_rule_id", "coupon_id",
        date_of_text("operate_time").alias("date_id"),
        F.col("operate_time").alias("cancel_time"),
        "sku_num", "split_original_amount", "split_activity_amount",
        "split_coupon_amount", "split_total_amount",
        F.col("cancel_ts").alias("ts"),
    )


def paid_orders(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    """Payments that went through: user, order, payment type, time."""
    return filters.transitions(
        changes,
        database,
        "payment_info",
        {"user_id": "user_id", "order_id": "order_id", "payment_type_code": "payment_type",
         "callback_time": "callback_time"},
        "payment_status",
        PAID,
    )


def payment_success(
    changes: DataFrame,
    details: DataFrame,
    dictionary: DataFrame,
    database: str = DATABASE,
    lower_seconds: int = PAY_BEFORE_SECONDS,
    upper_seconds: int = PAY_AFTER_SECONDS,
    lines: DataFrame | None = None,
) -> DataFrame:
    """Order lines placed shortly before their order's payment went through.

    ``lines`` saves building ``details`` twice where they are not a stored table.
    """
    payments = paid_orders(changes, database).drop("user_id")
    placed = details.drop("ts").withColumnRenamed("et", "right_et")
    if lines is not None:
        lines = lines.withColumnRenamed("et", "right_et")
    joined = interval_join(
        payments, placed, ["order_id"], lower_seconds, upper_seconds, sample_of=lines
    )
    return _paid(joined, dictionary)


def payment_success_of_log(
    changes: DataFrame,
    dictionary: DataFrame,
    database: str = DATABASE,
    lower_seconds: int = PAY_BEFORE_SECONDS,
    upper_seconds: int = PAY_AFTER_SECONDS,
) -> DataFrame:
    """``payment_success`` of a stored log that holds the details too: payments meet the bare lines by order and time,
    and only what they meet is made wide."""
    payments = paid_orders(changes, database).drop("user_id").withColumnRenamed("ts", "paid_ts")

    def paid(lines: DataFrame) -> DataFrame:
        placed = lines.drop("ts").withColumnRenamed("et", "right_et")
        return interval_join(
            payments, placed, ["order_id"], lower_seconds, upper_seconds,
            sample_of=order_lines(changes, database).withColumnRenamed("et", "right_et"),
        ).withColumn("ts", F.col("paid_ts"))

    carried = ["payment_type_code", "callback_time", "paid_ts"]
    wide = order_detail(changes, database, lines_of=paid, carried=carried)
    return _paid(wide.drop("ts", "et").withColumnRenamed("paid_ts", "ts"), dictionary)


def _paid(joined: DataFrame, dictionary: DataFrame) -> DataFrame:
    named = lookup(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.select(
        F.col("id").alias("order_detail_id"),
        "order_id", "user_id", "sku_id", "sku_name", "province_id",
        "activity_id", "activity_rule_id", "coupon_id",
        "payment_type_code", "payment_type_name", "callback_time", "sku_num",
        "split_original_amount", "split_activity_amount", "split_coupon_amount",
        F.col("split_total_amount").alias("split_payment_amount"),
        "ts",
    )


def order_refund(
    changes: DataFrame, dictionary: DataFrame, database: str = DATABASE
) -> DataFrame:
    """Refund requests with their order's province and both dictionary names."""
    requests = filters.inserts(
        changes,
        database,
        "order_refund_info",
        {
            "id": "id", "user_id": "user_id", "order_id": "order_id", "sku_id": "sku_id",
            "refund_type_code": "refund_type", "refund_num": "refund_num",
            "refund_amount": "refund_amount", "refund_reason_type": "refund_reason_type",
            "refund_reason_txt": "refund_reason_txt", "create_time": "create_time",
        },
    )
    orders = filters.transitions(
        changes,
        database,
        "order_info",
        {"order_id": "id", "province_id": "province_id"},
        "order_status",
        ORDER_REFUND_ASKED,
    )
    joined = fact_join(
        requests, orders, ["order_id"], bound_seconds=REORDER_SECONDS,
        sample_of=requests.select("order_id"),
    )
    named = lookup(joined, dictionary, "refund_type_code", "refund_type_name")
    named = lookup(named, dictionary, "refund_reason_type", "refund_reason_type_name")
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        date_of_text("create_time").alias("date_id"), "create_time",
        "refund_type_code", "refund_type_name",
        "refund_reason_type", "refund_reason_type_name", "refund_reason_txt",
        "refund_num", "refund_amount", "ts",
    )


def refund_payment_success(
    changes: DataFrame, dictionary: DataFrame, database: str = DATABASE
) -> DataFrame:
    """Refunds that were paid out, with the refunded quantity and the order."""
    payments = filters.transitions(
        changes,
        database,
        "refund_payment",
        {"id": "id", "order_id": "order_id", "sku_id": "sku_id",
         "payment_type_code": "payment_type", "callback_time": "callback_time",
         "refund_amount": "total_amount"},
        "refund_status",
        PAID,
    )
    refunds = filters.transitions(
        changes,
        database,
        "order_refund_info",
        {"order_id": "order_id", "sku_id": "sku_id", "refund_num": "refund_num"},
        "refund_status",
        REFUND_DONE,
    )
    orders = filters.transitions(
        changes,
        database,
        "order_info",
        {"order_id": "id", "user_id": "user_id", "province_id": "province_id"},
        "order_status",
        ORDER_REFUNDED,
    )
    joined = fact_join(
        payments, refunds, ["order_id", "sku_id"], bound_seconds=REORDER_SECONDS
    )
    joined = fact_join(
        joined, orders, ["order_id"], bound_seconds=REORDER_SECONDS,
        sample_of=payments.select("order_id"),
    )
    named = lookup(joined, dictionary, "payment_type_code", "payment_type_name")
    return named.select(
        "id", "user_id", "order_id", "sku_id", "province_id",
        "payment_type_code", "payment_type_name",
        date_of_text("callback_time").alias("date_id"), "callback_time",
        "refund_num", "refund_amount", "ts",
    )


def comment_info(
    changes: DataFrame, dictionary: DataFrame, database: str = DATABASE
) -> DataFrame:
    """New comments with the name of their rating.

    A dictionary with ``versions`` (see ``joins.dictionary_versions_of``) names a rating as it was called at the row's time.
    """
    comments = filters.inserts(
        changes,
        database,
        "comment_info",
        _same("id", "user_id", "sku_id", "appraise", "comment_txt", "create_time"),
    )
    find = lookup_at if "versions" in dictionary.columns else lookup
    return find(comments, dictionary, "appraise", "appraise_name").select(
        "id", "user_id", "sku_id", "appraise", "appraise_name", "comment_txt", "ts"
    )


def cart_add(changes: DataFrame, database: str = DATABASE) -> DataFrame:
    return filters.cart_additions(changes, database).drop("et")
