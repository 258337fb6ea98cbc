"""Schemas of the streams and tables the jobs read and write."""

from __future__ import annotations

from pyspark.sql import types as T

STRING_MAP = T.MapType(T.StringType(), T.StringType())


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


# One row of the database change log; ts is in seconds.
CHANGE = T.StructType(
    _strings("database", "table", "type")
    + [
        T.StructField("data", STRING_MAP),
        T.StructField("old", STRING_MAP),
        T.StructField("ts", T.LongType()),
    ]
)

# One line of the behaviour log; ts is in milliseconds.
BEHAVIOR = T.StructType(
    [
        T.StructField("common", STRING_MAP),
        T.StructField("start", STRING_MAP),
        T.StructField("page", STRING_MAP),
        T.StructField("displays", T.ArrayType(STRING_MAP)),
        T.StructField("actions", T.ArrayType(STRING_MAP)),
        T.StructField("err", STRING_MAP),
        T.StructField("sid", T.StringType()),
        T.StructField("ts", T.LongType()),
    ]
)

DICTIONARY = T.StructType(
    [
        T.StructField("dic_code", T.StringType()),
        T.StructField("info", T.StructType(_strings("dic_name"))),
    ]
)

# A row of the dictionary table, as its changes are captured.
DICTIONARY_ENTRY = T.StructType(_strings("dic_code", "dic_name"))

DIM_RULE = T.StructType(
    _strings("source_table", "sink_table", "sink_columns", "sink_family", "sink_row_key")
)

FACT_RULE = T.StructType(
    _strings("source_table", "source_type", "sink_table", "sink_columns")
)

ORDER_DETAIL_FACT = T.StructType(
    _strings(
        "id",
        "order_id",
        "user_id",
        "sku_id",
        "sku_name",
        "province_id",
        "activity_id",
        "activity_rule_id",
        "coupon_id",
        "date_id",
        "create_time",
        "sku_num",
        "split_original_amount",
        "split_activity_amount",
        "split_coupon_amount",
        "split_total_amount",
    )
    + [T.StructField("ts", T.LongType())]
)

# A metric event with its nested context, and the part the metrics use.
METRIC_EVENT = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("user_id_str", T.StringType()),
        T.StructField("user_id_int", T.IntegerType()),
        T.StructField("event_behavior_name", T.StringType()),
        T.StructField("event_behavior_id", T.IntegerType()),
        T.StructField("event_target_id", T.IntegerType()),
        T.StructField("event_target_name", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_level", T.StringType()),
        T.StructField("event_name", T.StringType()),
        T.StructField("event_source", T.StringType()),
        T.StructField("event_time", T.StringType()),
        T.StructField(
            "event_context",
            T.StructType(
                [
                    T.StructField(
                        "device",
                        T.StructType(
                            _strings("ip", "imsi", "imei", "province", "city", "area")
                        ),
                    ),
                    T.StructField("profile", T.StructType(_strings("grade"))),
                    T.StructField(
                        "product",
                        T.StructType([T.StructField("price", T.DecimalType(38, 18))]),
                    ),
                ]
            ),
        ),
    ]
)

METRIC_COLUMNS = [
    "user_id_int",
    "event_time",
    "event_target_name",
    "event_name",
    "event_type",
    "event_context",
]

# A shop event; each event type names its time field differently.
SHOP_EVENT = T.StructType(
    _strings(
        "userId",
        "eventType",
        "loginTime",
        "redemptionTime",
        "browseTime",
        "purchaseTime",
        "ipAddress",
    )
)
