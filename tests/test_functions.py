from decimal import Decimal

from pyspark.sql import functions as F

from conftest import rows
from freshet.functions import amounts, maps, text, times


def test_times_round_trip(spark):
    df = spark.createDataFrame([(1704067199999,), (0,)], "ms bigint")
    got = rows(
        df,
        times.millis_to_date("ms"),
        times.millis_to_datetime("ms"),
        times.millis_to_compact_date("ms"),
    )
    assert got == [
        ("1970-01-01", "1970-01-01 00:00:00", "19700101"),
        ("2023-12-31", "2023-12-31 23:59:59", "20231231"),
    ]


def test_text_is_read_at_the_writers_offset_in_any_session_zone(spark):
    df = spark.createDataFrame([("2024-01-01 08:00:00",), ("nonsense",), (None,)], "t string")
    for zone in ("UTC", "Asia/Shanghai", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = rows(df, times.datetime_to_millis("t"))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert got == [(1704067200000,), (None,), (None,)]
    day = spark.createDataFrame([("2024-01-01",)], "t string")
    assert rows(day, times.date_to_millis("t")) == [(1704067200000 - 8 * 3600 * 1000,)]


def test_date_of_text(spark):
    df = spark.createDataFrame(
        [("2024-02-03 04:05:06",), ("2024-02-03",), ("x",), (None,)], "t string"
    )
    assert rows(df, times.date_of_text("t")) == [
        ("2024-02-03",), ("2024-02-03",), (None,), (None,),
    ]


def test_line_amount_is_exact_text(spark):
    df = spark.createDataFrame([("3", "7.00"), ("2", "0.105"), ("x", "1"), (None, "1")], "n string, p string")
    assert rows(df, amounts.line_amount(F.col("n"), F.col("p"))) == [
        ("0.2200",), ("21.0000",), (None,), (None,),
    ]
    assert rows(df.where("n = '3'"), amounts.money(F.col("p"))) == [(Decimal("7.00"),)]


def test_maps(spark):
    df = spark.sql("SELECT map('a', '1', 'b', null) AS m, map('a', '9', 'c', '3') AS n")
    got = df.select(
        maps.overlay(F.col("m"), F.col("n")).alias("over"),
        maps.overlay(F.col("m"), F.lit(None).cast("map<string,string>")).alias("same"),
        maps.keep_listed(F.col("n"), maps.comma_list(F.lit("a, c"))).alias("listed"),
        maps.without_nulls(F.col("m")).alias("full"),
    ).first()
    assert got.over == {"a": "9", "b": None, "c": "3"}
    assert got.same == {"a": "1", "b": None}
    assert got.listed == {"a": "9"}  # ' c' is not 'c'
    assert got.full == {"a": "1"}


PHRASES = [(1, "Red red phone 手机壳"), (2, None), (3, ""), (4, "ABC-123 abc")]


def test_tokens(spark):
    df = spark.createDataFrame(PHRASES, "id int, t string")
    got = dict(rows(df, "id", text.tokens("t")))
    assert got[1] == ["red", "phone", "手", "机", "壳"]
    assert got[2] is None and got[3] == []
    assert got[4] == ["abc", "123"]


def test_dictionary_segmenter_takes_the_longest_word(spark):
    df = spark.createDataFrame([("华为手机壳X1",), (None,)], "t string")
    cut = text.dictionary_segmenter(["手机", "手机壳", "华为"])
    got = [r[0] for r in df.select(text.tokens("t", cut)).collect()]
    assert got == [["华为", "手机壳", "x1"], None]


def test_table_function(spark):
    text.register_kw_split(spark)
    spark.createDataFrame(PHRASES, "id int, t string").createOrReplaceTempView("phrases")
    got = rows(spark.sql("SELECT id, keyword FROM phrases, LATERAL kw_split(t)"))
    assert [word for _, word in got if _ == 4] == ["123", "abc"]
    assert {id_ for id_, _ in got} == {1, 4}
