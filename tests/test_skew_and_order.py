"""Skew-safe operators against plain Spark and plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from freshet.operators import ordered, pattern, skew, visits
from freshet.operators.joins import interval_join
from freshet.session import shared_dir


def _heavy(spark, n=3000):
    rng = random.Random(1)
    data = []
    for i in range(n):
        key = rng.choice(["hot"] * 5 + ["null"] * 2 + [f"k{rng.randrange(50)}"] * 8)
        data.append((None if key == "null" else key, i, {"x": str(i)}))
    return spark.createDataFrame(data, "k string, id int, m map<string,string>")


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows_per_task", [10, 100, 10**6])
def test_skew_join_equals_join(spark, how, rows_per_task):
    heavy = _heavy(spark)
    light = spark.createDataFrame(
        [("hot", 1), ("hot", 2), (None, 3)] + [(f"k{i}", i) for i in range(0, 60, 2)], "k string, v int"
    )
    want = rows(heavy.join(light, "k", how), "k", "id", "v")
    got = skew.skew_join(heavy, light, ["k"], how, rows_per_task=rows_per_task)
    assert set(got.columns) == {"k", "id", "m", "v"}
    assert rows(got, "k", "id", "v") == want


def test_skew_join_splits_the_hot_key(spark):
    heavy = _heavy(spark)
    hot = skew.hot_keys(heavy, ["k"], 100)
    parts = dict(rows(hot, "k", "_parts"))
    count = heavy.where("k = 'hot'").count()
    assert parts["hot"] == -(-count // 100)
    assert all(key in (None, "hot") for key in parts)


def test_skew_join_shuffles_each_side_once(spark, tmp_path):
    for name in ("heavy", "light"):
        spark.range(1000).selectExpr("cast(id AS string) AS k", f"id AS {name}").write.parquet(f"{tmp_path}/{name}")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.skew_join(*(spark.read.parquet(f"{tmp_path}/{name}") for name in ("heavy", "light")), ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert plan.count("SortMergeJoin") == 1
    assert plan.count("Exchange hashpartitioning") <= 4  # either side, and the counts that each of them meets


def test_skew_join_refuses_other_kinds(spark):
    heavy = _heavy(spark, 5)
    with pytest.raises(ValueError):
        skew.skew_join(heavy, heavy, ["k"], "right")


@pytest.mark.parametrize("ahead", [False, True])
@pytest.mark.parametrize("size", [1, 7, 10**6])
def test_neighbour_value_equals_a_loop(spark, ahead, size):
    rng = random.Random(size)
    data = [
        (rng.choice(["a", "a", "a", "b", "c", None]), rng.randrange(200), i, rng.choice([None, "x", "y"]))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "k string, pos int, id int, v string").repartition(3)
    got = ordered.neighbour_value(
        df, ["k"], ["pos", "id"], F.col("v"), ordered.number_chunk("pos", size), "near", ahead
    )
    want, last = {}, {}
    for k, pos, id_, v in sorted(data, key=lambda r: (r[1], r[2]), reverse=ahead):
        want[id_] = last.get(k)
        last[k] = v
    assert {r.id: r.near for r in got.collect()} == want
    assert got.columns == ["k", "pos", "id", "v", "near"]


DAYS = [datetime(2024, 1, 1, 10), datetime(2024, 1, 2, 10), datetime(2024, 1, 10, 9)]


def test_day_changes_counts_days_that_go_back(spark):
    data = [("u", 1, DAYS[1]), ("u", 2, DAYS[0]), ("u", 3, DAYS[1]), ("u", 4, DAYS[1])]
    df = spark.createDataFrame(data, "u string, seq bigint, ts timestamp_ntz")
    got = visits.day_changes(df, ["u"], "ts", ["seq"], ordered.number_chunk("seq", 2))
    assert rows(got, "seq", "changed") == [(1, True), (2, True), (3, True), (4, False)]


def test_daily_first_new_and_returning(spark):
    data = [("u", t + timedelta(hours=h)) for t in DAYS for h in (0, 1)]
    df = spark.createDataFrame(data, "u string, ts timestamp_ntz")
    seen = visits.daily_first(df, ["u"], "ts")
    got = rows(seen, "ts", visits.is_new(), visits.is_returning(8), visits.is_returning(9))
    assert sorted(got) == [(DAYS[0], 1, 0, 0), (DAYS[1], 0, 0, 0), (DAYS[2], 0, 1, 0)]


def test_interval_join_equals_the_cross_product(spark):
    rng = random.Random(3)
    base = datetime(2024, 1, 1)

    def make(n, prefix):
        return [
            (rng.choice(["a", "a", "b", None]), f"{prefix}{i}", base + timedelta(seconds=rng.randrange(900)))
            for i in range(n)
        ]

    left, right = make(120, "l"), make(150, "r")
    # exact interval ends
    left += [("edge", "l_edge", base + timedelta(seconds=500))]
    right += [("edge", f"r{s}", base + timedelta(seconds=500 + s)) for s in (-61, -60, 0, 5, 6)]
    got = interval_join(
        spark.createDataFrame(left, "k string, l string, et timestamp"),
        spark.createDataFrame(right, "k string, r string, right_et timestamp"),
        ["k"], 60, 5,
    )
    want = sorted(
        (a[1], b[1])
        for a in left
        for b in right
        if a[0] is not None and a[0] == b[0]
        and a[2] - timedelta(seconds=60) <= b[2] <= a[2] + timedelta(seconds=5)
    )
    assert sorted(rows(got, "l", "r")) == want
    assert [b for a, b in want if a == "l_edge"] == ["r-60", "r0", "r5"]


def _events(*specs):
    base = datetime(2024, 1, 17, 8)
    return [("u1", base + timedelta(seconds=s), kind, i) for i, (s, kind) in enumerate(specs)]


def _alerts(spark, data, chunk=60):
    df = spark.createDataFrame(data, "u string, ts timestamp, kind string, id int")
    got = pattern.followed_by(
        df, "u", "ts", "kind", "id", "couponRedemption", "quickPurchase", 60, chunk
    )
    return [(r.first_ts.second + 60 * r.first_ts.minute, r.second_ts.second + 60 * r.second_ts.minute)
            for r in got.collect()]


@pytest.mark.parametrize("chunk", [1, 60, 86400])
def test_pattern_needs_direct_succession_within_the_bound(spark, chunk):
    c, p, b = "couponRedemption", "quickPurchase", "quickBrowse"
    assert _alerts(spark, _events((0, "login"), (10, c), (50, p)), chunk) == [(10, 50)]
    assert _alerts(spark, _events((10, c), (20, b), (50, p)), chunk) == []
    assert _alerts(spark, _events((10, c), (70, p)), chunk) == []  # exactly a minute
    assert _alerts(spark, _events((10, c), (69, p)), chunk) == [(10, 69)]
    assert _alerts(spark, _events((10, c), (11, c), (50, p), (51, p)), chunk) == [(11, 50)]


def test_pattern_equals_a_loop(spark):
    rng = random.Random(9)
    base = datetime(2024, 1, 1)
    data = [
        (rng.choice("aab"), base + timedelta(seconds=rng.randrange(4000)),
         rng.choice(["couponRedemption", "quickPurchase", "quickBrowse"]), i)
        for i in range(300)
    ]
    df = spark.createDataFrame(data, "u string, ts timestamp, kind string, id int")
    got = pattern.followed_by(df, "u", "ts", "kind", "id", "couponRedemption", "quickPurchase", 60, 30)
    want, last = [], {}
    for u, ts, kind, _ in sorted(data, key=lambda r: (r[1], r[3])):
        if u in last:
            then, before = last[u]
            if before == "couponRedemption" and kind == "quickPurchase" and ts - then < timedelta(seconds=60):
                want.append((u, then, ts))
        last[u] = (ts, kind)
    assert rows(got, "user_id", "first_ts", "second_ts") == sorted(want, key=repr)


def test_every_hot_key_is_split_however_many_there_are(spark):
    heavy = spark.range(21_000).selectExpr("id % 10500 AS k", "id AS x")
    light = spark.range(10_500).selectExpr("id AS k", "id * 2 AS y")
    assert skew.hot_keys(heavy, ["k"], 1).count() == 10_500
    got = skew.skew_join(heavy, light, ["k"], rows_per_task=1)
    assert got.exceptAll(heavy.join(light, ["k"])).isEmpty()
    assert got.count() == 21_000


def test_a_cluster_without_a_shared_folder_raises():
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:1"

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
