"""Hard negatives against brute force, on one tree and on many."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from freshet.llm import hard_negatives as hn

KIND = "vec_id long, label int, embedding array<double>, picked boolean, x string, row string"


def brute(rows, positives=5, negatives=10):
    live = [(i, lab, [math.floor(256 * c) for c in v], p) for i, lab, v, p in rows if i is not None and lab is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    score = lambda a, b: sum(x * y for x, y in zip(a[2], b[2], strict=False))
    out = []
    for k, a in enumerate(live):
        if not a[3]:
            continue
        near = sorted(((-score(a, b), b[0]) for j, b in enumerate(live) if j != k and b[1] == a[1]))[:positives]
        for ps, pid in near:
            fits = sorted((-score(a, b), b[0]) for b in live if b[1] != a[1] and 30 * -ps <= 100 * score(a, b) <= 90 * -ps)
            out += [(a[0], pid, r, nid, -ps, -s) for r, (s, nid) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def table_of(spark, rows):
    return spark.createDataFrame([(i, lab, v, p, "x", "r") for i, lab, v, p in rows], KIND)


def drawn(n, width, seed, labels=4):
    draw = np.random.default_rng(seed)
    return [(k, int(draw.integers(labels)), np.round(draw.normal(size=width), 1).tolist(), k % 9 == 0) for k in range(n)]


def test_mining_equals_brute_force_on_one_tree_and_many(spark, monkeypatch):
    rows = drawn(500, 6, 1)
    rows += [(600 + k, 1, rows[0][2], True) for k in range(40)] + [(700, 1, rows[9][2], True)] * 3  # copies, repeated ids
    rows += [(None, 1, [1.0] * 6, True), (800, None, [1.0] * 6, True), (801, 1, None, True), (802, 1, [float("nan")] * 6, True), (803, 2, [None] * 6, None), (804, 2, [1.0], None)]
    want = brute(rows)
    assert len(want) > 1000
    assert sorted(map(tuple, hn.mine(table_of(spark, rows)).collect())) == want
    for name, value in (("LEAF", 8), ("TREE_BYTES", 600), ("FANOUT", 3), ("TOGETHER", 5)):
        monkeypatch.setattr(hn, name, value)
    assert sorted(map(tuple, hn.mine(table_of(spark, rows)).collect())) == want


def test_large_numbers_stay_exact(spark):
    rows = [(i, lab, [c * 2000 for c in v], p) for i, lab, v, p in drawn(60, 3, 2, 2)]
    rows += [(900 + k, k % 2, [9e4 - k / 64, 8e4 + k / 32, 1.0], True) for k in range(8)]
    assert sorted(map(tuple, hn.mine(table_of(spark, rows)).collect())) == brute(rows)


def test_empty_tables_anchors_and_windows(spark):
    rows = drawn(20, 3, 3)
    assert hn.mine(table_of(spark, [])).count() == 0
    assert hn.mine(table_of(spark, [(i, lab, v, False) for i, lab, v, _ in rows])).count() == 0
    assert hn.mine(table_of(spark, [(1, 1, [], True), (2, 1, [], None), (3, 2, [], None)])).collect() == [(1, 2, 1, 3, 0, 0)]
    assert hn.mine(table_of(spark, [(1, 1, [1.0], True), (2, 1, [-1.0], None), (3, 2, [-0.5], None)])).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 4), st.booleans())
def test_bounds_hold_for_every_point_of_a_box(seed, width, whole):
    draw = np.random.default_rng(seed)
    points = draw.integers(-9, 9, (12, width))
    q = draw.integers(-9, 9, (5, width)).astype(np.int64 if whole else np.float64)
    least, most = hn.bounds(q, points.min(axis=0)[None], points.max(axis=0)[None])
    scores = q @ points.T
    assert (least <= scores).all() and (scores <= most).all()


def test_tiles_hold_every_row_once():
    x = np.random.default_rng(0).integers(0, 5, (1000, 3))
    runs = hn.tile(x, np.arange(1000), [0, 1, 2], 16)
    assert sorted(np.concatenate(runs).tolist()) == list(range(1000))
    assert max(map(len, runs)) <= 16 and len(runs) < 100
