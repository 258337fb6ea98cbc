"""Chebyshev-filtered whitening against a dense eigen-decomposition."""

import math

import numpy as np
import pytest

from freshet.llm import whitening

KIND = "vec_id long, embedding array<double>, n string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v], "old") for i, v in rows], KIND)


def dense(x):
    n = len(x)
    sums = [sum(int(row[j]) for row in x) for j in range(x.shape[1])]
    mean = np.array([s / n for s in sums])
    centred = x - mean
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    away = [sum((n * int(a) - s) ** 2 for a, s in zip(row, sums, strict=True)) for row in x]
    return centred, values[::-1], vectors[:, ::-1], away


def compare(got, ids, vectors, k):
    x = np.floor(1024 * np.array(vectors)).astype(np.int64) + 100_000
    centred, values, axes, away = dense(x)
    assert len(got) == len(ids) * k
    place = {i: a for a, i in enumerate(ids)}
    table = np.zeros((len(ids), k))
    for r in got:
        table[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(ids) and r.deviation == away[place[r.vec_id]]
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-8
    want = centred @ axes[:, :k] / np.sqrt(values[:k])
    sign = np.sign((want * table).sum(axis=0))
    assert np.abs(want * sign - table).max() < 1e-7


def test_whitening_equals_the_dense_answer(spark):
    draw = np.random.default_rng(4)
    vectors = draw.normal(size=(400, 40)) * np.linspace(1, 0.8, 40)
    rows = list(enumerate(vectors))
    odd = [(900, None), (901, [float("nan")] * 40), (902, [None] * 40), (903, [float("inf")] + [0] * 39)]
    got = whitening.whiten(table_of(spark, rows + odd)).collect()
    compare(got, list(range(400)), vectors, 8)


def test_the_filter_runs_and_is_certified(spark):
    draw = np.random.default_rng(5)
    basis = np.linalg.qr(draw.normal(size=(90, 90)))[0]
    vectors = draw.normal(size=(300, 90)) @ (basis * np.linspace(1, 0.9, 90)).T
    made = whitening.blocks(table_of(spark, enumerate(vectors)), 64)
    made = whitening.stored(made, "blocks")
    model = whitening.fit(made, guard=4)
    x = np.floor(1024 * vectors).astype(np.int64) + 100_000
    _, values, axes, _ = dense(x)
    assert model.passes > whitening.DEGREE
    assert np.abs(model.values / values[:8] - 1).max() < 1e-11
    assert np.abs(np.abs((model.vectors * axes[:, :8]).sum(axis=0)) - 1).max() < 1e-12


def test_few_flat_and_odd_vectors(spark):
    one = whitening.whiten(table_of(spark, [(7, [1, 2, 3])])).collect()
    assert [(r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(k, 0, None, None, None) for k in (1, 2, 3)]
    flat = whitening.whiten(table_of(spark, [(1, [0, 1]), (1, [0, 1]), (None, [0, 3]), (2, [0])])).collect()
    assert len(flat) == 8 and all((r.whitened is None) == (r.component == 2) for r in flat)
    assert max(abs(r.whitened) for r in flat if r.component == 1) == pytest.approx(1.75 / math.sqrt(1.1875))
    large = whitening.whiten(table_of(spark, [(k, [10.0**30 * (-1) ** k, k]) for k in range(6)])).collect()
    assert len(large) == 12 and all(r.deviation is None for r in large)
    assert whitening.whiten(table_of(spark, [])).count() == 0
    assert whitening.whiten(table_of(spark, [(1, None), (2, [])])).count() == 0
