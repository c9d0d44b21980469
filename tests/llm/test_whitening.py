"""Whitening against covariances in exact integers, and the solver against known values."""

import math

import numpy as np
import pytest

from tidelake.llm import whitening
from tidelake.llm.bidiagonal import right_vectors, squared_values
from tidelake.llm.queries import QUERIES
from tidelake.llm.whitening import whiten

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id bigint, embedding array<float>, label int"


def x_of(vector):
    return [math.floor(1024 * float(c)) + 100_000 for c in vector]


def check(rows, found, components=8):
    """rows: (vec_id, vector) that take part; vectors of the covariance in exact integers."""
    x = np.array([x_of(v) for _, v in rows], object)
    n, d = x.shape
    s = x.sum(axis=0)
    shifted = x * n - s
    cov = (shifted.T @ shifted / n).astype(float) / n**2
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    m = min(components, d)
    got = {}
    for r in found.collect():
        got.setdefault(r.vec_id, []).append(r)
    assert sum(map(len, got.values())) == n * m
    deviation = {}
    for (vec_id, _), row in zip(rows, shifted):
        deviation.setdefault(vec_id, []).append(int((row**2).sum()))
    whitened = np.zeros((n, m))
    place = {}
    for i, (vec_id, _) in enumerate(rows):
        place.setdefault(vec_id, []).append(i)
    for vec_id, own in got.items():
        own.sort(key=lambda r: r.component)
        assert sorted({r.component for r in own}) == list(range(1, m + 1))
        assert sorted(r.deviation for r in own) == sorted(deviation[vec_id] * m)
        for r in own:
            assert r.n == n
            assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9,
                                                abs=1e-14)
        if len(place[vec_id]) == 1:
            whitened[place[vec_id][0]] = [r.whitened for r in own]
    want = (shifted.astype(float) / n) @ vectors[:, :m] / np.sqrt(values[:m])
    once = [p[0] for p in place.values() if len(p) == 1]
    sign = np.sign((whitened[once] * want[once]).sum(axis=0))
    assert np.abs(whitened[once] * sign - want[once]).max() < 1e-6
    assert {r.identity_error for own in got.values() for r in own}.pop() < 1e-9


def test_query(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet")
    bad = lambda v: v is None or any(c is None or not math.isfinite(c) for c in v)
    rows = [(r.vec_id, r.embedding) for r in given.collect() if not bad(r.embedding)]
    check(rows, QUERIES["op11_whitening"](spark, SF))


def random_rows(n, d, seed=0):
    pick = np.random.default_rng(seed)
    x = pick.standard_normal((n, d)) * np.logspace(0, -2, d)
    return [(i, x[i].astype(np.float32).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)


def test_odd_rows(spark):
    """Rows that take no part, null and repeated ids, repeated rows, clashing columns."""
    good = random_rows(60, 5)
    good += [(None, good[3][1]), (7, good[8][1]), (9, good[9][1])]
    out = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan] * 5), (103, []),
           (104, [math.inf, 0.0, 0.0, 0.0, 0.0]), (105, [1.0, 2.0]), (106, [3e38] * 5)]
    df = frame(spark, good + out).repartition(7)
    for name in ("row", "v", "n", "component", "node"):
        df = df.withColumn(name, df.label)
    check(good, whiten(df))


def test_fewer_dimensions_than_components(spark):
    check(random_rows(30, 3), whiten(frame(spark, random_rows(30, 3))))


def test_few_components(spark):
    rows = random_rows(40, 12)
    check(rows, whiten(frame(spark, rows).repartition(40), components=2), components=2)


@pytest.mark.parametrize("rows", [
    [(1, [0.5, 0.25])], [(i, [0.5, 0.25]) for i in range(9)], [(1, [0.0, 1.0]), (2, [1.0, 1.0])],
])
def test_no_variance(spark, rows):
    """Directions without variance are null; they do not count for the identity."""
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 2 * len(rows)
    varied = len({tuple(v) for _, v in rows}) > 1
    for r in found:
        if varied and r.component == 1:
            assert abs(r.whitened) == pytest.approx(1) and r.explained == 1
            assert r.identity_error < 1e-12
        else:
            assert r.whitened is None and r.explained == 0
            assert r.deviation == (2 * 512**2 * 2 if varied else 0)


def test_empty_tables(spark):
    nothing = frame(spark, random_rows(2, 2)).limit(0)
    for df in (nothing, spark.createDataFrame([(1, None, 0)], SCHEMA)):
        found = whiten(df)
        assert found.count() == 0 and found.columns[0] == "vec_id"


def test_more_dimensions_than_rows(spark):
    rows = random_rows(5, 30)
    found = whiten(frame(spark, rows)).collect()
    assert len(found) == 5 * 8
    assert {r.component for r in found if r.whitened is None} == {5, 6, 7, 8}
    assert found[0].identity_error < 1e-9


def test_exact_beyond_longs():
    far = np.array([[1 << 40, 5], [3, 1 << 41]])
    shifted = whitening._shifted(far, 1 << 30, [1 << 20, 7])
    assert shifted[0, 0] == (1 << 70) - (1 << 20)
    assert whitening.squares(shifted) == [None, None]
    near = whitening._shifted(np.array([[3, 4]]), 2, [5, 7])
    assert whitening.squares(near) == [2]
    wide = np.array([[(1 << 31) - 1, 1 << 31], [1 << 32, 0]])
    assert whitening.squares(wide) == [((1 << 31) - 1) ** 2 + (1 << 62), None]


def orthogonal(d, seed):
    return np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))[0]


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 40), np.logspace(0, -12, 40), [5.0] * 5 + [3.0] * 5 + [1.0] * 30,
    [5 - 1e-9 * i for i in range(6)] + [1.0] * 30, [3.0, 2, 1] + [0.0] * 20, [4.0] * 12, [0.0] * 6,
    [2.0], [2.0, 1e-8],
])
def test_solver(values):
    values = np.array(values)
    d = len(values)
    matrix = orthogonal(d, 1) @ np.diag(values) @ orthogonal(d, 2)
    found, vectors = right_vectors(matrix, 8)
    top = max(values.max(), 1e-300)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-13 * top
    m = min(8, d)
    assert vectors.shape == (d, m)
    assert np.abs(vectors.T @ vectors - np.eye(m)).max() < 1e-11
    residual = matrix.T @ (matrix @ vectors) - vectors * found[:m] ** 2
    assert np.abs(residual).max() <= 1e-12 * top**2


def test_small_values_are_accurate():
    """The product of all values is the determinant, to full relative accuracy."""
    a = np.logspace(0, -30, 25)
    for q, e in ((a, a[:-1]), (a[::-1], a[::-1][:-1] * 0.3), (a, np.zeros(24))):
        found = squared_values((q**2).tolist(), (e**2).tolist())
        assert np.log(found).sum() == pytest.approx(2 * np.log(q).sum(), rel=1e-13)
