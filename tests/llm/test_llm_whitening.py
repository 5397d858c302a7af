"""Whitening against numpy on all rows, and on odd vectors."""

import math

import numpy as np
import pytest

from ordermill.llm import queries, whitening

SAMPLE = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, label int, x string, copies int, key_1 int"


def plain(vectors, components=8, weights="copies"):
    """(vec_id, component) to (n, deviation, whitened up to the sign, explained)."""
    x = {}
    kept = [(i, tuple(math.floor(1024 * float(np.float32(c))) + 100_000 for c in v))
            for i, v in vectors if v is not None and all(
                c is not None and math.isfinite(c) for c in v)]
    fitted = [v for _, v in kept] if weights == "copies" else sorted({v for _, v in kept})
    n, sums = len(fitted), [sum(c) for c in zip(*fitted)]
    centred = np.array([[c - s / n for c, s in zip(v, sums)] for v in fitted])
    covariance = centred.T @ centred / n
    values, turn = np.linalg.eigh(covariance)
    values, turn = values[::-1], turn[:, ::-1]
    out = []
    for i, v in kept:
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        z = np.array([c - s / n for c, s in zip(v, sums)]) @ turn
        for k in range(min(components, len(sums))):
            out.append((i, k + 1, n, deviation, abs(z[k]) / math.sqrt(values[k]) if values[k] > 1e-6 else None,
                        values[k] / values.sum()))
    return out


def check(got, want):
    got = sorted(((r["vec_id"], r["component"], r["n"], int(r["deviation"]),
                   None if r["whitened"] is None else abs(r["whitened"]), r["explained"]) for r in got), key=repr)
    assert len(got) == len(want)
    for a, b in zip(got, sorted(want, key=repr)):
        assert a[:4] == b[:4]
        assert (a[4] is None) == (b[4] is None)
        assert a[4] is None or math.isclose(a[4], b[4], rel_tol=1e-6, abs_tol=1e-8)
        assert math.isclose(a[5], b[5], rel_tol=1e-6, abs_tol=1e-12)


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "x", 2, 3) for i, v in vectors], SCHEMA)


def test_query(spark):
    rows = queries.op12_whitening(spark, SAMPLE).collect()
    vectors = [(r["vec_id"], r["embedding"]) for r in
               spark.read.parquet(f"{SAMPLE}/embeddings.parquet").collect()]
    check(rows, plain(vectors))
    assert all(r["identity_error"] <= 1e-4 for r in rows)
    assert len({r["identity_error"] for r in rows}) == 1
    # one sign for all rows of a component: the mean of the projections is 0, the variance 1
    for k in range(1, 9):
        z = np.array([r["whitened"] for r in rows if r["component"] == k])
        assert abs(z.mean()) < 1e-8 and abs(z.var() - 1) < 1e-8


@pytest.mark.parametrize("weights", ["copies", "one"])
def test_a_hot_vector(spark, weights):
    random = np.random.default_rng(1)
    vectors = [(int(i), random.normal(size=5).astype(np.float32).tolist()) for i in range(300)]
    vectors += [(int(i), vectors[0][1]) for i in range(300, 700)]
    # a difference below 1/1024 is none
    vectors += [(1000, [math.floor(1024 * c) / 1024 for c in vectors[1][1]])]
    assert (whitening.distinct_vectors(table(spark, vectors)).count()) == 300
    rows = whitening.whiten(table(spark, vectors), weights=weights).collect()
    check(rows, plain(vectors, weights=weights))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (None, [0.5, -2.0, 3.0]), (2, [-0.0, 0.0, 3.0])]
    odd = [(3, None), (4, [1.0, None, 3.0]), (5, [nan, 1.0, 2.0]), (6, [1.0, inf, 2.0]),
           (7, [1.0, 2.0, -inf])]
    rows = whitening.whiten(table(spark, vectors + odd)).collect()
    check(rows, plain(vectors))
    assert {r["component"] for r in rows} == {1, 2, 3}
    assert all(r["whitened"] is None for r in rows if r["component"] == 3)  # no variance left
    other = [(8, []), (9, [1.0]), (10, [1e38, 1.0, 1.0])]
    assert len(whitening.whiten(table(spark, vectors + other)).collect()) == len(rows)
    alone = whitening.whiten(table(spark, [(1, [1.0, 2.0])] * 3)).collect()
    assert [(r["whitened"], r["explained"], r["deviation"]) for r in alone] == [(None, 0.0, 0)] * 6
    for nothing in ([], odd, [(1, [])]):
        assert whitening.whiten(table(spark, nothing)).count() == 0


def test_long_vectors_and_large_numbers(spark):
    random = np.random.default_rng(2)
    vectors = [(int(i), (random.normal(size=3) * 1e11).astype(np.float32).tolist()) for i in range(50)]
    rows = whitening.whiten(table(spark, vectors)).collect()
    check(rows, plain(vectors))
    assert max(int(r["deviation"]) for r in rows) > 2 ** 63
    long = [(int(i), random.normal(size=700).astype(np.float32).tolist()) for i in range(40)]
    assert whitening.whiten(table(spark, long)).count() == 320
