"""Whitening against exact sums and a dense eigendecomposition; the cases with defined results."""

import math
from fractions import Fraction

import numpy as np
import pytest

from tickloom.llm import queries, whitening

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<double>, label string, n long, w string, x int"


def whole(c):
    return math.floor(1024 * c) + 100000


def brute_force(vectors, keep=8):
    x = [[whole(c) for c in v] for v in vectors]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    y = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums)] for v in x])
    cov = y.T @ y / n
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(v, sums)) for v in x]
    return n, deviation, y @ axes[:, :keep] / np.sqrt(values[:keep]), values[:keep] / values.sum()


def check(rows, ids, vectors, tolerance=1e-8):
    n, deviation, z, explained = brute_force(vectors)
    keep = z.shape[1]
    assert len(rows) == len(ids) * keep
    at = {i: k for k, i in enumerate(ids)}
    got = np.full(z.shape, np.nan)
    for r in rows:
        k = at[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[k]) and abs(r.explained / explained[r.component - 1] - 1) < 1e-9
        assert r.identity_error < 1e-9
        got[k, r.component - 1] = r.whitened
    signs = np.sign((got * z).sum(axis=0))
    assert np.abs(got * signs - z).max() < tolerance


def test_query_matches_brute_force(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    check(queries.op11(spark, SF).collect(), [r.vec_id for r in table], [r.embedding for r in table])


def test_hard_rows(spark):
    rng = np.random.default_rng(5)
    good = {i: rng.normal(size=5).tolist() for i in range(40)}
    good |= {i: good[3] for i in range(40, 70)}  # copies
    good[70] = [0.0] * 5
    bad = {80: None, 81: [], 82: [1.0, None, 0.0, 0.0, 0.0], 83: [float("nan"), 0.0, 0.0, 0.0, 0.0], 84: [0.0, 0.0, 0.0, 0.0, float("inf")], 85: [1.0, 2.0]}
    rows = [(i, v, "a", 1, "b", None) for i, v in {**good, **bad}.items()]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = whitening.per_component(whitening.whiten(df)).withColumnRenamed("id", "vec_id").collect()
    check(got, list(good), list(good.values()))
    same = {r.component: r.whitened for r in got if r.vec_id == 3}
    assert all(r.whitened == same[r.component] for r in got if r.vec_id in range(40, 70))
    twice = whitening.whiten(df.unionByName(df.where("vec_id = 5")).unionByName(df.where("vec_id = 6").selectExpr(
        "cast(null as long) vec_id", *df.columns[1:])))
    assert twice.count() == 73 and twice.where("id = 5").count() == 2 and twice.where("id is null").count() == 1
    one = whitening.whiten(df, weights="one").first()
    assert one.n == 41 and one.identity_error < 1e-9
    assert whitening.whiten(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        whitening.whiten(df, weights="two")


def test_no_variance(spark):
    rows = [(1, [1.0, 2.0], "", 0, "", 0), (2, [1.0, 2.0], "", 0, "", 0)]
    for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect():
        assert (r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (2, 0, [None, None], [None, None], None)
    rows.append((3, [1.0, 3.0], "", 0, "", 0))
    for r in whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect():
        assert r.whitened[0] is not None and r.whitened[1] is None and r.explained == [1.0, 0.0]


@pytest.mark.parametrize("huge", [1e9, 1e12, 1e300])
def test_one_huge_component(spark, huge):
    """Small variances stay whitened, and sums beyond a long are exact or missing."""
    rng = np.random.default_rng(6)
    vectors = {i: rng.normal(size=4).tolist() for i in range(200)}
    vectors[7] = [huge, *vectors[7][1:]]
    df = spark.createDataFrame([(i, v, "", 0, "", 0) for i, v in vectors.items()], SCHEMA)
    out = {r.id: r for r in whitening.whiten(df).collect()}
    limited = [[max(min(c, whitening.LARGEST / 1024), -whitening.LARGEST / 1024) for c in v] for v in vectors.values()]
    n, deviation, _, _ = brute_force(limited)
    assert all(out[i].deviation == (d if d < 1 << 63 else None) for i, d in zip(vectors, deviation))
    assert out[1].identity_error < 1e-4
    assert abs(sum(out[1].explained) - 1) < 1e-9 and out[1].explained[3] > 0


def test_jacobi_keeps_small_eigenvalues():
    rng = np.random.default_rng(7)
    scale = np.array([1e12, 1e3, 1.0, 1e-3])
    near = np.eye(4) + 1e-3 * rng.normal(size=(4, 4))
    near = (near + near.T) / 2
    a = near * np.outer(scale, scale)
    values, vectors = whitening.jacobi(a)
    unit = vectors.T @ a @ vectors / np.sqrt(np.outer(values, values))
    assert np.abs(np.diag(unit) - 1)[0] < 1e-12 and abs(np.prod(values) / np.prod(scale ** 2) / np.linalg.det(near) - 1) < 1e-9
