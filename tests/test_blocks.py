"""Stored block matrices and products whose form follows the density."""

import numpy as np
import pytest

from tests.test_scale import plan_of, table
from tickloom.operators import blocks as bl
from tickloom.operators import matrix as mx
from tickloom.operators import skew


def cells_of(spark, a):
    i, j = np.nonzero(a)
    return spark.createDataFrame([(int(x), int(y), float(a[x, y])) for x, y in zip(i, j)], "i long, j long, v double").repartition(5)


def mixed(m, n, seed):
    """Some full rows, some scattered cells."""
    rng = np.random.default_rng(seed)
    a = rng.normal(size=(m, n))
    return np.where((np.arange(m)[:, None] % 40 < 20) | (rng.random((m, n)) < 0.03), a, 0.0)


def dense(cells, shape):
    out = np.zeros(shape)
    for c in cells.collect():
        out[c["i"], c["j"]] += c["v"]
    return out


@pytest.mark.parametrize("small", [True, False])
def test_products_of_stored_matrices(spark, monkeypatch, small):
    if not small:
        monkeypatch.setattr(bl, "BROADCAST_BYTES", -1)
    a, b = mixed(120, 70, 1), mixed(70, 90, 2)
    sa, sb = bl.store(cells_of(spark, a), 20, 4), bl.store(cells_of(spark, b), 20, 4)
    assert table(sa.cells()) == table(cells_of(spark, a))
    product = bl.matmul(sa, sb)
    assert np.abs(dense(product, (120, 90)) - a @ b).max() < 1e-9
    met = (a != 0).astype(int) @ (b != 0).astype(int) > 0
    assert {(c["i"], c["j"]) for c in product.collect()} == set(zip(*map(list, np.nonzero(met))))
    x = np.random.default_rng(3).normal(size=70)
    vector = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x) if i % 7], "i long, v double")
    x[::7] = 0
    got = np.zeros(120)
    for r in bl.gemv(sa, vector).collect():
        got[r["i"]] = r["v"]
    assert np.abs(got - a @ x).max() < 1e-9
    sa.drop(), sb.drop()


def test_second_product_does_not_shuffle_the_matrix(spark, monkeypatch):
    """Neither exchange nor sort stands above the scan of the stored blocks, however large the other operand."""
    monkeypatch.setattr(bl, "BROADCAST_BYTES", -1)
    stored = bl.store(cells_of(spark, mixed(100, 60, 4)), 20, 4)
    for size in (60, 61):
        x = spark.range(size).selectExpr("id as i", "cast(id as double) as v")
        bl.gemv(stored, x)
        parts = x.selectExpr("i div 20 as bk", "i", "v").groupBy("bk").agg({"v": "sum"})
        plan = plan_of(bl._meeting(stored, parts, 1))
        scan = next(line for line in plan.splitlines() if "Bucketed: true" in line)
        above = plan.split(scan)[0].splitlines()
        depth = scan.index("FileScan" if "FileScan" in scan else "Scan")
        path, at = [], depth
        for line in reversed(above):
            mark = line.find("+- ") if "+- " in line else line.find(":- ")
            if 0 <= mark < at - 3 or (0 <= mark < at):
                path.append(line)
                at = mark
        assert path and not any("Exchange" in line for line in path), plan
        assert any("SortMergeJoin" in line for line in path)
    stored.drop()


def test_block_product_forms_agree(monkeypatch):
    rng = np.random.default_rng(5)
    for share in (0.02, 0.3, 1.0):
        a, b = ((rng.random((16, 16)) < share) * rng.integers(-3, 4, (16, 16)).astype(float) for _ in range(2))
        if not (a.any() and b.any()):
            continue
        held = [(*np.nonzero(m != 99 if share == 1 else m), (m[m != 99] if share == 1 else m[m != 0])) for m in (a, b)]
        results = []
        for limit in (0.0, 2.0):
            monkeypatch.setattr(bl, "DENSE_SHARE", limit)
            i, j, v = bl.block_product(*held, 16)
            results.append(sorted(zip(i.tolist(), j.tolist(), v.round(9).tolist())))
        assert results[0] == results[1]


@pytest.mark.parametrize("kind", ["sparse", "dense", "mixed"])
def test_product_by_density(spark, monkeypatch, kind):
    monkeypatch.setattr(mx, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(mx, "DENSE_CELLS", 50)
    rng = np.random.default_rng(6)
    a, b = {"sparse": lambda: [(rng.random(s) < 0.02) * rng.normal(size=s) for s in ((100, 60), (60, 80))],
            "dense": lambda: [rng.normal(size=s) for s in ((100, 60), (60, 80))],
            "mixed": lambda: [mixed(100, 60, 7), mixed(60, 80, 8)]}[kind]()
    ca, cb = cells_of(spark, a), cells_of(spark, b)
    got = mx.matmul(ca, cb, 20)
    assert table(got, 7) == table(mx.matmul_sparse(ca, cb), 7)
    assert ("CoGroup" in got._jdf.queryExecution().executedPlan().toString()) == (kind != "sparse")
    added = mx.gemm(2.0, ca, cb, -1.0, got)
    assert np.abs(dense(added, (100, 80)) - a @ b).max() < 1e-9


def test_empty_operands(spark, monkeypatch):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    none = spark.createDataFrame([], "i long, j long, v double")
    some = cells_of(spark, np.eye(3))
    assert mx.matmul(none, some).count() == mx.matmul(some, none).count() == 0
    stored = bl.store(none, 4, 2)
    assert bl.matmul(stored, bl.store(some, 4, 2)).count() == bl.gemv(stored, some.select("i", "v")).count() == 0
