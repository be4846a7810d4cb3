"""QR of matrices of any width."""

import numpy as np
import pytest

from tickloom.operators import matrix as mx
from tickloom.operators import panels


def rows_of(spark, a, parts=4):
    return spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "i long, v array<double>").repartition(parts)


def conditioned(m, n, condition, seed=1):
    rng = np.random.default_rng(seed)
    u, v = np.linalg.qr(rng.normal(size=(m, n)))[0], np.linalg.qr(rng.normal(size=(n, n)))[0]
    return u * np.geomspace(1, 1 / condition, n) @ v


def dense(cells, shape):
    t = cells.toArrow()
    out = np.zeros(shape)
    out[t["i"].to_numpy(), t["j"].to_numpy()] = t["v"].to_numpy()
    return out


def test_two_thousand_columns(spark):
    a = conditioned(2200, 2000, 1e6)
    rows = rows_of(spark, a)
    q_rows, r_cells = panels.factor(rows, "v", 2000, ["i"])
    q, r = np.zeros_like(a), dense(r_cells, (2000, 2000))
    for row in q_rows.toLocalIterator():
        q[row["i"]] = row["q"]
    assert np.abs(q.T @ q - np.eye(2000)).max() < 1e-9
    assert np.abs(q @ r - a).max() < 1e-12 and np.diag(r).min() > 0 and not np.tril(r, -1).any()
    from_r = np.zeros_like(a)
    for row in panels.solve_rows(rows, "v", r_cells, 2000, ["i"]).toLocalIterator():
        from_r[row["i"]] = row["q"]
    assert np.abs(from_r.T @ from_r - np.eye(2000)).max() < 1e-9


def test_panels_do_not_change_the_factor(spark, monkeypatch):
    a = np.random.default_rng(2).normal(size=(90, 30))
    rows = rows_of(spark, a, 7)
    narrow = dense(mx.qr_r(rows, "v", 30), (30, 30))
    before = spark.conf.get(panels._BATCH_CONF)
    q, r = panels.factor(rows, "v", 30, ["i"], panel=30)
    assert np.abs(dense(r, (30, 30)) - narrow).max() < 1e-12 and q.count() == 90
    monkeypatch.setattr(mx, "NARROW", 11)
    cells = mx.row_cells(rows, "v", ["i"])
    r = mx.qr_r(rows, "v", 30)  # three panels
    assert np.abs(dense(r, (30, 30)) - narrow).max() < 1e-12
    assert spark.conf.get(panels._BATCH_CONF) == before
    sparse = cells.where("abs(v) > 0.5")
    b = dense(sparse, (90, 30))
    assert np.abs(dense(mx.qr_q(sparse, r, 30), (90, 30)) @ narrow - b).max() < 1e-12


def test_blocks_of_many_tasks_are_summed_in_rounds(spark, monkeypatch):
    monkeypatch.setattr(panels, "FAN_IN", 2)
    a = np.random.default_rng(3).normal(size=(64, 12))
    r = panels.factor(rows_of(spark, a, 9), "v", 12, panel=5)[1]
    assert np.abs(dense(r, (12, 12)).T @ dense(r, (12, 12)) - a.T @ a).max() < 1e-10


def test_what_cannot_be_factored_is_an_error(spark):
    a = np.random.default_rng(4).normal(size=(40, 12))
    a[:, 9] = a[:, 2] + a[:, 5]
    with pytest.raises(Exception, match="column rank"):
        panels.factor(rows_of(spark, a), "v", 12, panel=5)
    with pytest.raises(Exception, match="column rank"):
        panels.factor(rows_of(spark, np.ones((3, 12))), "v", 12, panel=5)
    ragged = spark.createDataFrame([(0, [1.0] * 12), (1, [1.0]), (2, None)], "i long, v array<double>")
    with pytest.raises(Exception, match="row without 12 values"):
        panels.factor(ragged, "v", 12, panel=5)


def test_right_solve():
    rng = np.random.default_rng(5)
    r, x = np.triu(rng.normal(size=(150, 150))) + 20 * np.eye(150), rng.normal(size=(9, 150))
    assert np.abs(panels.right_solve(x, r) @ r - x).max() < 1e-10
