"""Layouts that only matter on large or skewed input, exercised on small input, and plan checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators import align as al
from tickloom.operators import indicators as ind
from tickloom.operators import matrix as mx
from tickloom.operators import portfolio as pf
from tickloom.operators import rows as rw
from tickloom.operators import skew
from tickloom.plans import base as b
from tickloom.sources.text import safe_member

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def prices(spark):
    rnd = random.Random(3)
    first = dt.date(2020, 1, 1)
    rows = [(first + dt.timedelta(days=t), s, rnd.uniform(10, 20)) for t in range(120) for s in ("hot", "b", "c")
            if s == "hot" or rnd.random() < 0.6]
    return spark.createDataFrame(rows, "date date, symbol string, price double").repartition(5).cache()


def table(df, digits=9):
    return sorted((tuple(round(x, digits) if isinstance(x, float) else x for x in r) for r in df.collect()), key=str)


def test_blocks_do_not_change_indicators(prices):
    """Series cut into many blocks with overlap equal the uncut ones."""
    args = dict(rsi_period=5, band_period=4, k=4, d=3)
    assert table(ind.indicator_set(prices, block=16, **args)) == table(ind.indicator_set(prices, block=10_000, **args))


def test_blocks_match_a_row_loop(prices):
    got = {(r["symbol"], r["date"]): r["value"] for r in ind.rolling(prices, "mean", 5, block=12).collect()}
    rows = {(r["symbol"], r["date"]): r["price"] for r in prices.collect()}
    days = sorted({d for _, d in rows})
    for s in ("hot", "b", "c"):
        for t, d in enumerate(days):
            frame = [rows[s, x] for x in days[max(0, t - 4):t + 1] if (s, x) in rows]
            want = sum(frame) / len(frame) if t >= 4 and frame else None
            assert got[s, d] == (pytest.approx(want) if want is not None else None)


def test_normalised_prices_are_anchored_in_every_block(prices):
    cut, whole = pf.normalize_prices(prices, block=8), pf.normalize_prices(prices)
    assert table(cut) == table(whole)


def test_input_order_and_partitioning_do_not_matter(prices):
    shuffled = prices.orderBy(F.rand(1)).repartition(11)
    assert table(ind.rsi(prices, 5)) == table(ind.rsi(shuffled, 5))


def test_indicator_bounds(prices):
    out = ind.indicator_set(prices, rsi_period=5, band_period=4, k=4, d=3).collect()
    for r in out:
        assert r["rsi"] is None or 0 <= r["rsi"] <= 100
        assert r["percent_k"] is None or 0 <= r["percent_k"] <= 100
        assert r["sma"] is None or r["top"] is None or r["bottom"] <= r["sma"] <= r["top"]


def test_two_rows_for_one_day_are_an_error(spark, prices):
    again = prices.limit(1).withColumn("price", F.lit(1.0))
    with pytest.raises(Exception, match="two rows for symbol"):
        ind.rsi(prices.unionByName(again), 5).collect()


def test_timestamps_are_refused(spark):
    df = spark.sql("SELECT timestamp'2020-01-01 10:00:00' AS date, 'a' AS symbol, 1.0D AS price")
    with pytest.raises(TypeError):
        ind.rsi(df, 5)


@pytest.mark.parametrize("sides", [("left", "right"), ("left",), ("right",)])
def test_skew_join_equals_plain_join(spark, monkeypatch, sides):
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    rnd = random.Random(5)
    left = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 3, 9]), x) for x in range(200)], "k int, x int")
    right = spark.createDataFrame([(rnd.choice([1, 1, 2, 4]), y) for y in range(60)], "k int, y int")
    assert table(skew.skew_join(left, right, "k", sides)) == table(left.join(right, "k"))


def test_positions_with_a_hot_key(spark):
    rnd = random.Random(7)
    rows = [("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(20)}", x) for x in rnd.sample(range(10_000), 900)]
    df = spark.createDataFrame(rows, "key string, x int").repartition(6)
    want, seen = {}, {}
    for key, x in sorted(rows):
        want[key, x] = seen.get(key, 0)
        seen[key] = want[key, x] + 1
    got = {(r["key"], r["x"]): r["row_index"] for r in rw.row_positions(df, ["x"], key_cols=["key"]).collect()}
    assert got == want
    overall = rw.row_positions(df, ["x"])
    assert [r["row_index"] for r in overall.orderBy("x").collect()] == list(range(900))


def test_positional_bind_refuses_duplicate_keys(spark):
    left = spark.createDataFrame([(1, "a")], "k int, x string")
    right = spark.createDataFrame([(1, 2.0), (1, 3.0)], "k int, y double")
    with pytest.raises(Exception, match="key held twice"):
        al.positional_bind(left, right, "k").collect()


def test_qr_reproduces_the_matrix(spark):
    import numpy as np

    a = np.random.default_rng(1).normal(size=(300, 5))
    rows = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(a)], "i long, v array<double>").repartition(7)
    cells = mx.row_cells(rows, "v", ["i"])
    r = mx.qr_r(rows, "v", 5)
    q = mx.qr_q(cells, r, 5)
    back = {(c["i"], c["j"]): c["v"] for c in mx.matmul(q, r).collect()}
    assert max(abs(back[i, j] - a[i, j]) for i in range(300) for j in range(5)) < 1e-10
    want = np.linalg.qr(a, mode="r")
    want = want * np.where(np.diag(want) < 0, -1, 1)[:, None]
    assert all(abs(c["v"] - want[c["i"], c["j"]]) < 1e-10 for c in r.collect())
    gram = {(c["i"], c["j"]): c["v"] for c in mx.gramian(rows, "v", 5).collect()}
    assert all(abs(gram[i, j] - (a.T @ a)[i, j]) < 1e-10 for i in range(5) for j in range(5))


def test_large_matmul_takes_the_split_join(spark, monkeypatch):
    a = spark.createDataFrame([(i, i % 2, float(i)) for i in range(60)], "i long, j long, v double")
    c = spark.createDataFrame([(k, j, float(j + k)) for k in range(2) for j in range(7)], "i long, j long, v double")
    want = table(mx.matmul(a, c))
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    assert table(mx.matmul(a, c)) == want


def test_archive_members_stay_inside():
    assert safe_member("2022q1/sub.txt") and safe_member("a/../b.txt")
    assert not any(map(safe_member, ["../x", "a/../../x", "/etc/x", "C:\\x", "..\\x"]))


def plan_of(df):
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def test_all_indicators_share_one_exchange(spark):
    px = b.order_prices(spark, SF)
    plan = plan_of(ind.indicator_set(px, rsi_period=14, band_period=20, k=14, d=3))
    # one exchange of the observed rows and one of the (symbol, block) list; none above them
    assert plan.count("REPARTITION_BY_COL") == 2
    assert "Exchange" not in plan.split("Union")[0]
    assert plan.count("Window [") == 2
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_projection_and_filter_reach_the_scan(spark):
    from tickloom.sources import files as fl

    df = fl.scan_parquet_projected(spark, f"{SF}/lineitem.parquet", ["l_orderkey", "l_quantity"]).where("l_quantity > 45")
    plan = plan_of(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in plan
    assert "GreaterThan(l_quantity,45.0)" in plan


def test_documents_are_parsed_once(spark):
    from tickloom.plans import catalog

    plan = plan_of(catalog.QUERIES["explode_units"](spark, SF))
    assert plan.count("from_json(") == 1


def test_no_python_in_the_price_path(spark):
    plan = plan_of(pf.sharpe(b.flag_prices(spark, SF), b.allocations(spark, SF)))
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_full_outer_align_is_one_shuffle_and_checks_keys(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None)], "date int, a double")
    c = spark.createDataFrame([(2, 5.0), (3, 6.0)], "date int, b double")
    out = al.full_outer_align([a, c])
    assert table(out) == [(1, 1.0, None), (2, None, 5.0), (3, None, 6.0)]
    assert plan_of(out).count("Exchange hashpartitioning") == 1
    with pytest.raises(Exception, match="key held twice"):
        al.full_outer_align([a.unionByName(a), c]).collect()


def test_pandas_function_over_blocks(prices):
    def diff(p):
        return p.diff()

    assert table(pf.apply_series(prices, diff, 1, block=8)) == table(pf.apply_series(prices, diff, 1))


def test_scratch_can_be_cleared(spark):
    import os

    from tickloom import session

    stored = session.materialize(spark.range(3), "gone")
    assert stored.count() == 3 and os.path.isdir(session._session_root(spark))
    session.clear_scratch(spark)
    assert not os.path.isdir(session._session_root(spark))


def test_broadcast_size_is_measured(spark):
    df = spark.range(1000).select("id", F.lit("x" * 100).alias("s"))
    assert skew.fits_broadcast(df, 1000 * (32 + 100))
    assert not skew.fits_broadcast(df, 1000 * (32 + 100) - 1)
    assert not skew.fits_broadcast(df.select(F.array("id")))
    assert skew.fits_broadcast(df.where("id < 0"))


def test_densify_shuffles_observed_rows_only(spark):
    plan = plan_of(al.calendar_densify(b.order_prices(spark, SF)))
    assert "Exchange" not in plan.split("Union")[0]
