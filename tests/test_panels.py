"""Functions over all symbols at once, and many fields from one parse."""

import datetime as dt

import numpy as np
import pytest

from tests.test_scale import plan_of, table
from tickloom.operators import nested as ns
from tickloom.operators import portfolio as pf

FIRST = dt.date(2024, 1, 1)


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(1)
    rows = [(FIRST + dt.timedelta(days=t), s, float(rng.integers(1, 9))) for t in range(30) for s in ("a", "b", "c", "d")
            if rng.random() < 0.8 and not (s == "d" and t < 20)]
    return spark.createDataFrame(rows + [(FIRST, "a2", None), (FIRST + dt.timedelta(days=3), None, 1.0)], "date date, symbol string, price double").repartition(4)


def test_panels_do_not_change_results(prices):
    for fn in (pf.cross_rank, lambda p, **k: pf.rolling_covariance(p, 5, **k)):
        whole = table(fn(prices))
        assert whole and all(table(fn(prices, cells=cells)) == whole for cells in (1, 40, 100))


def test_every_panel_has_all_symbols(prices):
    def widths(matrix, own):
        import pandas as pd

        return pd.DataFrame({"date": matrix.index[own:], "n": len(matrix.columns), "own": own})

    rows = pf.apply_panels(prices, widths, "date date, n int, own int", lookback=2, cells=25).collect()
    days = prices.select("date").distinct().count()
    assert {r["n"] for r in rows} == {5} and len(rows) == len({r["date"] for r in rows}) == days
    assert min(r["own"] for r in rows) == 0 and max(r["own"] for r in rows) == 2


def test_covariances_match_numpy(prices):
    matrix = prices.toPandas().dropna(subset=["symbol"]).pivot(index="date", columns="symbol", values="price").sort_index()
    got = {(r["date"], r["symbol"], r["other"]): r["covariance"] for r in pf.rolling_covariance(prices, 6, cells=60).collect()}
    for t in range(5, len(matrix)):
        want = matrix.iloc[t - 5:t + 1].cov(min_periods=2)
        for s in want.index:
            for o in want.columns:
                x, y = got[matrix.index[t], s, o], want.loc[s, o]
                assert (np.isnan(y) and (x is None or np.isnan(x))) or x == pytest.approx(y, abs=1e-9)


def test_one_exchange_builds_the_panels(prices):
    plan = plan_of(pf.cross_rank(prices, cells=100))
    assert plan.count("Exchange hashpartitioning(blk") == 1 and "Exchange hashpartitioning(symbol" not in plan


def test_bad_panels(spark, prices):
    twice = prices.unionByName(prices.limit(50))
    with pytest.raises(Exception, match="two rows for symbol"):
        pf.cross_rank(twice).collect()
    assert pf.cross_rank(prices.limit(0)).count() == 0


TEXT = '{"a":{"b":[{"x":1,"y":["p","q"]},{"x":"2"},null,{"x":[5]}],"c":2.5},"k":"v","n":null,"t":[[{"z":1}],[]]}'
PATHS = {"one": ("$.a.b[0].x", "int"), "xs": ("$.a.b[*].x", "string"), "xi": ("$.a.b[*].x", "int"), "ys": ("$.a.b[*].y[*]", "string"),
         "c": ("$.a.c", "double"), "k": ("$.k", "string"), "n": ("$.n", "string"), "zs": ("$.t[*][*].z", "bigint"), "gone": ("$.q.r", "int"),
         "no_list": ("$.a.c[*]", "string")}


def test_ten_fields_from_one_parse(spark):
    df = spark.createDataFrame([(1, TEXT), (2, "{broken"), (3, None), (4, "5")], "i int, text string")
    out = ns.resolve_fields(df, "text", PATHS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json(") + plan.count("parseJson") == 1 and plan.count("try_variant_get(_document") == 10
    rows = {r["i"]: r for r in out.collect()}
    one = rows[1]
    assert (one["one"], one["xs"][:2], one["xi"]) == (1, ["1", "2"], [1, 2, None, None])
    assert one["ys"] == [["p", "q"], None, None, None] and (one["c"], one["k"], one["n"]) == (2.5, "v", None)
    assert one["zs"] == [[1], []] and one["gone"] is None and one["no_list"] is None
    assert all(rows[i][c] is None for i in (2, 3, 4) for c in PATHS)


def test_variant_as_resolver(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(TEXT,)], "text string").select(F.parse_json("text").alias("doc"))
    row = df.select(ns.resolve_field(F.col("doc"), "$.a.b[0].x", "int", ns.variant_resolver).alias("x"),
                    ns.resolve_field(F.col("doc"), "$.k", resolver=ns.variant_resolver).alias("k")).head()
    assert (row["x"], row["k"]) == (1, "v")
    with pytest.raises(ValueError, match="starts with"):
        ns.variant_field(F.col("doc"), "a.b")
