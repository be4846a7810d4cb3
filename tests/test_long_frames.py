"""Frames of thousands of rows against moving frames."""

import datetime as dt
import time

import numpy as np
import pytest

from tickloom.operators import align as al
from tickloom.operators import indicators as ind


@pytest.fixture(scope="module")
def prices(spark):
    rng = np.random.default_rng(8)
    first = dt.date(2000, 1, 1)
    rows = [(first + dt.timedelta(days=t), s, None if kind > 0.97 else float("nan") if kind > 0.95 else float(1e6 + rng.normal()))
            for t in range(700) for s in "abc" for kind in [rng.random()] if s == "a" or kind > 0.2]
    rows += [(first + dt.timedelta(days=t), "late", 5.0) for t in range(600, 700)]
    return spark.createDataFrame(rows, "date date, symbol string, price double").repartition(5).cache()


def values(df):
    return {(r["symbol"], r["date"]): tuple(r[c] for c in df.columns if c not in ("symbol", "date")) for r in df.collect()}


def same(a, b):
    assert a.keys() == b.keys()
    for k, row in a.items():
        for x, y in zip(row, b[k]):
            assert (x is None) == (y is None), (k, row, b[k])
            assert x is None or x == pytest.approx(y, rel=1e-9, abs=1e-6)


@pytest.mark.parametrize("stat", ["mean", "std", "max", "min"])
@pytest.mark.parametrize("period, block", [(7, 20), (100, 201), (650, 8192)])
def test_long_frames_equal_moving_ones(monkeypatch, prices, stat, period, block):
    monkeypatch.setattr(al, "LONG_FRAME", 1000)
    moving = values(ind.rolling(prices, stat, period, block=block))
    monkeypatch.setattr(al, "LONG_FRAME", 3)
    same(values(ind.rolling(prices, stat, period, block=block)), moving)


def test_indicators_over_long_frames(monkeypatch, prices):
    args = dict(rsi_period=90, band_period=80, k=70, d=66)
    got = values(ind.indicator_set(prices, **args))
    monkeypatch.setattr(al, "LONG_FRAME", 1000)
    same(got, values(ind.indicator_set(prices, **args)))


def test_cost_does_not_grow_with_the_period(spark):
    first = dt.date(1900, 1, 1)
    days = spark.range(0, 40_000, 1, 8).selectExpr("date_add(date'1900-01-01', cast(id as int)) as date", "cast(hash(id) % 1000 as double) as price")
    px = days.crossJoin(spark.range(4).selectExpr("cast(id as string) as symbol")).select("date", "symbol", "price").cache()
    px.count()

    def seconds(period):
        best = []
        for _ in range(3):
            start = time.perf_counter()
            ind.rolling(px, "std", period).write.format("noop").mode("overwrite").save()
            best.append(time.perf_counter() - start)
        return min(best)

    seconds(20)
    assert seconds(5000) <= 2 * seconds(20) + 1, first
    px.unpersist()


def test_frames_need_their_lookback(prices):
    s = al.align(prices, lookback=70)
    with pytest.raises(ValueError, match="lookback"):
        s.roll_layers("x", "max", "price", 100)
