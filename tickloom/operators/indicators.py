"""Rolling statistics and technical indicators over aligned price series.

Each function takes long prices ``(date, symbol, price)``, handles all symbols in one plan and
keeps every calendar date. ``indicator_set`` computes several indicators over one shared layout.
"""

from itertools import zip_longest

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.align import Series, align
from tickloom.operators.skew import lookup_join

# Defaults of the indicators.
BAND_PERIOD = 20
BAND_DEVIATIONS = 2
OVERBOUGHT = 70.0
OVERSOLD = 30.0
MARK_EVERY = 5


def rolling(prices: DataFrame, stat: str, period: int, **layout) -> DataFrame:
    """``rolling(period).stat()`` for ``mean``, ``std``, ``max`` or ``min``."""
    s = align(prices, lookback=period - 1, **layout)
    return _apply(s, s.roll_layers("value", stat, F.col("price"), period)).select("date", "symbol", "price", "value")


def difference(prices: DataFrame, **layout) -> DataFrame:
    s = align(prices, lookback=1, **layout)
    return s.with_columns(diff=F.col("price") - s.previous("price")).select("date", "symbol", "price", "diff")


def _gain(diff: Column) -> Column:
    return F.when(diff < 0, 0.0).otherwise(diff)


def _loss(diff: Column) -> Column:
    """A missing difference counts as no loss, though it is not a gain of zero either."""
    return F.when(diff < 0, -diff).otherwise(0.0)


def gains_losses(prices: DataFrame, **layout) -> DataFrame:
    s = align(prices, lookback=1, **layout)
    s = s.with_columns(diff=F.col("price") - s.previous("price"))
    return s.with_columns(gain=_gain(F.col("diff")), loss=_loss(F.col("diff"))).select("date", "symbol", "gain", "loss")


# Each indicator below is a list of layers: columns that depend only on the layers before. Applying
# several indicators layer by layer lets Spark compute all windows of a layer in one pass.


def _rsi_layers(s: Series, period: int) -> list:
    diff, up, down = F.col("_diff"), F.col("_up"), F.col("_down")
    return [{"_diff": F.col("price") - s.previous("price")},
            {"_gain": _gain(diff), "_loss": _loss(diff)},
            *_side_by_side(s.roll_layers("_up", "mean", F.col("_gain"), period), s.roll_layers("_down", "mean", F.col("_loss"), period)),
            {"rsi": 100 * F.try_divide(up, up + down)}]


def _band_layers(s: Series, period: int, deviations: float) -> list:
    price, sma, sd, top, bottom = (F.col(c) for c in ("price", "sma", "_sd", "top", "bottom"))
    return [*_side_by_side(s.roll_layers("sma", "mean", price, period), s.roll_layers("_sd", "std", price, period)),
            {"top": sma + deviations * sd, "bottom": sma - deviations * sd},
            {"bbp": F.try_divide(price - bottom, top - bottom)}]


def _stochastic_layers(s: Series, k: int, d: int, high: str = "price", low: str = "price") -> list:
    price, hi, lo = F.col("price"), F.col("_hi"), F.col("_lo")
    return [*_side_by_side(s.roll_layers("_hi", "max", F.col(high), k), s.roll_layers("_lo", "min", F.col(low), k)),
            {"percent_k": 100 * F.try_divide(price - lo, hi - lo)},
            *s.roll_layers("percent_d", "mean", F.col("percent_k"), d)]


def _side_by_side(*indicators: list) -> list:
    """The layers of several indicators, the first ones together, then the second ones, and so on."""
    return [{name: col for layer in layers for name, col in layer.items()} for layers in zip_longest(*indicators, fillvalue={})]


def _apply(s: Series, *indicators: list) -> Series:
    for layer in _side_by_side(*indicators):
        s = s.with_columns(**layer)
    return s


def rsi(prices: DataFrame, period: int = 14, **layout) -> DataFrame:
    """Relative strength index, 100·(up/(up+down)) of the mean gains and losses; flat frames are missing."""
    s = align(prices, lookback=period, **layout)
    return _apply(s, _rsi_layers(s, period)).select("date", "symbol", "rsi")


def bollinger_bands(prices: DataFrame, period: int = BAND_PERIOD, deviations: float = BAND_DEVIATIONS,
                    **layout) -> DataFrame:
    s = align(prices, lookback=period - 1, **layout)
    s = _apply(s, _band_layers(s, period, deviations))
    return s.select("date", "symbol", F.col("price").alias("adj_close"), "top", "bottom", "sma")


def bollinger_pct(prices: DataFrame, period: int = BAND_PERIOD, deviations: float = BAND_DEVIATIONS,
                  **layout) -> DataFrame:
    """Where the price lies between the bands, 0 at the bottom one; bands of no width are missing."""
    s = align(prices, lookback=period - 1, **layout)
    return _apply(s, _band_layers(s, period, deviations)).select("date", "symbol", "bbp")


def stochastic(prices: DataFrame, k: int, d: int, *, high_col: str = "price", low_col: str = "price",
               **layout) -> DataFrame:
    """%K and %D for every symbol; the high and low columns default to the price itself."""
    values = tuple(dict.fromkeys(("price", high_col, low_col)))
    s = align(prices, value_cols=values, lookback=k + d - 2, **layout)
    s = _apply(s, _stochastic_layers(s, k, d, high_col, low_col))
    return s.select("date", "symbol", "percent_k", "percent_d", F.col("price").alias("prices"))


def indicator_set(prices: DataFrame, *, rsi_period: int, band_period: int, k: int, d: int,
                  deviations: float = BAND_DEVIATIONS, **layout) -> DataFrame:
    """RSI, bands, %B, %K and %D side by side over one layout, one exchange and two window passes."""
    s = align(prices, lookback=max(rsi_period, band_period - 1, k + d - 2), **layout)
    s = _apply(s, _rsi_layers(s, rsi_period), _band_layers(s, band_period, deviations), _stochastic_layers(s, k, d))
    return s.select("date", "symbol", "price", "rsi", "sma", "top", "bottom", "bbp", "percent_k", "percent_d")


def warmup_mask(prices: DataFrame, k: int, **layout) -> DataFrame:
    """Prices with the first ``k - 1`` calendar rows of each symbol made missing."""
    s = align(prices, **layout)
    return s.select("date", "symbol", F.when(F.col("t") >= k - 1, F.col("price")).alias("price"))


def normalized_price(bars: DataFrame, price_col: str = "close") -> DataFrame:
    """Bars with ``normalized`` = price over the symbol's first observed price.

    The first price is a map-side-combined aggregate of one row per symbol, joined back on symbol.
    """
    first = bars.groupBy("symbol").agg(F.min_by(price_col, "date").alias("_first"))
    return lookup_join(bars, first, "symbol").withColumn("normalized", F.try_divide(price_col, "_first")).drop("_first")


def series_long(df: DataFrame, series_cols, ids=("date", "symbol")) -> DataFrame:
    """Plot data as rows ``(ids…, series, value)``."""
    return df.unpivot(list(ids), list(series_cols), "series", "value")


def threshold_overlay(prices: DataFrame, period: int = 14, every: int = MARK_EVERY, **layout) -> DataFrame:
    """RSI with its two reference levels marked on every ``every``-th calendar row."""
    s = align(prices, lookback=period, **layout)
    s = _apply(s, _rsi_layers(s, period))
    marked = F.col("t") % every == 0
    return s.select("date", "symbol", "rsi", F.when(marked, F.lit(OVERBOUGHT)).alias("overbought"),
                    F.when(marked, F.lit(OVERSOLD)).alias("oversold"))
