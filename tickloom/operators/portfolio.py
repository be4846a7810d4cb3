"""Portfolio statistics for many portfolios at once.

Allocations are rows ``(portfolio_id, symbol, w)``. Frames keep the calendar position ``t`` beside
``date`` so that later steps need neither a second alignment nor an unpartitioned sort.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.align import Series, align, calendar, no_nan, with_overlap
from tickloom.operators.skew import BROADCAST_BYTES, skew_join, total_bytes
from tickloom.session import materialize

# Fixed value: trading days in a year.
TRADING_DAYS = 252

DATE_BLOCK = 32
PORTFOLIOS_PER_BUCKET = 256


def normalize_prices(prices: DataFrame, **layout) -> DataFrame:
    """``(date, symbol, t, norm)``: every price over its symbol's price on the first calendar date.

    A symbol without a price on that date has a missing series. The first price travels with each
    block as an anchor row, so there is no join back on symbol.
    """
    s = align(prices, anchor=True, **layout)
    return s.with_columns(norm=F.try_divide("price", s.first("price"))).select("date", "symbol", "t", "norm")


def priced_symbols(prices: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """``(symbol)`` of raw prices: one column read, reduced in each task before the shuffle."""
    return prices.select(F.col(symbol_col).alias("symbol")).distinct()


def _with_unknown(symbols: DataFrame, alloc: DataFrame) -> DataFrame:
    """Allocations to symbols without any price, turned into a missing weight on some symbol that has prices.

    Such a holding then meets every date and makes the portfolio's value missing there, instead of falling out of
    the join. ``symbols`` is written.
    """
    some = symbols.agg(F.min("symbol")).scalar()
    known = symbols.where(F.col("symbol").isNotNull()).withColumn("_known", F.lit(True))
    return alloc.join(known, "symbol", "left").select(
        "portfolio_id", F.when(F.col("_known"), F.col("symbol")).otherwise(some).alias("symbol"), F.when(F.col("_known"), F.col("w")).alias("w"))


def _value_series(normalized: DataFrame, alloc: DataFrame, lookback: int, symbols: DataFrame | None = None) -> Series:
    """Portfolio values laid out in blocks of the calendar, ready for windows over ``lookback`` rows.

    Allocations of a counted, bounded size are broadcast to prices that are cut into date blocks and
    copied once per bucket of portfolios, so the values and the windows over them are computed where
    (block, bucket) lies: tasks grow with dates and portfolios, and portfolios × dates is not shuffled.
    Larger allocations are joined by symbol with their hot symbols split. Aligned prices hold
    equally many rows per symbol, so only the allocations can be hot.

    The alignment behind ``normalized`` runs once. Without ``symbols``, the symbols it holds, it is written for that.
    """
    if symbols is None:
        normalized = materialize(normalized, "normalized")
        symbols = priced_symbols(normalized)
    value = [F.max("date").alias("date"),  # one date per calendar position
             F.when(F.count(F.lit(1)) == F.count(F.col("norm") * F.col("w")), F.sum(F.col("norm") * F.col("w"))).alias("port_value")]
    alloc = materialize(_with_unknown(materialize(symbols, "symbols"), alloc), "allocations")
    size, portfolios = alloc.agg(total_bytes(alloc), F.approx_count_distinct("portfolio_id")).head()
    if (size or 0) <= BROADCAST_BYTES:
        buckets = 1 + portfolios // PORTFOLIOS_PER_BUCKET
        alloc = alloc.withColumn("bucket", F.pmod(F.xxhash64("portfolio_id"), F.lit(buckets)))
        cut = with_overlap(normalized, ("portfolio_id", "bucket"), lookback, DATE_BLOCK)
        dealt = cut.rows.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
        # a fixed number of tasks: the rows that are dealt are few, but each meets all portfolios of its bucket
        tasks = int(alloc.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        held = dealt.repartition(tasks, "blk", "bucket").join(F.broadcast(alloc), ["symbol", "bucket"])
        values = held.groupBy("portfolio_id", "bucket", "blk", "t").agg(F.max("own").alias("own"), *value)
        return Series(values, cut.key, lookback, cut.block)
    held = skew_join(normalized, alloc, "symbol", sides=("right",))
    return with_overlap(held.groupBy("portfolio_id", "t").agg(*value), ("portfolio_id",), lookback)


def portfolio_value(normalized: DataFrame, alloc: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """``(portfolio_id, date, t, port_value)``, missing on dates when any held symbol or weight is missing; a symbol
    without any price is missing on all dates. ``symbols`` as ``priced_symbols`` gives them spares a copy of
    ``normalized``."""
    return _value_series(normalized, alloc, 0, symbols).select("portfolio_id", "date", "t", "port_value")


def _add_return(s: Series, value_col: str, keep_first: bool) -> Series:
    before = s.previous(value_col)
    change = F.try_divide(F.col(value_col) - before, before)
    if keep_first:
        change = F.when(F.col("t") == 0, F.col(value_col)).otherwise(change)
    return s.with_columns(daily_return=change)


def daily_returns(values: DataFrame, *, key=("portfolio_id",), value_col: str = "port_value",
                  keep_first: bool = False) -> DataFrame:
    """``(v[t] − v[t−1]) / v[t−1]`` as ``daily_return``.

    Row 0 has no return; ``keep_first`` leaves the raw value there instead.
    """
    s = _add_return(with_overlap(values, key, lookback=1), value_col, keep_first)
    return s.select(*key, "date", "t", "daily_return")


def portfolio_returns(normalized: DataFrame, alloc: DataFrame, symbols: DataFrame | None = None, *,
                      keep_first: bool = False) -> DataFrame:
    """``(portfolio_id, date, t, daily_return)`` straight from normalised prices: values and returns share one
    layout, so portfolios × dates is not shuffled in between."""
    s = _add_return(_value_series(normalized, alloc, 1, symbols), "port_value", keep_first)
    return s.select("portfolio_id", "date", "t", "daily_return")


def _skip_missing(stat, strict_nulls):
    if not strict_nulls:
        return stat
    return F.when(F.count(F.lit(1)) == F.count("daily_return"), stat)


def average_daily_return(returns: DataFrame, *, key=("portfolio_id",), strict_nulls: bool = False) -> DataFrame:
    """Mean return without row 0; ``strict_nulls`` makes it missing when any day is."""
    later = returns.where(F.col("t") > 0)
    return later.groupBy(*key).agg(_skip_missing(F.avg("daily_return"), strict_nulls).alias("average_daily_return"))


def std_daily_return(returns: DataFrame, *, key=("portfolio_id",), ddof: int = 1,
                     strict_nulls: bool = False) -> DataFrame:
    """Standard deviation of the returns without row 0: sample by default, population for ``ddof=0``."""
    sd = (F.stddev_samp if ddof else F.stddev_pop)("daily_return")
    return returns.where(F.col("t") > 0).groupBy(*key).agg(_skip_missing(sd, strict_nulls).alias("std_daily_return"))


def cumulative_return(values: DataFrame, *, key=("portfolio_id",), value_col: str = "port_value",
                      as_coded: bool = False) -> DataFrame:
    """Last over first value, minus 1; ``as_coded`` gives first over last, minus 1."""
    first, last = F.min_by(value_col, "t"), F.max_by(value_col, "t")
    ratio = F.try_divide(first, last) if as_coded else F.try_divide(last, first)
    return values.groupBy(*key).agg((ratio - 1).alias("cumulative_return"))


def sharpe(prices: DataFrame, alloc: DataFrame, *, ddof: int = 1, strict_nulls: bool = False, **layout) -> DataFrame:
    """Mean over standard deviation of the daily returns, annualised, risk-free rate 0."""
    values = _value_series(normalize_prices(prices, **layout), alloc, 1, priced_symbols(prices, layout.get("symbol_col", "symbol")))
    returns = _add_return(values, "port_value", False).select("portfolio_id", "t", "daily_return")
    mean = _skip_missing(F.avg("daily_return"), strict_nulls)
    sd = (F.stddev_samp if ddof else F.stddev_pop)("daily_return")
    return (returns.where(F.col("t") > 0).groupBy("portfolio_id")
            .agg((F.try_divide(mean, sd) * TRADING_DAYS ** 0.5).alias("sharpe")))


def apply_columnwise(wide: DataFrame, fn, *, date_col: str = "date") -> DataFrame:
    """``fn`` (Column → Column) over every column but the date, which stays in front."""
    return wide.select(date_col, *[fn(F.col(c)).alias(c) for c in wide.columns if c != date_col])


def apply_series(prices: DataFrame, fn, lookback: int, **layout) -> DataFrame:
    """A pandas function over each symbol's aligned prices, for what columns cannot express.

    ``fn`` maps the prices of a block, in calendar order with ``lookback`` rows before it, to as many
    results; missing prices are NaN. Blocks are bounded, so no task holds a whole series.
    """
    s = align(prices, lookback=lookback, **layout)

    def run(pdf):
        pdf = pdf.sort_values("t", ignore_index=True)
        return pdf.assign(value=fn(pdf["price"]))

    schema = T.StructType([*s.rows.schema.fields, T.StructField("value", T.DoubleType())])
    computed = s.rows.groupBy(*s.key, "blk").applyInPandas(run, schema)
    return Series(computed, s.key, s.lookback, s.block).select("date", "symbol", "value")


PANEL_CELLS = 1 << 21


def apply_panels(prices: DataFrame, fn, schema: str, lookback: int = 0, cells: int = PANEL_CELLS, *, symbol_col: str = "symbol",
                 date_col: str = "date", value_col: str = "price") -> DataFrame:
    """A pandas function over all symbols at once, for what relates columns to each other.

    ``fn(matrix, own)`` gets a table with a row per calendar date, in order, and a column per symbol, in order, missing
    prices as NaN. The first rows are the up to ``lookback`` dates before; rows from number ``own`` on are the panel's own. It
    returns rows of ``schema``.

    The calendar is cut into panels of as many dates as keep dates × symbols at about ``cells``, one date at least: with
    more symbols panels get shorter, so a task's share is bounded by ``cells`` or by ``lookback + 1`` dates of all symbols,
    which is what ``fn`` asks for. Prices reach their panels in one exchange; a panel knows symbols without any price in
    it from a list of (panel, symbol) that is generated beside them. Two rows for one (symbol, date) are an error.
    """
    import pandas as pd

    days = materialize(calendar(prices, date_col), "calendar")
    symbols = materialize(priced_symbols(prices, symbol_col).where("symbol IS NOT NULL"), "symbols")
    n_dates = days.agg(F.max("n_dates")).head()[0] or 0
    block = max(1, cells // max(1, symbols.count()) - lookback)
    cut = _panel_dates(days, block, lookback)
    kind = symbols.schema["symbol"].dataType
    found = prices.select(F.col(symbol_col).alias("symbol"), F.col(date_col).alias("date"), no_nan(F.col(value_col).cast("double")).alias("v"))
    observed = found.where("symbol IS NOT NULL").join(F.broadcast(cut), "date").select("blk", "symbol", "date", "own", "v")
    panels = F.sequence(F.lit(0).cast("long"), F.lit(max(0, (n_dates - 1) // block)).cast("long"))
    every = symbols.select(F.explode(panels).alias("blk"), "symbol", F.lit(None).cast("date").alias("date"), F.lit(None).cast("boolean").alias("own"),
                           F.lit(None).cast("double").alias("v")) if n_dates else observed.limit(0)
    dates = cut.select("blk", F.lit(None).cast(kind).alias("symbol"), "date", "own", F.lit(None).cast("double").alias("v"))

    def run(pdf):
        calendar_rows = pdf[pdf["symbol"].isna()].sort_values("date")
        names = sorted(pdf["symbol"].dropna().unique())
        held = pdf[pdf["symbol"].notna() & pdf["date"].notna()]
        if held.duplicated(["date", "symbol"]).any():
            twice = held[held.duplicated(["date", "symbol"])].iloc[0]
            raise ValueError(f"two rows for symbol {twice['symbol']} on {twice['date']}")
        matrix = held.pivot(index="date", columns="symbol", values="v").reindex(index=list(calendar_rows["date"]), columns=names)
        return fn(matrix.astype(float), int((~calendar_rows["own"].astype(bool)).sum()))

    return observed.unionByName(every).unionByName(dates).groupBy("blk").applyInPandas(lambda pdf: pd.DataFrame(run(pdf)), schema)


def _panel_dates(days: DataFrame, block: int, lookback: int) -> DataFrame:
    """``(date, blk, own)``: each date in its panel, and again in the panels whose lookback it is."""
    home, last = F.expr(f"t div {block}"), F.expr(f"(n_dates - 1) div {block}")
    until = F.least(F.expr(f"(t + {lookback}) div {block}"), last)
    placed = days.select("date", home.alias("home"), F.explode(F.sequence(home, until)).alias("blk"))
    return placed.select("date", "blk", (F.col("home") == F.col("blk")).alias("own"))


def cross_rank(prices: DataFrame, cells: int = PANEL_CELLS, **names) -> DataFrame:
    """``(date, symbol, rank)``: the place of each price among all symbols of its date, 1 for the largest, equal ones the
    same place; missing prices have none."""

    def rank(matrix, own):
        return _long(matrix.rank(axis=1, ascending=False, method="min").iloc[own:], "rank")

    return apply_panels(prices, rank, _panel_schema(prices, "rank double", **names), 0, cells, **names)


def rolling_covariance(prices: DataFrame, period: int, cells: int = PANEL_CELLS, **names) -> DataFrame:
    """``(date, symbol, other, covariance)`` of every two symbols over full frames of ``period`` dates, sample ones, over the
    dates on which both have a price; missing where there are fewer than two."""

    def covariance(matrix, own):
        import numpy as np
        import pandas as pd

        x, out, symbols = matrix.to_numpy(), [], list(matrix.columns)
        for t in range(max(own, period - 1), len(x)):
            frame = x[t - period + 1:t + 1]
            held = ~np.isnan(frame)
            n = held.T.astype(float) @ held
            y = np.where(held, frame, 0.0)
            y = np.where(held, y - y.sum(axis=0) / np.maximum(held.sum(axis=0), 1), 0.0)
            cross, sums = y.T @ y, y.T @ held
            with np.errstate(invalid="ignore", divide="ignore"):
                value = np.where(n > 1, (cross - sums * sums.T / n) / (n - 1), np.nan)
            i, j = np.indices(value.shape)
            out.append(pd.DataFrame({"date": matrix.index[t], "symbol": [symbols[k] for k in i.ravel()], "other": [symbols[k] for k in j.ravel()],
                                     "covariance": value.ravel()}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype=object) for c in ("date", "symbol", "other", "covariance")})

    kind = prices.schema[names.get("symbol_col", "symbol")].dataType.simpleString()
    return apply_panels(prices, covariance, f"date date, symbol {kind}, other {kind}, covariance double", period - 1, cells, **names)


def _panel_schema(prices: DataFrame, value: str, **names) -> str:
    return f"date date, symbol {prices.schema[names.get('symbol_col', 'symbol')].dataType.simpleString()}, {value}"


def _long(matrix, name: str):
    """A matrix as rows ``(date, symbol, name)``."""
    return matrix.rename_axis(index="date", columns="symbol").stack(future_stack=True).rename(name).reset_index()


def log_return(prices: DataFrame, **layout) -> DataFrame:
    """``ln(v[t] / v[t−1])`` per symbol, the usual function handed to a column-wise statistic."""
    s = align(prices, lookback=1, **layout)
    ratio = F.try_divide("price", s.previous("price"))
    return s.with_columns(log_return=F.ln(ratio)).select("date", "symbol", "log_return")


def zeros_like_keyed(wide: DataFrame, *, date_col: str = "date") -> DataFrame:
    """Same dates and columns, every value 0.0."""
    return apply_columnwise(wide, lambda c: F.lit(0.0), date_col=date_col)
