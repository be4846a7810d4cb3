"""Aligning price series on a shared calendar, and cutting the aligned series into blocks.

Every window in this package is positional over the calendar of *all* symbols: a date a symbol
lacks is a missing row inside its window, not a skipped one. ``align`` builds that layout.

How it stays bounded however the input is skewed:

* the calendar has one row per distinct ``date`` (a day date, so the type itself bounds it) and is
  the only thing broadcast;
* (symbol, date) is unique, so after alignment each symbol has exactly one row per calendar date;
* the calendar axis is cut into blocks of ``block`` positions. A block carries the ``lookback``
  rows before it as overlap, so a finite-lookback window over (symbol, block) gives the same values
  as one over the whole symbol, and no task ever holds a whole series.
"""

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 8192
# Longest frame that is computed anew for every row.
LONG_FRAME = 64

ROLLING = {"mean": F.avg, "std": F.stddev_samp, "max": F.max, "min": F.min}


def no_nan(col: Column) -> Column:
    """NaN as NULL: aggregates skip NULL but would return NaN for a frame that holds one."""
    return F.when(~F.isnan(col), col)


def calendar(prices: DataFrame, date_col: str = "date") -> DataFrame:
    """``(date, t, n_dates)``: the distinct dates with their 0-based position.

    The distinct dates are found in parallel; only they are sorted as one list, which the DateType
    range bounds at 3.7 million days whatever the size of ``prices``.
    """
    if not isinstance(prices.schema[date_col].dataType, T.DateType):
        raise TypeError(f"{date_col} must be a date column; cast timestamps with to_date first")
    days = prices.select(F.col(date_col).alias("date")).where(F.col("date").isNotNull()).distinct()
    listed = days.agg(F.array_sort(F.collect_list("date")).alias("dates"))
    return listed.select(F.size("dates").cast("long").alias("n_dates"), F.posexplode("dates").alias("t", "date")).select(
        "date", F.col("t").cast("long").alias("t"), "n_dates")


def _block_cells(days: DataFrame, block: int, lookback: int, anchor: bool) -> DataFrame:
    """``(date, t, blk, own)``: each date in its ``own`` block, and again wherever it is overlap.

    The last ``lookback`` dates of a block reappear in the next one; with ``anchor`` the first
    date of the calendar reappears in every block.
    """
    placed = days.select("date", "t", F.expr(f"t div {block}").alias("home"),
                         (F.expr(f"(n_dates - 1) div {block}") + 1).alias("n_blocks"))
    tail = (F.col("t") % block >= block - lookback) & (F.col("home") + 1 < F.col("n_blocks"))
    blocks = F.when(tail, F.array("home", F.col("home") + 1)).otherwise(F.array("home"))
    if anchor:
        blocks = F.when(F.col("t") == 0, F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)).otherwise(blocks)
    return placed.select("date", "t", "home", F.explode(blocks).alias("blk")).select(
        "date", "t", "blk", (F.col("home") == F.col("blk")).alias("own"))


def _merged(stat: str, a: dict, b: dict) -> Column:
    """``stat`` of two parts of a frame from the running columns of both; a part may be missing."""
    if stat in ("max", "min"):
        return (F.greatest if stat == "max" else F.least)(a["m"], b["m"])
    n, m = (F.coalesce(p["n"], F.lit(0)).cast("double") for p in (a, b))
    if stat == "mean":
        return F.try_divide(F.coalesce(a["s"], F.lit(0.0)) + F.coalesce(b["s"], F.lit(0.0)), n + m)
    # sums of squared distances from the parts' means, plus what their distance adds
    apart = F.coalesce((a["a"] - b["a"]) * (a["a"] - b["a"]) * n * m / (n + m), F.lit(0.0))
    squares = F.coalesce(a["q"] * n, F.lit(0.0)) + F.coalesce(b["q"] * m, F.lit(0.0)) + apart
    return F.when(n + m > 1, F.sqrt(squares / (n + m - 1)))


@dataclass(frozen=True)
class Series:
    """Aligned rows ``(key…, blk, t, own, date, values…)`` with overlap, plus the windows over them."""

    rows: DataFrame
    key: tuple
    lookback: int
    block: int

    def ordered(self):
        return Window.partitionBy(*self.key, "blk").orderBy("t")

    def frame(self, period: int):
        """The ``period`` rows that end at the current one."""
        if period - 1 > self.lookback:
            raise ValueError(f"period {period} needs a lookback of {period - 1}, laid out with {self.lookback}")
        return self.ordered().rowsBetween(-(period - 1), Window.currentRow)

    def roll(self, fn, value, period: int) -> Column:
        """``fn`` over full frames of ``period`` rows; missing before position ``period - 1``."""
        return F.when(F.col("t") >= period - 1, fn(value).over(self.frame(period)))

    def roll_layers(self, name: str, stat: str, value: Column, period: int) -> list:
        """``stat`` of ``ROLLING`` over full frames of ``period`` rows as column ``name``: a list of layers of columns,
        each of which reads the layers before.

        A moving frame is computed anew for every row. Beyond ``LONG_FRAME`` rows the calendar is therefore cut into
        chunks of ``period`` positions: a frame is the end of one chunk and the beginning of the next, so running
        statistics from both borders of each chunk give every frame at a cost that does not depend on the period. They
        are merged as they are, without subtracting one sum from another, so no digits cancel. Missing values are
        skipped as in a moving frame.
        """
        if period <= LONG_FRAME:
            return [{name: self.roll(ROLLING[stat], value, period)}]
        self.frame(period)  # refuses a layout with less lookback
        x, chunk = f"_{name}_x", F.expr(f"t div {period}")
        within = Window.partitionBy(*self.key, "blk", chunk).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        tail, head = within.orderBy(F.desc("t")), within.orderBy("t")
        parts = {"max": {"m": F.max(x)}, "min": {"m": F.min(x)}, "mean": {"n": F.count(x), "s": F.sum(x)},
                 "std": {"n": F.count(x), "a": F.avg(x), "q": F.var_pop(x)}}[stat]
        running = {f"_{name}_{side}{p}": fn.over(w) for side, w in (("tail_", tail), ("head_", head)) for p, fn in parts.items()}
        both = F.col("t") % period != period - 1  # else the frame is one whole chunk
        lagged = {f"_{name}_{p}": F.when(both, F.lag(f"_{name}_tail_{p}", period - 1).over(self.ordered())) for p in parts}
        a, b = ({p: F.col(f"_{name}_{side}{p}") for p in parts} for side in ("", "head_"))
        return [{x: value}, running, lagged, {name: F.when(F.col("t") >= period - 1, _merged(stat, a, b))}]

    def previous(self, value) -> Column:
        return F.lag(value, 1).over(self.ordered())

    def first(self, value) -> Column:
        """Value at calendar position 0; the series must be laid out with ``anchor=True``."""
        return F.first(value).over(self.ordered().rowsBetween(Window.unboundedPreceding, Window.currentRow))

    def with_columns(self, **cols) -> "Series":
        return Series(self.rows.withColumns(cols), self.key, self.lookback, self.block)

    def select(self, *cols) -> DataFrame:
        """The aligned rows without the overlap copies."""
        return self.rows.where("own").select(*cols)


def align(prices: DataFrame, *, value_cols=("price",), symbol_col: str = "symbol", date_col: str = "date",
          lookback: int = 0, anchor: bool = False, block: int = BLOCK) -> Series:
    """Lay prices out as calendar × symbols with NULL where a symbol has no row for a date.

    Price rows and the list of (symbol, block) are each hashed by (symbol, block). The skeleton of
    dates is then generated where its block lies, so the shuffle carries observed rows only, and the
    merge, the sort and all windows follow without another one. Two rows for one (symbol, date) raise
    an error.
    """
    block = max(block, 2 * lookback + 2)
    days = calendar(prices, date_col)
    cells = F.broadcast(_block_cells(days, block, lookback, anchor))
    last_block = days.agg(F.expr(f"(max(n_dates) - 1) div {block}")).scalar()
    doubles = {f.name for f in prices.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    values = [(no_nan(F.col(c)) if c in doubles else F.col(c)).alias(c) for c in value_cols]
    found = prices.select(F.col(symbol_col).alias("symbol"), F.col(date_col).alias("date"), *values)

    observed = (found.join(cells, "date").select("symbol", "blk", "t", "own", "date", F.lit(1).alias("_seen"), *value_cols)
                .repartition("symbol", "blk"))
    blocks = (found.where(F.col("date").isNotNull()).select("symbol").distinct().withColumn("_last", last_block)
              .select("symbol", F.explode(F.sequence(F.lit(0).cast("long"), "_last")).alias("blk"))
              .repartition("symbol", "blk"))
    types = {f.name: f.dataType for f in found.schema.fields}
    skeleton = blocks.join(cells, "blk").select(
        "symbol", "blk", "t", "own", "date", F.lit(0).alias("_seen"),
        *[F.lit(None).cast(types[c]).alias(c) for c in value_cols])

    merged = observed.unionByName(skeleton).groupBy("symbol", "blk", "t").agg(
        F.max("own").alias("own"), F.max("date").alias("date"), F.sum("_seen").alias("_seen"), *[F.max(c).alias(c) for c in value_cols])
    twice = F.raise_error(F.format_string("two rows for symbol %s on %s", F.col("symbol").cast("string"),
                                          F.col("date").cast("string")))
    checked = merged.select("symbol", "blk", "t", "own", "date",
                            *[F.when(F.col("_seen") > 1, twice).otherwise(F.col(c)).alias(c) for c in value_cols])
    return Series(checked, ("symbol",), lookback, block)


def with_overlap(rows: DataFrame, key, lookback: int = 1, block: int = BLOCK) -> Series:
    """Block layout for rows that already carry the calendar position ``t``, one per (key, t)."""
    block = max(block, 2 * lookback + 2)
    home = F.expr(f"t div {block}")
    tail = F.col("t") % block >= block - lookback
    copies = F.explode(F.when(tail, F.array(home, home + 1)).otherwise(F.array(home)))
    placed = rows.withColumn("blk", copies).withColumn("own", home == F.col("blk"))
    return Series(placed, tuple(key), lookback, block)


def calendar_densify(prices: DataFrame, value_cols=("price",), **names) -> DataFrame:
    """The aligned long form ``(date, symbol, values…)``."""
    return align(prices, value_cols=value_cols, **names).select("date", "symbol", *value_cols)


def full_outer_align(tables, key: str = "date") -> DataFrame:
    """n-way full outer equi-join on ``key`` with the key columns merged into one.

    Each table holds a key at most once (a second row is an error), so the join is a grouping of
    their union: one shuffle with map-side combination instead of one per table. Rows without a key
    match nothing and stay rows of their own.
    """
    names = [c for t in tables for c in t.columns if c != key]
    if len(set(names)) != len(names):
        raise ValueError("the tables share a column besides the key")
    marked = [t.withColumn(f"_n{i}", F.lit(1)) for i, t in enumerate(tables)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    counts = [f"_n{i}" for i in range(len(tables))]
    merged = stacked.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.first(c, ignorenulls=True).alias(c) for c in names],
                                      *[F.sum(n).alias(n) for n in counts])
    twice = reduce(lambda a, b: a | b, [F.coalesce(F.col(n) > 1, F.lit(False)) for n in counts])
    error = F.raise_error(F.concat(F.lit("key held twice: "), F.col(key).cast("string")))
    aligned = merged.select(F.when(twice, error).otherwise(F.col(key)).alias(key), *names)
    return aligned.unionByName(stacked.where(F.col(key).isNull()).select(key, *names))


def pivot_wide(prices: DataFrame, symbols, *, key: str = "date", symbol_col: str = "symbol",
               value_col: str = "price") -> DataFrame:
    """Long to wide, one column per listed symbol; the explicit list spares a pass over the data."""
    return prices.groupBy(key).pivot(symbol_col, list(symbols)).agg(F.first(value_col, ignorenulls=True))


def positional_bind(left: DataFrame, right: DataFrame, key) -> DataFrame:
    """Put the columns of ``right`` beside ``left`` by equal key; a key held twice is an error."""
    key = [key] if isinstance(key, str) else list(key)
    rest = [c for c in right.columns if c not in key]
    single = right.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in rest])
    twice = F.raise_error(F.concat(F.lit("key held twice: "), F.to_json(F.struct(*key))))
    single = single.select(*key, *[F.when(F.col("_n") > 1, twice).otherwise(F.col(c)).alias(c) for c in rest])
    return left.join(single, key, "left")
