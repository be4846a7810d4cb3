"""Projections, filters, row access by position, sorting and set operations."""

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.skew import fits_broadcast
from tickloom.session import materialize

HEAD_ROWS = 10_000


def select_drop(df: DataFrame, keep=None, drop=()) -> DataFrame:
    return (df.select(*keep) if keep else df).drop(*drop)


def rename_columns(df: DataFrame, names: dict) -> DataFrame:
    """Rename by exact name; dots in a name are part of it, not a path."""
    return df.withColumnsRenamed(names)


def reorder_columns(df: DataFrame, first) -> DataFrame:
    """The named columns in front, the others in their old order."""
    return df.select(*[F.col(f"`{c}`") for c in [*first, *[c for c in df.columns if c not in first]]])


def add_constant_column(df: DataFrame, name: str, value) -> DataFrame:
    return df.withColumn(name, F.lit(value))


def columns_except(df: DataFrame, name: str) -> list:
    """Column names that differ from ``name``, ignoring case."""
    return [c for c in df.columns if c.lower() != name.lower()]


def lookup_first_or_error(df: DataFrame, condition, message: str, order_cols=()) -> DataFrame:
    """The first row that matches, by ``order_cols`` or else all columns; no match is an error, raised when the row is read.

    The found row and the sentinel of an empty result are one aggregate row, so nothing is collected.
    """
    first = F.min_by(F.struct(*df.columns), F.struct(*(order_cols or df.columns))).alias("_row")
    found = df.where(condition).agg(F.count(F.lit(1)).alias("_n"), first)
    missing = F.raise_error(F.lit(message))
    return found.select(*[F.when(F.col("_n") == 0, missing).otherwise(F.col(f"_row.{c}")).alias(c) for c in df.columns])


def row_positions(df: DataFrame, order_cols, *, key_cols=(), name: str = "row_index") -> DataFrame:
    """Consecutive 0-based positions in the order of ``order_cols``, overall or within ``key_cols``.

    ``key_cols + order_cols`` must identify a row. Rows are range-partitioned by them, so a hot key
    is spread over as many partitions as its rows fill, sorted, and written once; the written part
    number and offset cannot change afterwards. Positions are the offset plus the sizes of the parts
    before. Only the part sizes (one row per part, or per part and key) are ever windowed.
    """
    key_cols, order_cols = list(key_cols), list(order_cols)
    cols = df.columns
    spread = (df.repartitionByRange(*[F.col(c) if isinstance(c, str) else c for c in [*key_cols, *order_cols]])
              .sortWithinPartitions(*key_cols, *order_cols)
              .withColumn("_id", F.monotonically_increasing_id()))
    stored = materialize(spread.withColumn("_part", F.shiftright("_id", 33)).withColumn(
        "_at", F.col("_id").bitwiseAND((1 << 33) - 1)).drop("_id"), "positions")
    parts = stored.groupBy(*key_cols, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_from"))
    before = Window.partitionBy(*key_cols).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(*key_cols, "_part", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    # without keys there is one row per part; with keys, one per part and key
    if not key_cols or fits_broadcast(parts):
        parts = F.broadcast(parts)
    position = (F.col("_before") + F.col("_at") - F.col("_from")).cast("long").alias(name)
    parts = parts.withColumnsRenamed({c: f"_of_{c}" for c in [*key_cols, "_part"]})
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in key_cols], F.col("_part") == F.col("_of__part"))
    return stored.join(parts, same).select(*cols, position)


def running_sums(df: DataFrame, order_cols, value_cols) -> DataFrame:
    """``df`` with ``before_<c>`` for each of ``value_cols``: its sum over the rows before, in the order of ``order_cols``.

    ``order_cols`` must identify a row. Rows are range-partitioned and written once; only one row of sums per part meets
    the others, so no window runs over all rows.
    """
    order_cols, value_cols = list(order_cols), list(value_cols)
    spread = df.repartitionByRange(*[F.col(c) if isinstance(c, str) else c for c in order_cols])
    stored = materialize(spread.withColumn("_part", F.spark_partition_id()), "running-sums")
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored.groupBy("_part").agg(*[F.sum(c).alias(c) for c in value_cols])
    bases = sums.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_base_{c}") for c in value_cols])
    within = Window.partitionBy("_part").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, -1)
    before = {f"before_{c}": F.col(f"_base_{c}") + F.coalesce(F.sum(c).over(within), F.lit(0)) for c in value_cols}
    return stored.join(F.broadcast(bases), "_part").withColumns(before).drop("_part", *[f"_base_{c}" for c in value_cols])


def row_range_slice(df: DataFrame, order_cols, start: int, stop: int, *, key_cols=()) -> DataFrame:
    """Rows ``[start, stop)`` by position, overall or within each key.

    Up to ``HEAD_ROWS`` every task keeps its first ``stop`` rows (of each key) before anything is shuffled; a
    larger ``stop`` needs the positions of all rows. Both give the same rows.
    """
    if stop <= HEAD_ROWS and not key_cols:
        return df.orderBy(*order_cols).offset(start).limit(stop - start)
    if stop <= HEAD_ROWS:
        nth = F.row_number().over(Window.partitionBy(*key_cols).orderBy(*order_cols))
        return df.withColumn("_pos", nth).where((F.col("_pos") <= stop) & (F.col("_pos") > start)).drop("_pos")
    placed = row_positions(df, order_cols, key_cols=key_cols, name="_pos")
    return placed.where((F.col("_pos") >= start) & (F.col("_pos") < stop)).drop("_pos")


def cell_at(df: DataFrame, order_cols, i: int, column: str, *, key_cols=()) -> DataFrame:
    """The value of ``column`` in row ``i``, overall or of each key."""
    return row_range_slice(df, order_cols, i, i + 1, key_cols=key_cols).select(*key_cols, column)


def assemble(df: DataFrame, value_cols, *, name: str = "row") -> DataFrame:
    """Value columns as one array column."""
    rest = [c for c in df.columns if c not in value_cols]
    return df.select(*rest, F.array(*[F.col(c).cast("double") for c in value_cols]).alias(name))


def disassemble(df: DataFrame, value_cols, *, name: str = "row") -> DataFrame:
    """The array column back as named columns."""
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, *[F.col(name)[i].alias(c) for i, c in enumerate(value_cols)])


def limit_head(df: DataFrame, n: int, order_cols) -> DataFrame:
    return df.orderBy(*order_cols).limit(n)


def tail_n(df: DataFrame, n: int, order_cols) -> DataFrame:
    """The last ``n`` rows, in order."""
    return df.orderBy(*[F.desc(c) for c in order_cols]).limit(n).orderBy(*order_cols)


def top_n(df: DataFrame, n: int, value_col: str, tie_cols) -> DataFrame:
    return df.orderBy(F.desc(value_col), *tie_cols).limit(n)


def sort_multi(df: DataFrame, *order, tie_cols=()) -> DataFrame:
    """Global sort; unique ``tie_cols`` last let Spark cut ranges inside a value many rows share."""
    return df.orderBy(*order, *tie_cols)


def union_all(tables) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), tables)
