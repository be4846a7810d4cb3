"""Column and row aggregates."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.rows import row_positions


def col_means(df: DataFrame, cols) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def col_sds(df: DataFrame, cols, ddof: int = 1) -> DataFrame:
    """Standard deviation of every column: sample by default, population for ``ddof=0``."""
    sd = F.stddev_samp if ddof else F.stddev_pop
    return df.agg(*[sd(c).alias(c) for c in cols])


def row_sums(df: DataFrame, cols, name: str = "row_sum") -> DataFrame:
    """Sum across columns; missing when any of them is."""
    return df.withColumn(name, reduce(lambda a, b: a + b, [F.col(c) for c in cols]))


def first_last_row(df: DataFrame, order_col: str, cols, key_cols=()) -> DataFrame:
    """First and last row by ``order_col``, overall or per key, as ``first_…`` and ``last_…``."""
    return df.groupBy(*key_cols).agg(
        *[F.min_by(c, order_col).alias(f"first_{c}") for c in cols],
        *[F.max_by(c, order_col).alias(f"last_{c}") for c in cols])


def mean_variance(df: DataFrame, col: str) -> DataFrame:
    """Mean and population variance."""
    return df.agg(F.avg(col).alias("mean"), F.var_pop(col).alias("variance"))


def collect_flatten(df: DataFrame, order_col: str, vector_col: str, width: int) -> DataFrame:
    """All vectors laid end to end as rows ``(pos, v)``.

    The vectors all have ``width`` elements; another length is an error. The flat array stays rows
    because one value holding it would not fit a task.
    """
    wrong = F.raise_error(F.lit(f"vector of another length than {width}"))
    vector = F.when(F.size(vector_col) != width, wrong).otherwise(F.col(vector_col))
    placed = row_positions(df.select(order_col, vector.alias("_v")), [order_col], name="_row")
    return placed.select("_row", F.posexplode("_v").alias("_j", "v")).select(
        (F.col("_row") * width + F.col("_j")).alias("pos"), "v")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))
