"""Melt: wide to long."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.rows import rename_columns, union_all


def melt_all(df: DataFrame, ids, *, variable: str = "variable", value: str = "value") -> DataFrame:
    """Every column outside ``ids`` becomes a row."""
    return df.unpivot([F.col(f"`{c}`") for c in ids], None, variable, value)


def melt_subset(df: DataFrame, ids, values, *, drop_missing: bool = False) -> DataFrame:
    """``(ids…, variable, value)`` for the listed value columns, as doubles."""
    narrow = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    long = narrow.unpivot([F.col(f"`{c}`") for c in ids], [F.col(f"`{c}`") for c in values], "variable", "value")
    return long.where(F.col("value").isNotNull()) if drop_missing else long


def melt_clean(df: DataFrame, ids, values, *, variable: str, value: str, strip: str) -> DataFrame:
    """``melt_subset`` with its two new columns renamed and ``strip`` removed from the variable."""
    long = rename_columns(melt_subset(df, ids, values), {"variable": variable, "value": value})
    return long.withColumn(variable, F.replace(F.col(variable), F.lit(strip), F.lit("")))


def melt_by_column_union(df: DataFrame, ids, values) -> DataFrame:
    """``melt_subset`` done column by column and appended."""
    return union_all([melt_subset(df, ids, [v]) for v in values])
