"""Parquet scans, sinks and reports, and price and bar scans."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.sources.zips import file_system


def sink_parquet_gzip(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "gzip").parquet(path)


def scan_parquet_projected(spark: SparkSession, path: str, cols) -> DataFrame:
    """Some columns of a Parquet table; Spark reads no others. Legacy timestamps keep their written day."""
    return (spark.read.option("int96RebaseMode", "CORRECTED").option("datetimeRebaseMode", "CORRECTED")
            .parquet(path).select(*cols))


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """``(path)`` of the files below ``path``; no content is read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
            .load(path).select("path"))


def _opener():
    """Opens a file by URI on whichever shared file system it lies."""

    def open_file(uri):
        system, path = file_system(uri)
        return system.open_input_file(path)

    return open_file


def parquet_metadata_report(spark: SparkSession, path: str) -> DataFrame:
    """Footer of every Parquet file: one row per file, row group and column.

    The files are dealt over the executors, which read only the footers.
    """
    open_file = _opener()

    def footers(frames):
        import pandas as pd
        import pyarrow.parquet as pq

        for frame in frames:
            for path in frame["path"]:
                with open_file(path) as f:
                    meta = pq.ParquetFile(f).metadata
                rows = []
                for g in range(meta.num_row_groups):
                    group = meta.row_group(g)
                    for c in range(group.num_columns):
                        col = group.column(c)
                        rows.append((path, g, col.path_in_schema, col.compression, col.physical_type, group.num_rows,
                                     col.num_values, col.total_compressed_size))
                yield pd.DataFrame(rows, columns=["file", "row_group", "column", "codec", "type", "num_rows",
                                                  "num_values", "bytes"])

    schema = ("file string, row_group int, column string, codec string, type string, num_rows long, "
              "num_values long, bytes long")
    tasks = spark.sparkContext.defaultParallelism
    return list_files(spark, path, "*.parquet").repartition(tasks, "path").mapInPandas(footers, schema)


def scan_prices(prices: DataFrame, symbols, asof: str, years: int = 1) -> DataFrame:
    """Prices of the listed symbols over the ``years`` before ``asof``."""
    day = F.lit(asof).cast("date")
    return prices.where(F.col("symbol").isin(list(symbols)) & F.col("date").between(F.add_months(day, -12 * years), day))


def scan_ohlcv(bars: DataFrame, symbol: str) -> DataFrame:
    """One symbol's bars in the fixed column order and types."""
    prices = [F.col(c).cast("double").alias(n) for c, n in
              (("close", "adj_close"), ("close", "close"), ("open", "open"), ("high", "high"), ("low", "low"))]
    return bars.where(F.col("symbol") == symbol).select(*prices, "symbol", F.col("volume").cast("long").alias("volume"), "date")


def create_from_columns(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A table from rows held in the program, with an explicit schema."""
    return spark.createDataFrame(rows, schema)


def scan_report(df: DataFrame) -> DataFrame:
    """``(ordinal, name, type, n_rows)`` of a table."""
    columns = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(f.name).alias("name"),
                                 F.lit(f.dataType.simpleString()).alias("type")) for i, f in enumerate(df.schema.fields)])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.explode(columns).alias("c"), "n_rows").select("c.*", "n_rows")
