"""Steps that several operators share."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.skew import fits_broadcast

SPACE_RUN = r"[\x20\x09-\x0D]+"
SMALL_BYTES = 24 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lookup(rows: DataFrame, table: DataFrame, on, how: str = "left") -> DataFrame:
    """Join ``rows`` with a written ``table`` that has one row per key.

    The table is sent to all executors when its measured size is at most ``SMALL_BYTES``. Beyond that both
    sides are shuffled by the key; only ``rows`` can hold a hot key then, and the adaptive skew join, which
    may split the left side of these joins, deals its rows over several tasks.
    """
    return rows.join(F.broadcast(table) if fits_broadcast(table, SMALL_BYTES) else table, on, how)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, upper, upper.lower())


BATCH_ROWS = 1_000


def over_texts(df: DataFrame, fn, schema) -> DataFrame:
    """``df.mapInArrow(fn, schema)`` for rows that hold texts or sets.

    Such rows are long, so the session's batches are lowered to ``BATCH_ROWS`` rows; the default of 10,000 would hold
    tens of megabytes several times over in each task. The setting only changes how many rows are handed over at once.
    """
    conf = df.sparkSession.conf
    rows = int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if rows <= 0 or rows > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)
