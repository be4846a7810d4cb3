"""Base relations the queries share, in Spark and (as CTE text) in SQL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import materialize

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAGS = ["A", "N", "R"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_prices(spark, sf_dir) -> DataFrame:
    """One price per day and order priority: the total of the day's last order. Many real gaps.

    The orders scan shrinks to one row per (day, priority) by partial aggregation; the result is
    written once because alignment reads it for dates, symbols and values.
    """
    o = table(spark, sf_dir, "orders")
    px = o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("symbol")).agg(
        F.max_by("o_totalprice", "o_orderkey").alias("price"))
    return materialize(px, "order_prices")


PX = """px AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, arg_max(o_totalprice, o_orderkey) AS price
  FROM orders GROUP BY ALL)"""


def flag_prices(spark, sf_dir) -> DataFrame:
    """Highest line price per ship day and return flag: three symbols, few gaps."""
    li = table(spark, sf_dir, "lineitem")
    px = li.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("symbol")).agg(
        F.max("l_extendedprice").alias("price"))
    return materialize(px, "flag_prices")


FLAG_PX = """px AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS symbol, max(l_extendedprice) AS price
  FROM lineitem GROUP BY ALL)"""


def supplier_prices(spark, sf_dir) -> DataFrame:
    """Highest line price per ship day and supplier: as many symbols as suppliers, many gaps."""
    li = table(spark, sf_dir, "lineitem")
    px = li.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_suppkey").alias("symbol")).agg(
        F.max("l_extendedprice").alias("price"))
    return materialize(px, "supplier_prices")


SUPPLIER_PX = """px AS (
  SELECT CAST(l_shipdate AS DATE) AS date, l_suppkey AS symbol, max(l_extendedprice) AS price
  FROM lineitem GROUP BY ALL)"""

# px aligned on the shared calendar; t is the calendar position
PXA = """cal AS (SELECT date, row_number() OVER (ORDER BY date) - 1 AS t FROM (SELECT DISTINCT date FROM px)),
pxa AS (
  SELECT c.date, c.t, s.symbol, p.price
  FROM cal c CROSS JOIN (SELECT DISTINCT symbol FROM px) s
  LEFT JOIN px p ON p.date = c.date AND p.symbol = s.symbol)"""


def event_prices(spark, sf_dir) -> DataFrame:
    """Mean event value per day and event type: no gaps."""
    ev = table(spark, sf_dir, "events")
    px = ev.groupBy(F.to_date("ts").alias("date"), F.col("event_type").alias("symbol")).agg(
        F.max_by("value", "event_id").alias("price"))
    return materialize(px, "event_prices")


EVENT_PX = """px AS (
  SELECT CAST(ts AS DATE) AS date, event_type AS symbol, arg_max(value, event_id) AS price
  FROM events GROUP BY ALL)"""


def wide_prices(spark, sf_dir) -> DataFrame:
    """Order prices with one column per priority, one row per date."""
    o = table(spark, sf_dir, "orders")
    cols = [F.max_by(F.when(F.col("o_orderpriority") == p, F.col("o_totalprice")),
                     F.when(F.col("o_orderpriority") == p, F.col("o_orderkey"))).alias(f"p{p[0]}") for p in PRIORITIES]
    return o.groupBy(F.to_date("o_orderdate").alias("date")).agg(*cols)


WIDE_PX = "wpx AS (SELECT CAST(o_orderdate AS DATE) AS date, " + ", ".join(
    f"arg_max(o_totalprice, o_orderkey) FILTER (o_orderpriority = '{p}') AS p{p[0]}" for p in PRIORITIES
) + " FROM orders GROUP BY 1)"


def bars(spark, sf_dir) -> DataFrame:
    """Open, high, low, close and volume per day and order priority."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("symbol")).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"), F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"), F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"))


BARS = """bars AS (
  SELECT CAST(o_orderdate AS DATE) AS date, o_orderpriority AS symbol, arg_min(o_totalprice, o_orderkey) AS open,
         max(o_totalprice) AS high, min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
         count(*) AS volume
  FROM orders GROUP BY ALL)"""


def allocations(spark, sf_dir) -> DataFrame:
    """One portfolio per supplier over the three return flags, weights adding up to 1."""
    key = F.col("s_suppkey")
    parts = [1 + key % 5, 1 + key % 7, 1 + key % 3]
    total = parts[0] + parts[1] + parts[2]
    held = F.explode(F.array(*[F.struct(F.lit(f).alias("symbol"), (p / total).alias("w"))
                               for f, p in zip(FLAGS, parts)])).alias("h")
    return table(spark, sf_dir, "supplier").select(key.alias("portfolio_id"), held).select("portfolio_id", "h.*")


ALLOC = """alloc AS (
  SELECT s_suppkey AS portfolio_id, u.symbol,
         u.part / CAST((1 + s_suppkey % 5) + (1 + s_suppkey % 7) + (1 + s_suppkey % 3) AS DOUBLE) AS w
  FROM supplier, LATERAL (VALUES ('A', 1 + s_suppkey % 5), ('N', 1 + s_suppkey % 7), ('R', 1 + s_suppkey % 3)) u(symbol, part))"""


def month_counts(spark, sf_dir) -> DataFrame:
    """Line counts by ship month, one column per return flag and line status."""
    li = table(spark, sf_dir, "lineitem")
    combos = [f"{f}_{s}" for f in FLAGS for s in ("F", "O")]
    return (li.groupBy(F.to_date(F.date_trunc("month", "l_shipdate")).alias("month"))
            .agg(*[F.count(F.when(F.concat_ws("_", "l_returnflag", "l_linestatus") == c, 1)).alias(c) for c in combos]))


WIDE_COLS = [f"{f}_{s}" for f in FLAGS for s in ("F", "O")]
WIDE = "wide AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, " + ", ".join(
    f"count(*) FILTER (l_returnflag || '_' || l_linestatus = '{c}') AS {c}" for c in WIDE_COLS
) + " FROM lineitem GROUP BY 1)"


def vector_cells(spark, sf_dir) -> DataFrame:
    """The embeddings as matrix cells ``(i, j, v)``."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("i"), F.posexplode("embedding").alias("j", "v")).select(
        "i", F.col("j").cast("long").alias("j"), F.col("v").cast("double").alias("v"))


VEC = """vec AS (
  SELECT vec_id AS i, j - 1 AS j, CAST(embedding[j] AS DOUBLE) AS v
  FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS j FROM embeddings))"""


def rounded(df: DataFrame, *cols, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})
