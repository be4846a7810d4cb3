"""Queries: scans and sinks. Tables are written to a fresh shared folder in the format under test and read back."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalar as sc
from tickloom.operators import nested as ns
from tickloom.plans import base as b
from tickloom.plans import documents as dc
from tickloom.plans.registry import query
from tickloom.session import scratch_path
from tickloom.sources import files as fl
from tickloom.sources import text as tx
from tickloom.sources import zips
from tickloom.sources.zips import file_system

ZIP_MEMBER_LINES = 100_000
# Packed text cannot be split, so a file of documents holds so many at most; a low level packs nearly as well in half the time.
FILE_DOCUMENTS = 250_000
PACKED = {"compression": "gzip", "zlib.compress.level": "THREE"}

NATION = "SELECT n_nationkey, n_name, n_regionkey FROM nation"
NATION_SCHEMA = T.StructType([T.StructField("n_nationkey", T.IntegerType()), T.StructField("n_name", T.StringType()),
                              T.StructField("n_regionkey", T.IntegerType())])
CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER_SCHEMA = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"


def _written_csv(spark, df, label, **options):
    path = scratch_path(spark, label)
    tx.sink_csv(df, path, **options)
    return path


def _written_lines(spark, df, label, **options):
    path = scratch_path(spark, label)
    df.write.options(**options).text(path)
    return path


# inference gives 32-bit integers to columns whose values fit
@query("scan_csv_inferred", "SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def scan_csv_inferred(spark, d):
    return tx.scan_csv_inferred(spark, _written_csv(spark, b.table(spark, d, "customer"), "csv"))


# Fixed value: longest field that this scan accepts.
MAX_CHARS = 20000


@query("scan_delimited_options", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def scan_delimited_options(spark, d):
    part = b.table(spark, d, "part")
    return tx.scan_delimited(spark, _written_csv(spark, part, "tsv", sep="\t"), part.schema, header=True, max_chars=MAX_CHARS)


@query("scan_tsv_fixed_schema", "SELECT c_name AS ticker, CAST(c_custkey AS VARCHAR) AS cik FROM customer")
def scan_tsv_fixed_schema(spark, d):
    pairs = b.table(spark, d, "customer").select("c_name", "c_custkey")
    return tx.scan_delimited(spark, _written_csv(spark, pairs, "tickers", sep="\t", header=False), "ticker string, cik string")


@query("scan_partitioned_union", """SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(quarter(o_orderdate) AS INTEGER) AS quarter, CASE o_orderstatus WHEN 'F' THEN 'sub' WHEN 'O' THEN 'pre' ELSE 'num' END AS tbl FROM orders""")
def scan_partitioned_union(spark, d):
    day = F.col("o_orderdate")
    tbl = F.when(F.col("o_orderstatus") == "F", "sub.txt").when(F.col("o_orderstatus") == "O", "pre.txt").otherwise("num.txt")
    path = scratch_path(spark, "quarters")
    (b.table(spark, d, "orders").select("o_orderkey", "o_totalprice", tbl.alias("tbl"),
                                        F.concat(F.year(day), F.lit("q"), F.quarter(day)).alias("period"))
     .write.partitionBy("period", "tbl").option("sep", "\t").csv(path))
    return tx.scan_quarters(spark, path, "o_orderkey long, o_totalprice double")


@query("scan_quarter_tables", """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS o_orderpriority,
  CASE WHEN o_orderstatus <> 'F' THEN o_totalprice END AS o_totalprice, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN o_custkey END AS o_custkey,
  CAST(year(o_orderdate) AS INTEGER) AS year, CAST(quarter(o_orderdate) AS INTEGER) AS quarter,
  CASE o_orderstatus WHEN 'F' THEN 'sub' WHEN 'O' THEN 'pre' ELSE 'num' END AS tbl FROM orders""")
def scan_quarter_tables(spark, d):
    """Three tables with columns of their own, and a folder that holds no quarter."""
    day, status, path = F.col("o_orderdate"), F.col("o_orderstatus"), scratch_path(spark, "quarter-tables")
    columns = {"sub": ["o_orderkey", "o_orderpriority"], "pre": ["o_orderkey", "o_totalprice"], "num": ["o_orderkey", "o_totalprice", "o_custkey"]}
    rows = {"sub": status == "F", "pre": status == "O", "num": ~status.isin("F", "O")}
    orders = b.table(spark, d, "orders").withColumn("period", F.concat(F.year(day), F.lit("q"), F.quarter(day)))
    for name, cols in columns.items():
        orders.where(rows[name]).select(*cols, "period", F.lit(f"{name}.txt").alias("tbl")).write.mode("append").partitionBy(
            "period", "tbl").option("sep", "\t").csv(path)
    orders.select("o_orderpriority").write.text(f"{path}/notes")
    types = {"o_orderkey": "long", "o_orderpriority": "string", "o_totalprice": "double", "o_custkey": "long"}
    return tx.scan_quarter_tables(spark, path, {t: ", ".join(f"{c} {types[c]}" for c in cols) for t, cols in columns.items()})


def _zip_orders(spark, d):
    """The orders as zip archives, one per input split, with members by year and one that leads outside.

    Lines are streamed: a split writes a member whenever it holds ``ZIP_MEMBER_LINES`` lines of a year, so nothing grows
    with the split.
    """
    path = scratch_path(spark, "zips")

    def pack(frames):
        import os
        import zipfile

        import pandas as pd
        from pyspark import TaskContext

        system, base = file_system(path)
        system.create_dir(base, recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.zip"
        held, written = {}, 0
        with system.open_output_stream(f"{base}/{name}") as out, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:

            def flush(year):
                z.writestr(f"{year}/sub-{written}.txt", "".join(line + "\n" for line in held.pop(year)))
                return written + 1

            for frame in frames:
                for year, rows in frame.groupby("year"):
                    held.setdefault(year, []).extend(rows["line"])
                    if len(held[year]) >= ZIP_MEMBER_LINES:
                        written = flush(year)
            for year in list(held):
                written = flush(year)
            z.writestr(os.path.join("..", "outside.txt"), "never read\n")
        yield pd.DataFrame({"name": [name]})

    line = F.concat_ws("\t", "o_orderkey", "o_orderstatus")
    orders = b.table(spark, d, "orders").select(F.year("o_orderdate").alias("year"), line.alias("line"))
    orders.mapInPandas(pack, "name string").write.format("noop").mode("overwrite").save()
    return path


@query("scan_zip_members", "SELECT CAST(year(o_orderdate) AS VARCHAR) || '/sub.txt' AS member, o_orderkey, o_orderstatus FROM orders")
def scan_zip_members(spark, d):
    lines = zips.scan_zip_members(spark, _zip_orders(spark, d))
    parts = F.split("line", "\t")
    return lines.select(F.regexp_replace("member", r"/sub-\d+", "/sub").alias("member"), parts[0].cast("long").alias("o_orderkey"), parts[1].alias("o_orderstatus"))


@query("scan_json_document", f"""SELECT CAST(l_partkey AS VARCHAR) AS cik, 'Supplier ' || CAST(l_suppkey AS VARCHAR) AS "entityName",
  CASE WHEN l_discount > 0 THEN l_linenumber END AS n_usd FROM lineitem""")
def scan_json_document(spark, d):
    path = _written_lines(spark, dc.documents(spark, d).select("text"), "json", maxRecordsPerFile=FILE_DOCUMENTS, **PACKED)
    usd = F.col("units")["USD"]
    docs = tx.scan_json_documents(spark, path, ns.DOCUMENT_SCHEMA)
    return docs.select("cik", "entityName", F.when(usd.isNotNull(), F.size(usd)).alias("n_usd"))


@query("scan_prices", f"""WITH {b.PX} SELECT date, symbol, price FROM px WHERE symbol IN ('1-URGENT', '3-MEDIUM', '5-LOW')
  AND date BETWEEN DATE '1999-08-01' AND DATE '2001-08-01'""")
def scan_prices(spark, d):
    return fl.scan_prices(b.order_prices(spark, d), ["1-URGENT", "3-MEDIUM", "5-LOW"], "2001-08-01", 2)


@query("scan_ohlcv", f"""WITH {b.BARS} SELECT close AS adj_close, close, open, high, low, symbol, volume, date
  FROM bars WHERE symbol = '2-HIGH'""")
def scan_ohlcv(spark, d):
    return fl.scan_ohlcv(b.bars(spark, d), "2-HIGH")


@query("sink_parquet_gzip", CUSTOMER)
def sink_parquet_gzip(spark, d):
    path = scratch_path(spark, "gzip")
    fl.sink_parquet_gzip(b.table(spark, d, "customer"), path)
    return spark.read.parquet(path)


@query("scan_parquet_projected", "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem")
def scan_parquet_projected(spark, d):
    return fl.scan_parquet_projected(spark, f"{d}/lineitem.parquet", ["l_orderkey", "l_quantity", "l_shipdate"])


TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


@query("parquet_metadata_report", " UNION ALL ".join(f"SELECT '{t}' AS tbl, count(*) AS n_rows FROM {t}" for t in TABLES))
def parquet_metadata_report(spark, d):
    report = fl.parquet_metadata_report(spark, d)
    groups = report.groupBy("file", "row_group").agg(F.max("num_rows").alias("n"))
    return groups.groupBy(F.regexp_extract("file", r"([^/]+)\.parquet", 1).alias("tbl")).agg(F.sum("n").alias("n_rows"))


@query("sink_csv", CUSTOMER)
def sink_csv(spark, d):
    path = _written_csv(spark, b.table(spark, d, "customer"), "sink")
    return tx.scan_delimited(spark, path, CUSTOMER_SCHEMA, sep=",", header=True)


@query("render_delimited_row", """SELECT n_nationkey, concat_ws(chr(9), CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR)) AS line
FROM nation""")
def render_delimited_row(spark, d):
    return b.table(spark, d, "nation").select("n_nationkey", tx.render_row("n_nationkey", "n_name", "n_regionkey").alias("line"))


@query("create_from_columns", """SELECT r_name, w.code, w.first, w.n FROM region
JOIN (VALUES (0, 'AF', 0.5::DOUBLE, 2), (1, 'AM', 1.5::DOUBLE, 1)) w(k, code, first, n) ON w.k = r_regionkey""")
def create_from_columns(spark, d):
    codes = fl.create_from_columns(spark, [(0, "AF", [0.5, 1.0]), (1, "AM", [1.5])], "k int, code string, weights array<double>")
    region = b.table(spark, d, "region")
    return region.join(codes, region["r_regionkey"] == codes["k"]).select(
        "r_name", "code", F.col("weights")[0].alias("first"), F.size("weights").alias("n"))


LINEITEM_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
                  ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
                  ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@query("scan_report", "SELECT v.*, n.n_rows FROM (VALUES " + ", ".join(
    f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(LINEITEM_TYPES)
) + ") v(ordinal, name, type), (SELECT count(*) AS n_rows FROM lineitem) n")
def scan_report(spark, d):
    return fl.scan_report(b.table(spark, d, "lineitem"))


def _nation_text(spark, d):
    return b.table(spark, d, "nation").withColumn("line", F.concat_ws(",", "n_nationkey", "n_name", "n_regionkey"))


@query("scan_csv_comments", CUSTOMER)
def scan_csv_comments(spark, d):
    c = b.table(spark, d, "customer")
    line = F.to_csv(F.struct(*[F.col(x) for x in c.columns]))
    with_notes = c.select(F.explode(F.array(F.lit("# a note"), line)).alias("value"))
    return tx.scan_delimited(spark, _written_lines(spark, with_notes, "comments"), CUSTOMER_SCHEMA, sep=",", comment="#")


@query("scan_csv_line_sep", CUSTOMER)
def scan_csv_line_sep(spark, d):
    path = _written_csv(spark, b.table(spark, d, "customer"), "linesep", header=False, lineSep="~")
    return tx.scan_delimited(spark, path, CUSTOMER_SCHEMA, sep=",", lineSep="~")


def _ragged(spark, d):
    """Nations whose row lacks its last field when the region is 1, has one more when it is 2, and an empty
    line after every row."""
    line = (F.when(F.col("n_regionkey") == 1, F.concat_ws(",", "n_nationkey", "n_name"))
            .when(F.col("n_regionkey") == 2, F.concat_ws(",", "line", F.lit("more"))).otherwise(F.col("line")))
    lines = _nation_text(spark, d).select(F.explode(F.array(line, F.lit(""))).alias("value"))
    return _written_lines(spark, lines, "ragged")


@query("scan_csv_ragged", "SELECT n_nationkey, n_name, CASE WHEN n_regionkey <> 1 THEN n_regionkey END AS n_regionkey FROM nation")
def scan_csv_ragged(spark, d):
    return tx.scan_delimited(spark, _ragged(spark, d), NATION_SCHEMA, sep=",")


@query("scan_csv_strict", """SELECT n_nationkey, CASE n_regionkey WHEN 1 THEN n_nationkey || ',' || n_name
  WHEN 2 THEN n_nationkey || ',' || n_name || ',' || n_regionkey || ',more' END AS corrupt FROM nation""")
def scan_csv_strict(spark, d):
    return tx.scan_csv_strict(spark, _ragged(spark, d), NATION_SCHEMA).select(
        "n_nationkey", F.col("_corrupt_record").alias("corrupt"))


@query("scan_csv_missing_token", f"""WITH {b.WIDE_PX} SELECT date, p1, p2, p3, p4, p5 FROM wpx""")
def scan_csv_missing_token(spark, d):
    path = _written_csv(spark, b.wide_prices(spark, d), "missing", nullValue="-")
    schema = "date date, p1 double, p2 double, p3 double, p4 double, p5 double"
    return tx.scan_delimited(spark, path, schema, sep=",", header=True, nullValue="-")


@query("scan_csv_headerless", CUSTOMER)
def scan_csv_headerless(spark, d):
    path = _written_csv(spark, b.table(spark, d, "customer"), "headerless", header=False)
    return tx.scan_delimited(spark, path, CUSTOMER_SCHEMA, sep=",")


@query("scan_csv_bom", "SELECT CAST(c_custkey AS INTEGER) AS key, c_name AS name FROM customer")
def scan_csv_bom(spark, d):
    marked = b.table(spark, d, "customer").select(F.col("c_custkey").alias("﻿key"), F.col("c_name").alias("name"))
    return tx.scan_csv_inferred(spark, _written_csv(spark, marked, "bom"))


@query("scan_csv_zero_width", "SELECT CAST(c_custkey AS INTEGER) AS key, c_name AS name FROM customer")
def scan_csv_zero_width(spark, d):
    marked = b.table(spark, d, "customer").select(F.col("c_custkey").alias("​key"), F.col("c_name").alias("name"))
    return tx.scan_csv_inferred(spark, _written_csv(spark, marked, "zero-width"))


@query("scan_csv_date_formats", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS dotted FROM orders")
def scan_csv_date_formats(spark, d):
    dates = b.table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("dotted"))
    path = _written_csv(spark, dates, "dates", dateFormat="yyyy.MM.dd")
    return tx.scan_delimited(spark, path, "o_orderkey long, dotted date", sep=",", header=True, dateFormat="yyyy.MM.dd")


@query("scan_csv_short_and_iso_dates", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS short, CAST(o_orderdate AS DATE) AS iso FROM orders""")
def scan_csv_short_and_iso_dates(spark, d):
    """Month, day and year of two digits, and ISO dates, through one scan; the century follows from the date given."""
    dates = b.table(spark, d, "orders").select("o_orderkey", F.date_format("o_orderdate", "M/d/yy").alias("short"),
                                               F.to_date("o_orderdate").alias("iso"))
    scanned = tx.scan_delimited(spark, _written_csv(spark, dates, "short-dates"), "o_orderkey long, short string, iso date", sep=",", header=True)
    return scanned.withColumn("short", sc.two_digit_year_date(F.col("short"), "M/d/yy", "2001-12-31"))


@query("scan_fixed_width", """SELECT s_suppkey AS key, CASE WHEN s_nationkey <> 3 THEN s_name END AS name,
  CASE WHEN s_nationkey <> 4 THEN s_nationkey END AS nation, s_nationkey = 4 AS wrong FROM supplier""")
def scan_fixed_width(spark, d):
    """Nation 3 has the missing token as name; lines of nation 4 end before their last field."""
    name = F.when(F.col("s_nationkey") == 3, "null").otherwise(F.col("s_name"))
    line = F.concat(F.rpad(F.col("s_suppkey").cast("string"), 12, "_"), F.rpad(name, 30, "_"),
                    F.when(F.col("s_nationkey") == 4, "").otherwise(F.rpad(F.col("s_nationkey").cast("string"), 8, "_")))
    path = _written_lines(spark, b.table(spark, d, "supplier").select(line.alias("value")), "fixed")
    out = tx.scan_fixed_width(spark, path, [("key", 12, "bigint"), ("name", 30, "string"), ("nation", 8, "int")])
    return out.withColumnRenamed("_wrong_length", "wrong")
