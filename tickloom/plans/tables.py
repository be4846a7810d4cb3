"""Queries: projections, row access, aggregates, sorting, reshaping, scalar functions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import scalar as sc
from tickloom.operators import aggregates as ag
from tickloom.operators import reshape as rs
from tickloom.operators import rows as rw
from tickloom.plans import base as b
from tickloom.plans.registry import query
from tickloom.session import materialize

P = [f"p{i}" for i in range(1, 6)]

# --- projections and row access


@query("select_drop", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def select_drop(spark, d):
    return rw.select_drop(b.table(spark, d, "orders"), keep=["o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"],
                          drop=["o_orderstatus"])


@query("rename_columns", f"""WITH {b.WIDE} SELECT month AS "date.entered", A_F AS af, A_O, N_F, N_O, R_F, R_O FROM wide""")
def rename_columns(spark, d):
    dotted = rw.rename_columns(b.month_counts(spark, d), {"month": "m.first"})
    return rw.rename_columns(dotted, {"m.first": "date.entered", "A_F": "af"})


@query("reorder_columns", f"WITH {b.WIDE_PX} SELECT date, p5, p4, p3, p2, p1 FROM wpx")
def reorder_columns(spark, d):
    backwards = b.wide_prices(spark, d).select(*reversed(P), "date")
    return rw.reorder_columns(backwards, ["date"])


@query("add_constant_column", "SELECT n_nationkey, n_name, n_regionkey, 'USD' AS type FROM nation")
def add_constant_column(spark, d):
    return rw.add_constant_column(b.table(spark, d, "nation"), "type", "USD")


@query("column_arithmetic", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ROUND(l_extendedprice + l_tax, 6) AS added, ROUND(l_extendedprice - 100, 6) AS subtracted,
  ROUND(l_extendedprice * l_discount, 6) AS multiplied, ROUND(l_extendedprice / NULLIF(l_discount, 0), 6) AS divided,
  ROUND(POW(1 + l_tax, -1.0), 6) AS powered, ABS(l_quantity - 25) AS absolute FROM lineitem""")
def column_arithmetic(spark, d):
    price, disc, tax = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_tax")
    return b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.round(price + tax, 6).alias("added"),
        F.round(price - 100, 6).alias("subtracted"), F.round(price * disc, 6).alias("multiplied"),
        F.round(F.try_divide(price, disc), 6).alias("divided"), F.round(F.pow(1 + tax, F.lit(-1.0)), 6).alias("powered"),
        F.abs(F.col("l_quantity") - 25).alias("absolute"))


@query("lookup_first_or_error", "SELECT c_custkey, c_name FROM customer WHERE c_name = 'Customer#000000042'")
def lookup_first_or_error(spark, d):
    c = b.table(spark, d, "customer").select("c_custkey", "c_name")
    return rw.lookup_first_or_error(c, F.col("c_name") == "Customer#000000042", "Invalid Ticker", ["c_custkey"])


@query("row_range_slice", f"""WITH {b.PX} SELECT date, symbol, price FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos FROM px) WHERE pos >= 1 AND pos < 50""")
def row_range_slice(spark, d):
    return rw.row_range_slice(b.order_prices(spark, d), ["date"], 1, 50, key_cols=["symbol"])


@query("row_range_slice_global", """SELECT o_orderkey, o_totalprice FROM (
  SELECT *, row_number() OVER (ORDER BY o_totalprice, o_orderkey) - 1 AS pos FROM orders) WHERE pos >= 100 AND pos < 1100""")
def row_range_slice_global(spark, d):
    o = b.table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return rw.row_range_slice(o, ["o_totalprice", "o_orderkey"], 100, 1100)


@query("cell_at", f"""WITH {b.PX} SELECT symbol, price FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY date) - 1 AS pos FROM px) WHERE pos = 7""")
def cell_at(spark, d):
    return rw.cell_at(b.order_prices(spark, d), ["date"], 7, "price", key_cols=["symbol"])


@query("columns_by_predicate", f"WITH {b.WIDE} SELECT {', '.join(c for c in b.WIDE_COLS if c != 'R_O')}, month FROM wide")
def columns_by_predicate(spark, d):
    wide = b.month_counts(spark, d)
    return wide.select(*rw.columns_except(wide, "r_o"))


@query("assemble_disassemble", f"WITH {b.WIDE_PX} SELECT date, {', '.join(P)} FROM wpx")
def assemble_disassemble(spark, d):
    return rw.disassemble(rw.assemble(b.wide_prices(spark, d), P), P)


@query("row_index", """SELECT event_id, user_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def row_index(spark, d):
    ev = b.table(spark, d, "events").select("event_id", "user_id", "ts")
    return rw.row_positions(ev, ["ts", "event_id"]).drop("ts")


@query("row_index_null_key", """SELECT event_id, CASE WHEN event_type <> 'click' THEN user_id END AS user_id,
  row_number() OVER (PARTITION BY CASE WHEN event_type <> 'click' THEN user_id END ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def row_index_null_key(spark, d):
    """The clicks have no key; together they are one."""
    user = F.when(F.col("event_type") != "click", F.col("user_id")).alias("user_id")
    ev = b.table(spark, d, "events").select("event_id", user, "ts")
    return rw.row_positions(ev, ["ts", "event_id"], key_cols=["user_id"]).drop("ts")


@query("row_index_by_key", """SELECT event_id, user_id,
  row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS row_index FROM events""")
def row_index_by_key(spark, d):
    ev = b.table(spark, d, "events").select("event_id", "user_id", "ts")
    return rw.row_positions(ev, ["ts", "event_id"], key_cols=["user_id"]).drop("ts")


# --- aggregates

@query("col_means", f"WITH {b.WIDE_PX} SELECT {', '.join(f'ROUND(avg({c}), 4) AS {c}' for c in P)} FROM wpx")
def col_means(spark, d):
    return b.rounded(ag.col_means(b.wide_prices(spark, d), P), *P, digits=4)


@query("col_sds", f"WITH {b.WIDE_PX} SELECT {', '.join(f'ROUND(stddev_samp({c}), 4) AS {c}' for c in P)} FROM wpx")
def col_sds(spark, d):
    return b.rounded(ag.col_sds(b.wide_prices(spark, d), P), *P, digits=4)


@query("col_sds_population", f"WITH {b.WIDE_PX} SELECT {', '.join(f'ROUND(stddev_pop({c}), 4) AS {c}' for c in P)} FROM wpx")
def col_sds_population(spark, d):
    return b.rounded(ag.col_sds(b.wide_prices(spark, d), P, ddof=0), *P, digits=4)


@query("row_sums", f"WITH {b.WIDE_PX} SELECT date, ROUND({' + '.join(P)}, 6) AS row_sum FROM wpx")
def row_sums(spark, d):
    return b.rounded(ag.row_sums(b.wide_prices(spark, d), P).select("date", "row_sum"), "row_sum")


@query("first_last_row", f"""WITH {b.PX} SELECT symbol, min(date) AS first_date, arg_min(price, date) AS first_price,
  max(date) AS last_date, arg_max(price, date) AS last_price FROM px GROUP BY symbol""")
def first_last_row(spark, d):
    return ag.first_last_row(b.order_prices(spark, d), "date", ["date", "price"], ["symbol"])


@query("mean_variance", "SELECT ROUND(avg(value), 6) AS mean, ROUND(var_pop(value), 6) AS variance FROM events")
def mean_variance(spark, d):
    return b.rounded(ag.mean_variance(b.table(spark, d, "events"), "value"), "mean", "variance")


@query("collect_flatten", f"""WITH {b.VEC}, ranked AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings)
SELECT r * 64 + j AS pos, v FROM vec JOIN ranked ON vec_id = i""")
def collect_flatten(spark, d):
    flat = ag.collect_flatten(b.table(spark, d, "embeddings"), "vec_id", "embedding", 64)
    return flat.withColumn("v", F.col("v").cast("double"))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark, d):
    return ag.row_count(b.table(spark, d, "lineitem"))


# --- sort, limit, union

@query("limit_head", "SELECT n_nationkey, n_name FROM nation ORDER BY n_nationkey LIMIT 5")
def limit_head(spark, d):
    return rw.limit_head(b.table(spark, d, "nation").select("n_nationkey", "n_name"), 5, ["n_nationkey"])


@query("tail_n", f"WITH {b.PX} SELECT date, symbol, price FROM px ORDER BY date DESC, symbol DESC LIMIT 3")
def tail_n(spark, d):
    return rw.tail_n(b.order_prices(spark, d), 3, ["date", "symbol"])


@query("top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def top_n(spark, d):
    return rw.top_n(b.table(spark, d, "orders").select("o_orderkey", "o_totalprice"), 10, "o_totalprice", ["o_orderkey"])


@query("sort_multi", """SELECT c_custkey, c_nationkey, c_acctbal,
  row_number() OVER (ORDER BY c_nationkey, c_acctbal DESC, c_custkey) - 1 AS place FROM customer""")
def sort_multi(spark, d):
    c = b.table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    ordered = rw.sort_multi(c, F.asc("c_nationkey"), F.desc("c_acctbal"), tie_cols=["c_custkey"])
    # the row number that the sorted output gives makes the order itself part of the compared result
    numbered = materialize(ordered.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    return rw.row_positions(numbered, ["_at"], name="place").drop("_at")


@query("union_all", f"WITH {b.PX} SELECT date, symbol, price FROM px")
def union_all(spark, d):
    px = b.order_prices(spark, d)
    return rw.union_all([px.where(F.col("symbol") == p) for p in b.PRIORITIES])


# --- melt

MELT = " UNION ALL ".join(f"SELECT month, '{c}' AS variable, {c} AS value FROM wide" for c in b.WIDE_COLS)
SUBSET = ["A_F", "N_F", "R_F"]
MELT_SUBSET = " UNION ALL ".join(
    f"SELECT month, '{c}' AS variable, CAST({c} AS DOUBLE) AS value FROM wide" for c in SUBSET)


@query("melt_all", f"WITH {b.WIDE} {MELT}")
def melt_all(spark, d):
    return rs.melt_all(b.month_counts(spark, d), ["month"])


@query("melt_subset", f"WITH {b.WIDE} {MELT_SUBSET}")
def melt_subset(spark, d):
    return rs.melt_subset(b.month_counts(spark, d), ["month"], SUBSET)


@query("melt_drop_missing", f"WITH {b.WIDE_PX} " + " UNION ALL ".join(
    f"SELECT date, '{c}' AS variable, {c} AS value FROM wpx WHERE {c} IS NOT NULL" for c in P))
def melt_drop_missing(spark, d):
    return rs.melt_subset(b.wide_prices(spark, d), ["date"], P, drop_missing=True)


@query("melt_clean", f"WITH {b.WIDE_PX} " + " UNION ALL ".join(
    f"SELECT date, '{c[1:]}' AS week, {c} AS rank FROM wpx" for c in P))
def melt_clean(spark, d):
    return rs.melt_clean(b.wide_prices(spark, d), ["date"], P, variable="week", value="rank", strip="p")


@query("melt_by_column_union", f"WITH {b.WIDE} {MELT_SUBSET}")
def melt_by_column_union(spark, d):
    return rs.melt_by_column_union(b.month_counts(spark, d), ["month"], SUBSET)


# --- scalar functions

@query("string_replace", "SELECT c_custkey, replace(c_name, 'Customer#', '') AS bare FROM customer")
def string_replace(spark, d):
    return b.table(spark, d, "customer").select("c_custkey", F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("bare"))


@query("left_pad_id", """SELECT p_partkey, p_retailprice,
  CASE WHEN length(id) < 10 THEN lpad(id, 10, '0') ELSE id END AS id10,
  CASE WHEN length(id) < 3 THEN lpad(id, 3, '0') ELSE id END AS id3
FROM (SELECT p_partkey, p_retailprice, CAST(p_partkey AS VARCHAR) AS id FROM part)""")
def left_pad_id(spark, d):
    key = F.col("p_partkey").cast("string")
    return b.table(spark, d, "part").select("p_partkey", "p_retailprice", sc.left_pad_id(key).alias("id10"),
                                            sc.left_pad_id(key, 3).alias("id3"))


@query("upper_case", "SELECT p_partkey, upper(p_name) AS name, lower(p_type) <> lower('Economy') AS other FROM part")
def upper_case(spark, d):
    return b.table(spark, d, "part").select("p_partkey", F.upper("p_name").alias("name"),
                                            sc.ci_not_equal(F.col("p_type"), F.lit("Economy")).alias("other"))


@query("join_strings", "SELECT n_nationkey, concat_ws(', ', n_name, CAST(n_regionkey AS VARCHAR)) AS joined FROM nation")
def join_strings(spark, d):
    return b.table(spark, d, "nation").select("n_nationkey", sc.join_strings(F.col("n_name"), F.col("n_regionkey")).alias("joined"))


@query("iso_date_parse", "SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') AS DATE) AS day FROM orders")
def iso_date_parse(spark, d):
    return b.table(spark, d, "orders").select("o_orderkey", sc.iso_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))


@query("epoch_day_date", """SELECT o_orderkey, CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days,
  CAST(o_orderdate AS DATE) AS day FROM orders""")
def epoch_day_date(spark, d):
    days = F.unix_date(F.to_date("o_orderdate"))
    return b.table(spark, d, "orders").select("o_orderkey", days.cast("long").alias("days"), sc.date_from_days(days).alias("day"))


@query("epoch_millis_ts", """SELECT event_id, CAST(date_trunc('milliseconds', ts) AS TIMESTAMP) AS from_millis,
  CAST(date_trunc('second', ts) AS TIMESTAMP) AS from_seconds FROM events""")
def epoch_millis_ts(spark, d):
    utc = F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")
    out = b.table(spark, d, "events").select(
        "event_id", F.timestamp_millis(F.unix_millis(utc)).alias("from_millis"),
        F.timestamp_seconds(F.unix_seconds(utc)).alias("from_seconds"))
    return out.select("event_id", *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("from_millis", "from_seconds")])


@query("local_date_in_zone", """SELECT event_id, CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) AS new_york,
  CAST(ts AT TIME ZONE 'UTC' AT TIME ZONE 'Asia/Tokyo' AS DATE) AS tokyo FROM events""")
def local_date_in_zone(spark, d):
    ts = F.col("ts")
    return b.table(spark, d, "events").select("event_id", sc.local_date_in_zone(ts, "America/New_York").alias("new_york"),
                                              sc.local_date_in_zone(ts, "Asia/Tokyo").alias("tokyo"))


@query("minus_years", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 3 YEAR AS DATE) AS earlier FROM orders")
def minus_years(spark, d):
    return b.table(spark, d, "orders").select("o_orderkey", sc.minus_years(F.to_date("o_orderdate"), 3).alias("earlier"))


@query("decimal_half_up", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST(floor(l_extendedprice * 100) / 1000 AS DECIMAL(18,3)) AS third,
  CAST(CAST(floor(l_extendedprice * 100) / 1000 AS DECIMAL(18,3)) AS DECIMAL(18,2)) AS half_up FROM lineitem""")
def decimal_half_up(spark, d):
    tenth = F.floor(F.col("l_extendedprice") * 100) / 1000
    return b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", sc.to_decimal(tenth, 18, 3).alias("third"),
        sc.to_decimal(tenth, 18, 2).alias("half_up"))


@query("pow_sqrt_abs", """SELECT event_id, CASE WHEN value <> 0 THEN ROUND(pow(value, -1.0), 9) END AS inverse, ROUND(pow(abs(value), 0.5), 6) AS root,
  ROUND(sqrt(abs(value)), 6) AS root2, abs(value) AS size FROM events""")
def pow_sqrt_abs(spark, d):
    v = F.col("value")
    return b.table(spark, d, "events").select(
        "event_id", F.when(v != 0, F.round(F.pow(v, F.lit(-1.0)), 9)).alias("inverse"), F.round(F.pow(F.abs(v), F.lit(0.5)), 6).alias("root"),
        F.round(F.sqrt(F.abs(v)), 6).alias("root2"), F.abs(v).alias("size"))


@query("two_digit_year_date", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders")
def two_digit_year_date(spark, d):
    text = F.date_format("o_orderdate", "M/d/yy")
    return b.table(spark, d, "orders").select("o_orderkey", sc.two_digit_year_date(text, "M/d/yy", "2001-12-31").alias("day"))


SQL_TYPES = {"timestamp": "TIMESTAMPTZ", "string": "VARCHAR", "binary": "BLOB"}


@query("null_value_by_type", "SELECT n_nationkey, " + ", ".join(
    f"CAST(NULL AS {SQL_TYPES.get(t, t)}) AS {n.lower()}" for n, t in sc.TYPE_NAMES.items()) + " FROM nation")
def null_value_by_type(spark, d):
    return b.table(spark, d, "nation").select("n_nationkey", *[sc.null_value(n).alias(n.lower()) for n in sc.TYPE_NAMES])


@query("set_scalar_value", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity > 25 AS bit,
  CAST(trunc(l_extendedprice) AS INTEGER) AS int, CAST(l_linenumber AS TINYINT) AS tinyint,
  CAST(l_linenumber AS SMALLINT) AS uint1, l_orderkey AS bigint, CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS float4,
  CAST(l_shipdate AS DATE) AS dateday, CAST(l_extendedprice AS DECIMAL(18,1)) AS decimal,
  CAST(l_suppkey AS VARCHAR) AS varchar FROM lineitem""")
def set_scalar_value(spark, d):
    double, long, integer = T.DoubleType(), T.LongType(), T.IntegerType()
    c = F.col
    return b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        sc.coerce(c("l_quantity") - 25, double, T.BooleanType()).alias("bit"),
        sc.coerce(c("l_extendedprice"), double, integer).alias("int"),
        sc.coerce(c("l_linenumber"), integer, T.ByteType()).alias("tinyint"),
        sc.coerce(c("l_linenumber"), integer, T.ShortType()).alias("uint1"),
        sc.coerce(c("l_orderkey"), long, long).alias("bigint"),
        sc.coerce(c("l_discount"), double, T.FloatType()).cast("double").alias("float4"),
        sc.coerce(F.unix_date(F.to_date("l_shipdate")), integer, T.DateType()).alias("dateday"),
        sc.coerce(c("l_extendedprice"), double, T.DecimalType(18, 1)).alias("decimal"),
        sc.coerce(c("l_suppkey"), long, T.StringType()).alias("varchar"))


@query("write_value_by_type_name", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  epoch_ms(l_orderkey * 86400007) AS timestampmillitz, epoch_ms(l_partkey * 997) AS datemilli,
  DATE '1970-01-01' + CAST(l_linenumber * 1000 AS INTEGER) AS dateday, CAST(l_linenumber AS DOUBLE) AS float8,
  CAST(CAST(l_discount AS FLOAT) AS DOUBLE) AS float4, CAST(trunc(l_extendedprice) AS INTEGER) AS int, l_orderkey * 3000000019 AS bigint,
  CAST(l_linenumber AS TINYINT) AS tinyint, CAST(l_linenumber * 100 AS SMALLINT) AS smallint, CAST(l_linenumber + 200 AS SMALLINT) AS uint1,
  CAST(l_linenumber + 60000 AS INTEGER) AS uint2, l_linenumber + 4000000000 AS uint4, '1844674407370955161' || l_linenumber % 6 AS uint8,
  hex(encode(l_returnflag)) AS varbinary, CAST(CAST(l_quantity AS DECIMAL(38,10)) AS VARCHAR) AS decimal, CAST(l_suppkey AS VARCHAR) AS varchar,
  l_linenumber > 2 AS bit, CAST(NULL AS TINYINT) AS too_large, FALSE AS text_bit FROM lineitem""")
def write_value_by_type_name(spark, d):
    c, double, long, integer, text = F.col, T.DoubleType(), T.LongType(), T.IntegerType(), T.StringType()
    line = c("l_linenumber").cast("int")
    values = {
        "TIMESTAMPMILLITZ": (c("l_orderkey") * 86400007, long), "DATEMILLI": (c("l_partkey") * 997, long), "DATEDAY": (line * 1000, integer),
        "FLOAT8": (line, integer), "FLOAT4": (c("l_discount"), double), "INT": (c("l_extendedprice"), double),
        "BIGINT": (c("l_orderkey") * F.lit(3000000019), long), "TINYINT": (line, integer), "SMALLINT": (line * 100, integer),
        "UINT1": (line + 200, integer), "UINT2": (line + 60000, integer), "UINT4": (line + F.lit(4000000000), long),
        "UINT8": (F.concat(F.lit("1844674407370955161"), (line % 6).cast("string")), text), "VARBINARY": (c("l_returnflag"), text),
        "DECIMAL": (c("l_quantity"), double), "VARCHAR": (c("l_suppkey"), long), "BIT": (line - 2, integer)}
    out = {n.lower(): sc.write_value(v, t, n) for n, (v, t) in values.items()}
    out |= {n: out[n].cast("timestamp_ntz") for n in ("timestampmillitz", "datemilli")} | {n: out[n].cast("string") for n in ("uint8", "decimal")}
    out |= {"varbinary": F.hex(out["varbinary"]), "float4": out["float4"].cast("double"),
            "too_large": sc.write_value(line + 1000, integer, "TINYINT"), "text_bit": sc.write_value(c("l_returnflag"), text, "BIT")}
    return b.table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *[v.alias(n) for n, v in out.items()])


@query("coerce_types", """SELECT event_id, CAST(k AS VARCHAR) AS as_string, CAST(k AS DOUBLE) AS as_double,
  CAST(CAST(k + 0.5 AS FLOAT) AS DOUBLE) AS as_float, CAST(trunc(-value) AS INTEGER) AS as_int,
  CAST(to_timestamp(k) AT TIME ZONE 'UTC' AS TIMESTAMP) AS as_timestamp, TRY_CAST(event_type AS INTEGER) AS not_a_number
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""")
def coerce_types(spark, d):
    ev = b.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    long, double, string = T.LongType(), T.DoubleType(), T.StringType()
    return ev.select(
        "event_id", sc.coerce(F.col("k"), long, string).alias("as_string"), sc.coerce(F.col("k"), long, double).alias("as_double"),
        sc.coerce(F.col("k") + F.lit(0.5), double, T.FloatType()).cast("double").alias("as_float"),
        sc.coerce(-F.col("value"), double, T.IntegerType()).alias("as_int"),
        sc.coerce(F.col("k"), long, T.TimestampType()).cast("timestamp_ntz").alias("as_timestamp"),
        sc.coerce(F.col("event_type"), string, T.IntegerType()).alias("not_a_number"))
