"""Hand-computed values for the indicators, portfolios, matrices and documents."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalar as sc
from tickloom.operators import align as al
from tickloom.operators import indicators as ind
from tickloom.operators import matrix as mx
from tickloom.operators import nested as ns
from tickloom.operators import portfolio as pf
from tickloom.operators import reshape as rs
from tickloom.operators import rows as rw
from tickloom.operators import schema_merge as sm

N = None
# The golden price rows and what each indicator gives for them.
PRICES = {"A": [10, 11, N, 12, 11, 11, 13, 13], "B": [20, N, 21, 22, 20, 20, 20, 20]}
RSI = {"A": [N, N, 100, 100, 0, 0, 66.666667, 100], "B": [N, N, N, 100, 42.857143, 33.333333, 0, N]}
SMA = {"A": [N, N, 10.5, 11.5, 11.5, 11.333333, 11.666667, 12.333333], "B": [N, N, 20.5, 21.5, 21, 20.666667, 20, 20]}
TOP = {"A": [N, N, 11.914214, 12.914214, 12.914214, 12.488034, 13.976068, 14.642734],
       "B": [N, N, 21.914214, 22.914214, 23, 22.976068, 20, 20]}
BOTTOM = {"A": [N, N, 9.085786, 10.085786, 10.085786, 10.178633, 9.357266, 10.023932],
          "B": [N, N, 19.085786, 20.085786, 19, 18.357266, 20, 20]}
BBP = {"A": [N, N, N, 0.676777, 0.323223, 0.355662, 0.788675, 0.644338],
       "B": [N, N, 0.676777, 0.676777, 0.25, 0.355662, N, N]}
PERCENT_K = {"A": [N, N, N, 100, 0, 0, 100, 100], "B": [N, N, 100, 100, 0, 0, N, N]}
PERCENT_D = {"A": [N, N, N, 100, 50, 0, 50, 100], "B": [N, N, 100, 100, 50, 0, 0, N]}
NORM = {"A": [1, 1.1, N, 1.2, 1.1, 1.1, 1.3, 1.3], "B": [1, N, 1.05, 1.1, 1, 1, 1, 1]}
PORT_VALUE = [1, N, N, 1.14, 1.04, 1.04, 1.12, 1.12]
RETURNS = [N, N, N, N, -0.087719, 0, 0.076923, 0]


def day(t):
    return dt.date(2024, 1, 1) + dt.timedelta(days=3 * t)


@pytest.fixture(scope="module")
def prices(spark):
    rows = [(day(t), s, float(v)) for s, vs in PRICES.items() for t, v in enumerate(vs) if v is not None]
    return spark.createDataFrame(rows, "date date, symbol string, price double")


@pytest.fixture(scope="module")
def alloc(spark):
    return spark.createDataFrame([(1, "A", 0.4), (1, "B", 0.6)], "portfolio_id int, symbol string, w double")


def series(df, col):
    out = {}
    for r in df.orderBy("date").collect():
        out.setdefault(r["symbol"], []).append(r[col])
    return out


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert (g is None) == (w is None) and (w is None or g == pytest.approx(w, abs=1e-6)), (got, want)


def check(df, col, want):
    got = series(df, col)
    for s in want:
        close(got[s], want[s])


def test_rsi(prices):
    check(ind.rsi(prices, 3), "rsi", RSI)


def test_bands(prices):
    bands = ind.bollinger_bands(prices, 3)
    for col, want in (("sma", SMA), ("top", TOP), ("bottom", BOTTOM)):
        check(bands, col, want)
    check(ind.bollinger_pct(prices, 3), "bbp", BBP)


def test_stochastic(prices):
    out = ind.stochastic(prices, 3, 2)
    check(out, "percent_k", PERCENT_K)
    check(out, "percent_d", PERCENT_D)


def test_indicator_set_equals_its_parts(prices):
    out = ind.indicator_set(prices, rsi_period=3, band_period=3, k=3, d=2)
    for col, want in (("rsi", RSI), ("top", TOP), ("bbp", BBP), ("percent_k", PERCENT_K), ("percent_d", PERCENT_D)):
        check(out, col, want)


def test_first_gain_is_missing_but_first_loss_zero(prices):
    first = ind.gains_losses(prices).where(F.col("date") == day(0)).collect()
    assert all(r["gain"] is None and r["loss"] == 0.0 for r in first)


def test_nan_prices_are_missing(spark, prices):
    hole = spark.createDataFrame([(day(2), "A", float("nan"))], prices.schema)
    check(ind.bollinger_bands(prices.unionByName(hole), 3), "sma", SMA)


def test_portfolio(prices, alloc):
    norm = pf.normalize_prices(prices)
    check(norm, "norm", NORM)
    values = pf.portfolio_value(norm, alloc)
    ordered = lambda df, c: [r[c] for r in df.orderBy("date").collect()]
    close(ordered(values, "port_value"), PORT_VALUE)
    returns = pf.daily_returns(values)
    close(ordered(returns, "daily_return"), RETURNS)
    close(ordered(pf.daily_returns(values, keep_first=True), "daily_return"), [1, *RETURNS[1:]])
    one = lambda df: df.collect()[0][-1]
    assert one(pf.average_daily_return(returns)) == pytest.approx(-0.00269905533, abs=1e-9)
    assert one(pf.average_daily_return(returns, strict_nulls=True)) is None
    assert one(pf.std_daily_return(returns)) == pytest.approx(0.06728718414, abs=1e-9)
    assert one(pf.std_daily_return(returns, ddof=0)) == pytest.approx(0.05827241082, abs=1e-9)
    assert one(pf.cumulative_return(values)) == pytest.approx(0.12)
    assert one(pf.cumulative_return(values, as_coded=True)) == pytest.approx(-0.10714285714)
    assert one(pf.sharpe(prices, alloc)) == pytest.approx(-0.63676576192, abs=1e-9)
    assert one(pf.sharpe(prices, alloc, strict_nulls=True)) is None


def test_single_holding_is_its_normalised_price(spark, prices):
    alone = spark.createDataFrame([(1, "B", 1.0)], "portfolio_id int, symbol string, w double")
    values = pf.portfolio_value(pf.normalize_prices(prices), alone)
    close([r["port_value"] for r in values.orderBy("date").collect()], NORM["B"])


def test_large_allocations_take_the_split_join(prices, alloc, monkeypatch):
    monkeypatch.setattr(pf, "BROADCAST_BYTES", -1)
    assert pf.sharpe(prices, alloc).collect()[0][-1] == pytest.approx(-0.63676576192, abs=1e-9)


def cells(df):
    return {tuple(r[:-1]): r[-1] for r in df.select(*[c for c in df.columns if c != "v"], "v").collect()}


def test_dense_sparse_and_products(spark):
    m = spark.createDataFrame([([1.0, 3.0, 5.0, 2.0, 4.0, 6.0],)], "a array<double>")
    dense = mx.dense_from_column_major(m, [], "a", 3, 2)
    assert cells(dense) == {(0, 0): 1, (0, 1): 2, (1, 0): 3, (1, 1): 4, (2, 0): 5, (2, 1): 6}
    product = {(0, 0): 5, (0, 1): 11, (0, 2): 17, (1, 0): 11, (1, 1): 25, (1, 2): 39, (2, 0): 17, (2, 1): 39, (2, 2): 61}
    assert cells(mx.matmul(dense, mx.transpose(dense))) == product
    for block in (1, 2, 512):
        assert cells(mx.matmul_blocked(dense, mx.transpose(dense), block)) == product
    assert cells(mx.transpose(mx.transpose(dense))) == cells(dense)
    csc = spark.createDataFrame([([0, 1, 3], [0, 2, 1], [9.0, 6.0, 8.0])], "p array<int>, r array<int>, x array<double>")
    assert cells(mx.sparse_from_csc(csc, [], "p", "r", "x")) == {(0, 0): 9, (2, 1): 6, (1, 1): 8}


def test_csc_with_empty_columns(spark):
    csc = spark.createDataFrame([([0, 0, 2, 2], [1, 0], [5.0, 7.0])], "p array<int>, r array<int>, x array<double>")
    assert cells(mx.sparse_from_csc(csc, [], "p", "r", "x")) == {(1, 1): 5, (0, 1): 7}


def test_axpy(spark):
    x = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 3, 5, 2, 4, 6])], "i long, v double")
    y = mx.scal(x, 0.0)
    assert [v for _, v in sorted(cells(mx.axpy(3.0, x, y)).items())] == [3, 9, 15, 6, 12, 18]


def test_coordinate_matrix_shape(spark):
    m = spark.createDataFrame([(0, 1, 1.2), (0, 2, 1.5), (0, 3, 2.5)], "i long, j long, v double")
    assert tuple(mx.shape(m).collect()[0]) == (1, 4, 3)


def test_reshape(spark):
    flat = spark.createDataFrame([(p, p + 1) for p in range(12)], "pos long, v int")
    two_by_six = mx.ndarray_from_flat(flat, (2, 6))
    out = cells(mx.reshape(two_by_six, (2, 6), (3, 4), read_order="C", write_order="F"))
    assert [[out[i, j] for j in range(4)] for i in range(3)] == [[1, 4, 7, 10], [2, 5, 8, 11], [3, 6, 9, 12]]
    with pytest.raises(ValueError):
        mx.reshape(two_by_six, (2, 6), (1, 2))


def test_blocks_are_validated(spark):
    m = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (5, 1, 1.0)], "i long, j long, v double")
    found = {(r["bi"], r["bj"]): (r["twice"], r["outside"], r["valid"])
             for r in mx.validate_blocks(mx.blocks(m, 2), 4, 4, 2).collect()}
    assert found == {(0, 0): (1, 0, False), (2, 0): (0, 1, False)}


def test_array_fill(spark):
    assert mx.array_fill(spark.createDataFrame([(3,)], "x int"), "x").collect()[0]["filled"] == [3.0] * 9


def test_array_of_another_length_is_an_error(spark):
    with pytest.raises(Exception, match="3 x 2"):
        mx.dense_from_column_major(spark.createDataFrame([([1.0],)], "a array<double>"), [], "a", 3, 2).collect()


def test_left_pad_id(spark):
    df = spark.createDataFrame([("54321",), ("12345678901",)], "id string")
    got = [tuple(r) for r in df.select(sc.left_pad_id(F.col("id")), sc.left_pad_id(F.col("id"), 9)).collect()]
    assert got == [("0000054321", "000054321"), ("12345678901", "12345678901")]


def test_melt_golden(spark):
    # One row of an income table, as it is melted.
    wide = spark.createDataFrame([("Agnostic", 27, 34, 60, 81, 76, 137)],
                                 "religion string, `<$10k` int, `$10-20k` int, `$20-30k` int, `$30-40k` int, `$40-50k` int, `$50-75k` int")
    long = rs.melt_all(wide, ["religion"], variable="income", value="freq")
    assert [r["freq"] for r in long.collect()] == [27, 34, 60, 81, 76, 137]
    assert long.where("income = '$30-40k'").collect()[0]["freq"] == 81


def test_melt_clean_golden_and_dotted_names(spark):
    # One song and its ranks in three weeks.
    wide = spark.createDataFrame([(2000, "2 Pac", "4:22", dt.date(2000, 2, 26), 87, 82, 72)],
                                 "year int, artist string, time string, `date.entered` date, wk1 int, wk2 int, wk3 int")
    dated = rw.rename_columns(wide, {"date.entered": "date"})
    out = rs.melt_clean(dated, ["year", "artist", "time", "date"], ["wk1", "wk2", "wk3"], variable="week", value="rank", strip="wk")
    assert sorted((r["week"], r["rank"]) for r in out.collect()) == [("1", 87.0), ("2", 82.0), ("3", 72.0)]
    kept = rs.melt_subset(wide, ["date.entered"], ["wk1"])
    assert kept.columns == ["date.entered", "variable", "value"]


def test_melt_and_pivot_are_inverse(spark):
    wide = spark.createDataFrame([(day(0), 1.0, None), (day(1), 3.0, 4.0)], "date date, a double, b double")
    back = al.pivot_wide(rs.melt_subset(wide, ["date"], ["a", "b"]), ["a", "b"], symbol_col="variable", value_col="value")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))
    assert sorted(map(tuple, rs.melt_by_column_union(wide, ["date"], ["a", "b"]).collect()), key=str) == sorted(
        map(tuple, rs.melt_subset(wide, ["date"], ["a", "b"]).collect()), key=str)


def test_sort_golden_with_a_tie(spark):
    # Four people, and one more who shares a score.
    people = [("Bre", 92, dt.date(1970, 1, 1)), ("Piper", 98, dt.date(1980, 1, 1)), ("Ginger", 111, dt.date(1963, 9, 4)),
              ("Spencer", 142, dt.date(1990, 1, 1)), ("Tie", 98, dt.date(1985, 1, 1))]
    df = spark.createDataFrame(people, "name string, iq int, dob date")
    names = lambda *o: [r["name"] for r in rw.sort_multi(df, *o).collect()]
    assert names(F.asc("iq"), F.asc("dob")) == ["Bre", "Piper", "Tie", "Ginger", "Spencer"]
    assert names(F.asc("iq"), F.desc("dob")) == ["Bre", "Tie", "Piper", "Ginger", "Spencer"]
    assert names(F.desc("iq"), F.desc("dob")) == ["Spencer", "Ginger", "Tie", "Piper", "Bre"]


def test_tail(spark):
    df = spark.range(100)
    assert [r["id"] for r in rw.tail_n(df, 3, ["id"]).collect()] == [97, 98, 99]


def test_lookup_without_a_match_is_an_error(spark):
    df = spark.createDataFrame([("a", 1)], "ticker string, cik int")
    assert rw.lookup_first_or_error(df, F.col("ticker") == "a", "Invalid Ticker").collect()[0]["cik"] == 1
    with pytest.raises(Exception, match="Invalid Ticker"):
        rw.lookup_first_or_error(df, F.col("ticker") == "b", "Invalid Ticker").collect()


def test_bool_rule_and_build_list(spark):
    nums = spark.createDataFrame([(2,), (0,), (-1,)], "x int").select(sc.number_to_bool(F.col("x"))).collect()
    assert [r[0] for r in nums] == [True, False, False]
    got = spark.range(1).select(ns.build_list(F.lit(1), F.lit(None).cast("int"), F.lit(2))).collect()[0][0]
    assert got == [1, 2]


def test_to_int_truncates_and_clamps(spark):
    df = spark.createDataFrame([(2.9,), (-2.9,), (1e12,), (-1e12,), (float("nan"),)], "x double")
    assert [r[0] for r in df.select(sc.to_int(F.col("x"))).collect()] == [2, -2, 2147483647, -2147483648, 0]


def test_two_digit_year(spark):
    df = spark.createDataFrame([("9/4/63",), ("1/2/01",)], "s string")
    got = [r[0] for r in df.select(sc.two_digit_year_date(F.col("s"), "M/d/yy", "2020-01-01")).collect()]
    assert got == [dt.date(1963, 9, 4), dt.date(2001, 1, 2)]


def merged(spark, *texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return {r["path"]: r["element"] or r["type"] for r in sm.infer_schema(df.repartition(3), "k", "t").collect()}


def test_inferred_types(spark):
    assert merged(spark, '{"s":"x","n":1,"e":[],"z":null,"l":[1,"a"]}') == {
        "s": "string", "n": "int", "e": "list", "e[]": "string", "z": "string", "l": "list", "l[]": "int"}
    assert merged(spark, '{"a":5000000000,"b":true,"c":2.5,"d":{"$date":"x"},"o":{"$oid":"1"}}') == {
        "a": "long", "b": "boolean", "c": "double", "d": "timestamp", "o": "string"}


def test_merged_schemas(spark):
    assert merged(spark, '{"a":1,"b":{"x":1}}', '{"a":2.5,"b":{"y":"q"},"c":5000000000}') == {
        "a": "string", "b": "struct", "b.x": "int", "b.y": "string", "c": "long"}
    assert merged(spark, '{"b":{"x":1}}', '{"b":1}') == {"b": "string"}


def test_merged_lists(spark):
    assert merged(spark, '{"l":[1]}', '{"l":["a"]}') == {"l": "list", "l[]": "string"}
    assert merged(spark, '{"l":[{"x":1}]}', '{"l":[{"y":1}]}') == {"l": "list", "l[]": "struct<`x`:int>"}
    assert merged(spark, '{"l":[[1]]}', '{"l":[[2.5]]}') == {"l": "list", "l[]": "list", "l[][]": "string"}
    assert merged(spark, '{"l":[{"x":1}]}', '{"l":[1]}') == {"l": "list", "l[]": "string"}


def test_names_with_marks_do_not_collide(spark):
    assert merged(spark, '{"a.b":1,"a":{"b":"x"},"c[]":true,"c":[2.5]}') == {
        "`a.b`": "int", "a": "struct", "a.b": "string", "`c[]`": "boolean", "c": "list", "c[]": "double"}


def test_texts_that_are_not_documents_add_nothing(spark):
    assert merged(spark, '{"a":1}', "{", "[1]", "7") == {"a": "int"}


def test_schema_reads_the_documents(spark):
    texts = ['{"a":1,"b":{"x":1},"l":[{"q":1}]}', '{"a":2,"b":{"y":"s"},"l":[]}']
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").where("k = 0 or k = 1")
    schema = sm.schema_of(sm.infer_schema(df.where("k = 0"), "k", "t"))
    assert schema.simpleString() == "struct<a:int,b:struct<x:int>,l:array<struct<q:int>>>"
    assert df.select(F.from_json("t", schema).alias("d")).select("d.a").collect()[1]["a"] == 2


def test_company_document(spark):
    text = ('{"cik":320193,"taxonomy":"us-gaap","tag":"Assets","label":"L","extra":1,"units":{"USD":[{"end":"2020-09-26",'
            '"val":5000000000,"accn":"a","fy":2020,"fp":"FY","form":"10-K","filed":"2020-10-30","frame":"x"},null]}}')
    df = spark.createDataFrame([(text,), ('{"cik":1}',), ("{",)], "text string")
    rows = ns.company_table(df, "text", F.lit("0000320193")).collect()
    assert len(rows) == 2
    full = next(r for r in rows if r["units"])
    assert full["cik"] == "0000320193" and full["description"] is None and len(full["units"]) == 1
    assert full["units"][0].asDict() == {"accn": "a", "form": "10-K", "fp": "FY", "fy": "2020", "type": "USD",
                                         "end": dt.date(2020, 9, 26), "filed": dt.date(2020, 10, 30), "val": 5000000000}
    assert ns.failed_rows(ns.parse_documents(df, "text")).count() == 1


def test_strict_scalar_field_names_the_field(spark):
    df = spark.createDataFrame([("x",)], "cik string")
    with pytest.raises(Exception, match="field cik"):
        ns.write_scalar_fields(df, {"cik": "int"}, strict=True).collect()


def test_map_entry_without_key_is_an_error(spark):
    df = spark.createDataFrame([([(None, 1)],)], "e array<struct<key:string,value:int>>")
    with pytest.raises(Exception, match="without a key"):
        df.select(ns.build_map(F.col("e"))).collect()


def test_unknown_type_name():
    with pytest.raises(ValueError):
        sc.null_value("INTERVAL")
