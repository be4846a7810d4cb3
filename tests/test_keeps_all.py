"""Rows, documents and cells that earlier fell out: missing keys, wide rows, repeated cells, alike rows of a hot key."""

import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.test_scale import plan_of, table
from tickloom.operators import align as al
from tickloom.operators import matrix as mx
from tickloom.operators import nested as ns
from tickloom.operators import portfolio as pf
from tickloom.operators import rows as rw
from tickloom.operators import schema_merge as sm
from tickloom.operators import skew
from tickloom.plans import base as b
from tickloom.sources import files as fl
from tickloom.sources import text as tx
from tickloom.sources import zips


def test_positions_keep_missing_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("a", 4)], "key string, x int").repartition(3)
    assert table(rw.row_positions(df, ["x"], key_cols=["key"])) == table(spark.createDataFrame(
        [("a", 1, 0), (None, 2, 0), (None, 3, 1), ("a", 4, 1)], "key string, x int, i long"))


@pytest.mark.parametrize("keys", [[], ["key"]])
def test_slices_by_head_and_by_position_agree(spark, monkeypatch, keys):
    df = spark.range(300).select((F.col("id") % 7).alias("key"), F.col("id").alias("x")).withColumn(
        "key", F.when(F.col("key") > 0, F.col("key"))).repartition(5)
    head = table(rw.row_range_slice(df, ["x"], 3, 20, key_cols=keys))
    monkeypatch.setattr(rw, "HEAD_ROWS", 0)
    assert head == table(rw.row_range_slice(df, ["x"], 3, 20, key_cols=keys)) and len(head) == 17 * (7 if keys else 1)


def test_mistyped_documents_stay(spark):
    texts = ['{"cik":1,"units":{"USD":[{"val":2.5,"accn":"a"},{"val":"7"},{"val":3.0}]}}', '{"cik":2,"units":5}', '{"cik":{"a":1}}',
             "[1]", "{broken", None, '{"cik":3,"units":{"USD":[{"val":1,"end":"never"}]}}']
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    docs = ns.write_units_struct(ns.tag_unit_type(ns.extract_unit_list(ns.json_to_document(df, "text"))))
    out = {r.i: (r.cik, None if r.units is None else [(u.val, u.accn, u.end) for u in r.units]) for r in docs.collect()}
    assert out == {0: ("1", [(None, "a", None), (7, None, None), (3, None, None)]), 1: ("2", None), 2: ('{"a":1}', None), 6: ("3", [(1, None, None)])}
    assert sorted(r.i for r in ns.failed_rows(ns.parse_documents(df, "text")).collect()) == [3, 4, 5]


@pytest.mark.parametrize("small", [True, False])
def test_lookup_keeps_map_columns(spark, monkeypatch, small):
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: small)
    monkeypatch.setattr(skew, "SALT_ROWS", 3)
    docs = spark.range(40).select((F.col("id") % 3).alias("k"), F.create_map(F.lit("a"), F.lit(1)).alias("m"))
    out = skew.lookup_join(docs, spark.createDataFrame([(0,), (1,)], "k long"), "k")
    assert sorted((r.k, r.m["a"]) for r in out.collect()) == sorted((i % 3, 1) for i in range(40) if i % 3 < 2)


def test_alike_rows_of_a_hot_key_are_dealt(spark, monkeypatch):
    """Equal rows of one key in one input split."""
    monkeypatch.setattr(skew, "fits_broadcast", lambda df: False)
    left = spark.range(0, 1_000_000, 1, 1).select(F.lit(1).alias("k"), F.lit("same").alias("x"))
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled",
                                              "spark.sql.autoBroadcastJoinThreshold")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.shuffle.partitions", "200")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        joined = skew.skew_join(left, spark.createDataFrame([(1, 2), (1, 3)], "k int, y int"), "k")
        counts = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert sum(counts) == 2_000_000 and len(counts) >= 50 and max(counts) <= 10 * 20_000


def test_join_without_hot_keys_is_plain(spark):
    left = spark.range(100).select((F.col("id") % 50).alias("k"), F.array("id").alias("x"))
    joined = skew.skew_join(left, left.withColumnRenamed("x", "y"), "k")
    assert joined.count() == 200 and "salt" not in plan_of(joined)


def test_blocked_product_equals_the_join(spark):
    a = spark.createDataFrame([(0, 0, 1.0), (0, 0, 1.0), (5, 3, 2.0), (9, 7, 1.0)], "i long, j long, v double")
    c = spark.createDataFrame([(0, 0, 1.0), (3, 2, 4.0), (3, 9, 0.0)], "i long, j long, v double")
    assert table(mx.matmul_blocked(a, c, 4)) == table(mx.matmul(a, c)) == [(0, 0, 2.0), (5, 2, 8.0), (5, 9, 0.0)]


def test_gramian_of_wide_rows(spark, monkeypatch):
    rng = np.random.default_rng(5)
    a = rng.normal(size=(30, 12))
    rows = spark.createDataFrame([(r.tolist(),) for r in a], "v array<double>").repartition(3)
    narrow = table(mx.gramian(rows, "v", 12), 8)
    monkeypatch.setattr(mx, "NARROW", 8)
    assert table(mx.gramian(rows, "v", 12), 8) == narrow
    ragged = rows.union(spark.createDataFrame([([1.0],)], rows.schema))
    with pytest.raises(Exception, match="row without 12 values"):
        mx.gramian(ragged, "v", 12).collect()


def test_qr_refuses_what_it_cannot_factor(spark):
    def rows(values):
        return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i long, v array<double>").repartition(3)

    for bad in ([1.0], None):
        with pytest.raises(Exception, match="row without 2 values"):
            mx.qr_r(rows([[1.0, 2.0], bad, [2.0, 3.0]]), "v", 2).collect()
    short = {(c.i, c.j): c.v for c in mx.qr_r(rows([[3.0, 4.0, 5.0]]), "v", 3).collect()}
    assert short[0, 0] == pytest.approx(3) and short[1, 1] == short[2, 2] == 0
    flat = rows([[1.0, 2.0, 3.0], [2.0, 4.0, 1.0], [3.0, 6.0, 7.0], [1.0, 2.0, 8.0]])
    with pytest.raises(Exception, match="column rank"):
        mx.qr_q(mx.row_cells(flat, "v", ["i"]), mx.qr_r(flat, "v", 3), 3).collect()


def test_long_fields_and_stray_files(spark, tmp_path):
    long = "x" * 30_000
    (tmp_path / "2022q1").mkdir()
    (tmp_path / "2022q1" / "sub.txt").write_text(f"1\t{long}\n")
    (tmp_path / "readme.htm").write_text("2\tnot a quarter\n")
    out = tx.scan_quarters(spark, str(tmp_path), "a int, b string").collect()
    assert [(r.a, len(r.b), r.year, r.quarter, r.tbl) for r in out] == [(1, 30_000, 2022, 1, "sub")]
    with pytest.raises(Exception):
        tx.scan_delimited(spark, str(tmp_path / "2022q1"), "a int, b string", max_chars=100).collect()


def test_columns_with_their_own_stream_are_independent(spark):
    from tickloom.functions import randoms as rnd

    pair = spark.range(4000).select(rnd.gaussian(3, F.col("id")).alias("a"), rnd.gaussian(3, F.col("id"), stream=1).alias("b"))
    assert abs(pair.agg(F.corr("a", "b")).head()[0]) < 0.05


def test_missing_keys_stay_apart_when_aligned(spark):
    a = spark.createDataFrame([("x", 1), (None, 2)], "k string, a int")
    c = spark.createDataFrame([("x", 3), (None, 4), (None, 5)], "k string, c int")
    assert table(al.full_outer_align([a, c], "k")) == table(a.join(c, "k", "full"))


def test_schema_of_deep_and_text_keyed_documents(spark):
    """A document of 3,000 levels is typed, without Python."""
    deep = '{"a":' * 3000 + "1" + "}" * 3000
    df = spark.createDataFrame([("k1", deep), ("k2", '{"b c":1,"l":[{"x":"t"}]}'), ("k3", "[1]")], "k string, t string")
    merged = sm.infer_schema(df, "k", "t")
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    rows = {r["path"]: r["element"] or r["type"] for r in merged.where("size(steps) < 4 or size(steps) = 3000").collect()}
    assert rows.pop(".".join(["a"] * 3000)) == "int"
    assert rows == {"a": "struct", "a.a": "struct", "a.a.a": "struct", "`b c`": "int", "l": "list", "l[]": "struct<`x`:string>"}
    assert merged.count() == 3003
    assert sm.schema_of(sm.infer_schema(df.where("k <> 'k1'"), "k", "t")).simpleString() == "struct<b c:int,l:array<struct<x:string>>>"


def test_nested_documents_match_a_plain_walk(spark):
    import json
    import random

    rng = random.Random(4)

    def value(depth):
        kind = rng.randrange(9 if depth else 6)
        if kind < 6:
            return [None, True, rng.choice([1, 2**31, -2**31, 2**63, 5]), 2.5, "t", {"$date": "x"}][kind]
        if kind == 6:
            return [value(depth - 1) for _ in range(rng.randrange(3))]
        return fields(depth - 1, rng.randrange(4))

    def fields(depth, n):
        """Names that mostly tell the kind of their value."""
        values = [value(depth) for _ in range(n)]
        return {rng.choice("abcd e`f") + (type(v).__name__ if rng.random() < 0.99 else ""): v for v in values}

    texts = [json.dumps(fields(14, 3)) for _ in range(60)]
    texts += ['{"a":1,"a":"last"}', "{'a':1}", '{"z":1}x', '{"a":01}', "", "null", '{"":{"":[]}}']

    def kind_of(v):
        if isinstance(v, bool):
            return "boolean"
        if isinstance(v, int):
            return "int" if -2**31 <= v < 2**31 else "long" if -2**63 <= v < 2**63 else "double"
        if isinstance(v, float):
            return "double"
        if isinstance(v, list):
            return "list"
        if isinstance(v, dict):
            return (sm.WRAPPED.get(next(iter(v))) if len(v) == 1 else None) or "struct"
        return "string"

    def text_of(v):
        k = kind_of(v)
        if k == "list":
            return f"array<{text_of(v[0]) if v else 'string'}>"
        if k == "struct":
            return "struct<" + ",".join("`" + f.replace("`", "``") + "`:" + text_of(v[f]) for f in sorted(v)) + ">"
        return sm.SCALARS[k]

    found = {}

    def walk(path, v, key):
        k = kind_of(v)
        if path:
            found.setdefault(path, []).append((k, key, text_of(v) if path[-1] == 0 and k == "struct" else ""))
        if k == "list":
            walk((*path, 0), v[0] if v else "", key)
        elif k == "struct" and not (path and path[-1] == 0):
            for f, x in v.items():
                walk((*path, f), x, key)

    for key, text in enumerate(texts):
        try:
            doc, _ = json.JSONDecoder().raw_decode(text)
        except ValueError:
            continue
        if isinstance(doc, dict):
            walk((), doc, key)
    merged = {p: (x[0][0], min(x, key=lambda e: e[1])[2]) if len({e[0] for e in x}) == 1 else ("string", "") for p, x in found.items()}
    closed = {p for p, x in found.items() if len({e[0] for e in x}) > 1}
    want = {p: m for p, m in merged.items() if not any(p[:n] in closed for n in range(1, len(p)))}
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").repartition(3)
    got = {tuple(0 if s == sm._ELEMENTS else s for s in r["steps"]): (r["type"], r["element"]) for r in sm.infer_schema(df, "k", "t").collect()}
    assert got == want and len(want) > 40


def test_schema_of_a_million_paths(spark):
    """No path reaches the driver by itself: only the folded text does."""
    import inspect

    n = 1000
    steps = F.array(F.concat(F.lit("f"), (F.col("id") % n).cast("string")), F.concat(F.lit("g"), F.expr(f"id div {n}").cast("string")))
    inner = spark.range(n * n).select(F.lit("").alias("path"), F.lit("int").alias("type"), F.lit("").alias("element"), steps.alias("steps"))
    outer = spark.range(n).select(F.lit("").alias("path"), F.lit("struct").alias("type"), F.lit("").alias("element"),
                                  F.array(F.concat(F.lit("f"), F.col("id").cast("string"))).alias("steps"))
    text = sm.schema_text(inner.unionByName(outer))
    assert text.startswith("struct<`f0`:struct<`g0`:int,`g1`:int,") and text.count(":int") == n * n and text.count(":struct<") == n
    assert "collect(" not in inspect.getsource(sm.schema_of) + inspect.getsource(sm.schema_text)
    few = inner.unionByName(outer).where("steps[0] IN ('f1', 'f22') AND (size(steps) = 1 OR steps[1] = 'g7')")
    assert sm.schema_of(few).simpleString() == "struct<f1:struct<g7:int>,f22:struct<g7:int>>"


def test_undecodable_archives_are_an_error(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("m.txt", b"caf\xe9\n")
    with pytest.raises(Exception, match="can't decode"):
        zips.scan_zip_members(spark, str(tmp_path)).collect()
    assert [r.line for r in zips.scan_zip_members(spark, str(tmp_path), encoding="latin-1").collect()] == ["café"]


def test_portfolio_buckets_do_not_change_values(spark, monkeypatch):
    alloc, prices = b.allocations(spark, "/root/testdata/sf0.001"), pf.normalize_prices(b.flag_prices(spark, "/root/testdata/sf0.001"))
    whole = table(pf.portfolio_returns(prices, alloc), 7)
    monkeypatch.setattr(pf, "PORTFOLIOS_PER_BUCKET", 3)
    assert table(pf.portfolio_returns(prices, alloc), 7) == whole


def test_returns_do_not_shuffle_the_values_again(spark):
    alloc = b.allocations(spark, "/root/testdata/sf0.001")
    plan = plan_of(pf.portfolio_returns(pf.normalize_prices(b.flag_prices(spark, "/root/testdata/sf0.001")), alloc))
    assert "hashpartitioning(portfolio_id" not in plan and "hashpartitioning(blk" in plan


def test_prices_are_aligned_once(spark):
    """The alignment, one exchange by (symbol, block) of observed rows and one of the block list, occurs once."""
    from tickloom.plans import catalog

    prices, alloc = b.flag_prices(spark, "/root/testdata/sf0.001"), b.allocations(spark, "/root/testdata/sf0.001")
    plan = plan_of(pf.sharpe(prices, alloc))
    assert plan.count("REPARTITION_BY_COL") == 2 and plan.count("REPARTITION_BY_NUM") == 1  # of the alignment; of the date blocks
    by_symbols = table(pf.portfolio_value(pf.normalize_prices(prices), alloc, pf.priced_symbols(prices)))
    assert by_symbols == table(pf.portfolio_value(pf.normalize_prices(prices), alloc))
    assert catalog.QUERIES["sharpe"](spark, "/root/testdata/sf0.001").count() == alloc.select("portfolio_id").distinct().count()
