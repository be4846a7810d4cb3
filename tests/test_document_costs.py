"""What document queries write and evaluate, on rows of their own."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom.operators import nested as ns
from tickloom.plans import documents as dc
from tickloom.plans import scans as sc

LINEITEM = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, l_tax double, "
            "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")


@pytest.fixture
def lines(spark, tmp_path):
    """A folder with a ``lineitem`` of 700 lines, some of their values missing."""
    rows = [(i, 7 * i, i % 13, 1 + i % 7, i % 50 + 0.5, 0.05 * (i % 2), 0.01 * (i % 9), "ANR"[i % 3], "FO"[i % 2], dt.datetime(1999, 1, 1 + i % 28))
            for i in range(690)]
    rows += [tuple(None if k == j else v for j, v in enumerate((i, 5, 6, 2, 3.0, 0.1, 0.08, 'q"\\', "F", dt.datetime(2000, 2, 28)))) for k, i in enumerate(range(690, 700))]
    spark.createDataFrame(rows, LINEITEM).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    return str(tmp_path)


def test_scanned_documents_lie_packed_in_bounded_files(spark, lines, tmp_path, monkeypatch):
    monkeypatch.setattr(sc, "scratch_path", lambda spark, label: f"{tmp_path}/written")
    monkeypatch.setattr(sc, "FILE_DOCUMENTS", 40)
    assert sc.scan_json_document(spark, lines).count() == 700
    files = list((tmp_path / "written").glob("part-*"))
    text = dc.documents(spark, lines).agg(F.sum(F.length("text") + 1)).first()[0]
    assert sum(f.stat().st_size for f in files) * 4 < text
    assert max(spark.read.text(str(f)).count() for f in files) <= 40


ODD_NUMBERS = ["7", " 7 ", "\t-7\n", "+7", "7.0", "7.", "", " ", "-", "seven", "R", "99999999999", "99999999999999999999", "1e3", "7 7", " 7", "٧", "7\x7f", None]


def test_scalar_fields_are_cast_once_and_as_before(spark):
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(ODD_NUMBERS)], "i int, a string, b string").repartition(2)
    plain = {r.i: (r.a, r.b) for r in df.select("i", F.col("a").try_cast("int"), F.col("b").try_cast("long")).toDF("i", "a", "b").collect()}
    out = ns.write_scalar_fields(df, {"a": "int", "b": "bigint"})
    assert {r.i: (r.a, r.b) for r in out.collect()} == plain
    text = {i: t for i, t in enumerate(ODD_NUMBERS)}
    assert {r.i: r._errors for r in out.collect()} == {
        i: [f for f, v in zip("ab", plain[i], strict=True) if text[i] is not None and v is None] for i in plain}
    for made in (out, ns.write_scalar_fields(df, {"a": "int", "b": "bigint"}, strict=True)):
        plan = made._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("try_cast(a") == plan.count("try_cast(b") == 1 and "RLIKE" in plan


def test_dates_and_numbers_read_as_before(spark):
    dates = ["2020-02-29", "2021-02-29", "2020-13-01", "2020-2-9", " 2020-02-09", "2020-02-09 ", "2020-02-09T01:00", "02020-02-09", "+12020-02-09",
             "0000-01-01", "9999-12-31", "1582-10-10", "never", "", None]
    df = spark.createDataFrame([(t,) for t in dates], "t string")
    assert df.where(~ns.iso_date(F.col("t")).eqNullSafe(F.try_to_date("t", "yyyy-MM-dd"))).collect() == []
    number = F.col("t").try_cast("decimal(38,10)")
    before = F.coalesce(F.col("t").try_cast("long"), F.when(number == F.floor(number), number.try_cast("long")))
    numbers = spark.createDataFrame([(t,) for t in [*ODD_NUMBERS, "3.5", "-0.0", "5000000000", "9223372036854775808.0"]], "t string")
    assert numbers.where(~ns.whole_number(F.col("t")).eqNullSafe(before)).collect() == []
    plan = df.select(ns.iso_date(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "cast(t" in plan.split("gettimestamp")[0]  # ISO text by a cast, the formatter for the rest


def test_documents_are_whole_and_built_once(spark, lines):
    """The text equals one ``json`` writes for the line, and what items share is not computed in every item."""
    def document(r):
        ship, items = r.l_shipdate and r.l_shipdate.date(), None
        if r.l_linenumber is not None:
            items = [{"end": ship and str(ship + dt.timedelta(k)), "val": None if r.l_quantity is None else int(r.l_quantity) * 1000 + k,
                      "accn": "-".join(str(x) for x in (r.l_orderkey, k) if x is not None), "fy": ship and ship.year,
                      "fp": ship and f"Q{(ship.month + 2) // 3}", "form": "10-K" if r.l_returnflag == "A" else "10-Q",
                      "filed": ship and str(ship + dt.timedelta(k + 30)), "frame": "CY"} for k in range(1, r.l_linenumber + 1)]
            items = [{f: v for f, v in i.items() if v is not None} for i in items]
        units = {"USD": items if (r.l_discount or 0) > 0 else None, "shares": items if (r.l_tax or 0) > 0.04 else None}
        top = {"cik": r.l_partkey, "taxonomy": "us-gaap", "tag": "Assets", "label": r.l_returnflag,
               "description": "final" if r.l_linestatus == "F" else None, "entityName": None if r.l_suppkey is None else f"Supplier {r.l_suppkey}"}
        return json.dumps({**{f: v for f, v in top.items() if v is not None}, "units": {u: v for u, v in units.items() if v is not None},
                           "extra": "not in the schema"}, separators=(",", ":"))

    docs = dc.documents(spark, lines)
    assert sorted(r.text for r in docs.collect()) == sorted(map(document, spark.read.parquet(f"{lines}/lineitem.parquet").collect()))
    plan = docs._jdf.queryExecution().optimizedPlan().toString()
    assert "year(" not in plan.split("lambdafunction(")[1].split("AS items")[0] and plan.count("filed, cast(") == 1
