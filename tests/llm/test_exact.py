"""Exact dedup against grouping by normalised text, and the index itself."""

import hashlib
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tests.llm.test_tokens import SCHEMA
from tickloom.llm import exact


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", None, 1, 2, "x", "y") for d, t in rows], SCHEMA).repartition(4)


def plain_report(rows):
    ids = defaultdict(list)
    for d, t in rows:
        ids[normal(t)].append(d)
    keep = {t: min((d for d in ds if d is not None), default=None) for t, ds in ids.items()}
    out, seen = [], set()
    for d, t in rows:
        t = normal(t)
        first = d == keep[t] and t not in seen
        seen |= {t} if first else set()
        out.append((str(d), str(keep[t]), len(ids[t]), first, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out)


def hard_rows():
    rng = random.Random(2)
    texts = [None, "", " ", "a b", "a\tb", "a \n b", "a  b ", "A b", "é b", "é b", "x" * 100_000, "x" * 99_999 + "y"]
    rows = [(rng.randrange(60) if rng.random() > 0.1 else None, rng.choice(texts)) for _ in range(150)]
    return rows + [(1000 + i, "hot text " * 20) for i in range(300)] + [(1000, "hot text " * 20), (None, "only missing"), (None, "only missing")]


def test_report_matches_grouping(spark):
    rows = hard_rows()
    got = sorted((str(r.id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact.duplicate_report(make(spark, rows)).collect())
    assert got == plain_report(rows)


def test_kept_rows_have_all_columns(spark):
    rows = hard_rows()
    docs = make(spark, rows)
    out = exact.exact_dedup(docs)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    want = Counter((d, t) for d, t, _, kept, t in plain_report(rows) if kept)
    got = Counter((str(r.doc_id), hashlib.sha256(normal(r.text).encode()).hexdigest()) for r in out.collect())
    assert got == want
    assert exact.exact_dedup(docs.limit(0)).count() == 0 and exact.duplicate_report(docs.limit(0)).count() == 0


def test_texts_of_one_hash_are_chained(spark, monkeypatch):
    """Every text gets one of three hashes; the bytes still tell them apart."""
    monkeypatch.setattr(exact.F, "xxhash64", lambda *c: F.length(c[0]).cast("long") % 3)
    rows = hard_rows()
    got = sorted((str(r.id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in exact.duplicate_report(make(spark, rows)).collect())
    assert got == plain_report(rows)


def test_directory_doubles_until_no_bucket_is_overfull(spark):
    """Hashes that agree in all but their last bits, and hashes that are spread."""
    low = F.when(F.col("id") < 500, F.col("id")).when(F.col("id") < 520, F.col("id") - (1 << 62)).otherwise(F.xxhash64("id"))
    keys = spark.range(4000).select(low.alias("h")).distinct()
    table = exact.directory(keys, capacity=100)
    placed = exact.find_buckets(keys, table)
    assert placed.where("bucket IS NULL").count() == 0 and placed.count() == keys.count()
    depth = {r.bucket: (r.depth, r.size) for r in table.collect()}
    buckets = placed.groupBy("bucket").agg(F.count("h").alias("n"), F.min("h").alias("low"), F.max("h").alias("high")).orderBy("bucket").collect()
    assert all(r.n <= 100 and r.n == depth[r.bucket][1] for r in buckets) and len(buckets) > 40
    for r in buckets:
        d = depth[r.bucket][0]
        assert r.bucket <= r.low and r.high < r.bucket + (1 << 64 - d)  # a bucket is a range of its depth
    assert all(a.high < c.bucket for a, c in zip(buckets[:-1], buckets[1:]))
    assert max(d for d, _ in depth.values()) > 50
    assert exact.find_buckets(keys.limit(0), exact.directory(keys.limit(0), 100)).count() == 0


def test_one_hash_is_the_smallest_bucket(spark):
    keys = spark.range(300).select(F.col("id").alias("h"))
    table = exact.directory(keys, capacity=0.5)
    assert {(r.depth, r.size) for r in table.collect()} == {(64, 1)}
    assert exact.find_buckets(keys, table).where("bucket <> h").count() == 0


def test_owners_chain_without_another_exchange(spark):
    rows = hard_rows()
    docs = make(spark, rows)
    entries, index = exact.build_index(docs, capacity=20)
    made = exact.chains(docs, index)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    above = plan.split("Exchange hashpartitioning(bucket")[0]
    assert "Exchange" not in above and above.count("Aggregate") >= 4 and "Python" not in plan
    hashes = [r.h for r in index.collect()]
    assert hashes == sorted(hashes)  # the index lies in the order of the hash


def test_an_index_of_other_rows_is_an_error(spark):
    docs = make(spark, [(1, "a"), (2, "a"), (3, "b")])
    _, index = exact.build_index(docs)
    import pytest

    with pytest.raises(Exception, match="does not count the rows"):
        exact.chains(docs.unionByName(docs.where("doc_id = 2")), index).collect()
