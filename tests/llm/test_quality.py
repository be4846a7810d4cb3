"""Held-out accuracy, and the cases with defined results."""

import zlib

import numpy as np

from tickloom.llm import quality, queries
from tests.llm.test_tokens import SCHEMA

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    out = queries.op6(spark, SF).collect()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(out) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    held = [(labels[r.doc_id], r.score) for r in out if r.held_out and r.doc_id in labels]
    good, bad = [np.array([s for y, s in held if y == k]) for k in (1, 0)]
    assert (good >= 0.5).mean() > 0.99 and (bad < 0.5).mean() > 0.9
    assert (good[:, None] > bad[None, :]).mean() > 0.98


def test_features_of_each_text_alone():
    from tickloom.llm import vec
    import pyarrow as pa

    texts = ["", "one two two", "A B! c|d $$$ 12.", " \n \n", "x" * 3000, "same same", "é è\né"]
    whole = np.concatenate([quality.features(d, o) for _, d, o in vec.slices(pa.array(texts))])
    alone = np.concatenate([quality.features(d, o) for t in texts for _, d, o in vec.slices(pa.array([t]))])
    assert np.array_equal(whole, alone)
    assert whole[1][quality.FEATURES.index("repeats")] == 1 / 3 and whole[1][quality.FEATURES.index("distinct")] == 2 / 3
    assert not whole[0][:10].any()


def test_defined_results(spark):
    rows = [(None, "text one", "en", "s", 1, 2, "x", "y"), (1, None, "en", "s", 1, 2, "x", "y"), (1, "", None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = spark.createDataFrame([(None, 1), (1, None)], "doc_id long, quality int")
    table = quality.feature_table(docs)
    model = quality.fit(table, labels)
    assert [r.score for r in quality.score_table(table, model).collect()] == [0.5] * 3
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and kept.count() == 3
    assert quality.score_table(quality.feature_table(docs.limit(0)), model).count() == 0 and quality.keep_good(docs.limit(0), model).count() == 0
    table = quality.feature_table(spark.range(50).selectExpr("id doc_id", "if(id % 2 = 0, 'GOOD! X', 'fine words here') text"))
    labels = spark.range(50).selectExpr("id doc_id", "cast(id % 2 as int) quality")
    model = quality.fit(table, labels.union(labels), max_rows=30)
    assert all((r.score > 0.5) == (r.id % 2 == 1) for r in quality.score_table(table, model).collect())


def test_scores_match_a_plain_sum_over_tables(spark):
    """Every score by itself: the entry of each feature's table and of each pair's table, found by counting borders."""
    import math

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    table = quality.feature_table(docs)
    model = quality.fit(table, spark.read.parquet("/root/testdata/sf0.001/labels.parquet"))

    def place(edges, value):
        return sum(1 for e in edges.tolist() if e < value)

    def score(x):
        total = model.intercept
        for f, (edges, values) in enumerate(zip(model.edges, model.tables)):
            total += values[place(edges, x[f])]
        for a, b, rows, cols, values in model.pairs:
            total += values[place(rows, x[a]), place(cols, x[b])]
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))

    features = {r.id: r.x for r in table.collect()}
    scored = quality.score_table(table, model).collect()
    assert len(scored) == 200 and model.pairs
    assert all(abs(r.score - score(features[r.id])) < 1e-12 for r in scored)
