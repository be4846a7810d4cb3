"""Recall against brute force, and the cases with defined results."""

import numpy as np
import pytest

from tickloom.llm import neighbours, queries


def truth(rows, asks, k):
    """``{query: [(id, score)]}`` by brute force over ``{id: vector}``."""
    ids = np.array(sorted(rows))
    x = np.array([rows[i] for i in ids], float)
    out = {}
    for q in ids[[asks(i) for i in ids]]:
        s = x @ np.array(rows[q], float)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != q][:k]
        out[int(q)] = [(int(ids[i]), float(s[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r[2], r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def recall(got, want):
    assert set(got) == set(want)
    return np.mean([len({i for i, _ in got[q]} & {i for i, _ in w}) / len(w) for q, w in want.items() if w])


def test_recall_and_scores(spark):
    sf = "/root/testdata/sf0.1"
    rows = {r.vec_id: r.embedding for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()}
    got, want = found(queries.op8(spark, sf)), truth(rows, lambda i: i % 20 == 0, 20)
    assert recall(got, want) >= 0.95
    for q, pairs in got.items():
        assert len(pairs) == 20 and [s for _, s in pairs] == sorted((s for _, s in pairs), reverse=True)
        assert all(abs(s - np.dot(np.array(rows[i], float), np.array(rows[q], float))) < 1e-9 for i, s in pairs)


def test_graph_search_of_many_leaves(spark, monkeypatch):
    for name, value in dict(LEAF=60, TREES=6, OPEN=24, STEPS=4).items():
        monkeypatch.setattr(neighbours, name, value)
    monkeypatch.setattr(neighbours.first_lists, "__defaults__", (6, 60, 16))
    monkeypatch.setattr(neighbours.search, "__defaults__", (128, 24, 4))
    rng = np.random.default_rng(1)
    rows = {i: v.tolist() for i, v in enumerate(rng.standard_normal((900, 16)))}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>").repartition(3)
    assert recall(found(neighbours.nearest(df, "id % 30 = 0", k=10)), truth(rows, lambda i: i % 30 == 0, 10)) >= 0.9


def test_defined_results(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0], 7, "x") for i in range(0, 120)] + [(200 + i, [float(i), 1.0], 7, "x") for i in range(30)]
    bad = [(None, [1.0, 1.0], 7, "x"), (500, None, 7, "x"), (520, [0.0, 0.0], 7, "x"), (540, [nan, 1.0], 7, "x"), (560, [inf, 1.0], 7, "x"),
           (580, [None, 1.0], 7, "x"), (600, [], 7, "x"), (620, [1.0], 7, "x"), (3, [9.0, 9.0], 7, "x")]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, q int, v string")
    got = found(neighbours.nearest(df, "id % 20 = 0"))
    assert got == truth({i: v for i, v, _, _ in rows}, lambda i: i % 20 == 0, 20)
    few = spark.createDataFrame(rows[:1] + rows[-3:], df.schema)
    assert found(neighbours.nearest(few, "id = 0")) == {0: [(229, 31.0), (228, 30.0), (227, 29.0)]}
    assert neighbours.nearest(few.limit(1), "id = 0").count() == 0
    assert neighbours.nearest(few.limit(0), "id = 0").count() == 0


def test_strange_queries_start_at_entries(spark):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((300, 8)))], "vec_id long, embedding array<double>")
    vectors = neighbours.valid_vectors(df, "vec_id", "embedding")
    nodes = neighbours.nodes_of(vectors, neighbours.classes_of(vectors, 1))
    asked = nodes.where("u < 5").selectExpr("u + 1000 AS q", "vec")
    best = {}
    for r in neighbours.search(neighbours.build_graph(nodes), asked).collect():
        best[r.q] = max(best.get(r.q, (-9.0, 0)), (r.s, r.w))
    x = np.array([r.embedding for r in df.orderBy("vec_id").collect()])
    assert {q: w for q, (_, w) in best.items()} == {1000 + i: int((x @ x[i]).argmax()) for i in range(5)}
