"""Near-duplicates against all pairs by brute force."""

import random
import re
from collections import defaultdict

import pytest

from tickloom.llm import minhash, queries
from tickloom.llm.components import components
from tests.llm.test_tokens import SCHEMA

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width):
    w = WORD.findall((text or "").translate(UPPER))
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i:i + width]) for i in range(len(w) - width + 1))


def brute_force(rows, width, percent):
    """``[(id, set size, component)]`` for rows ``(id, text)`` with distinct or missing ids."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for e in s if rows[i][0] is not None else ():
            holders[e].append(i)
    shared = defaultdict(int)
    for h in holders.values():
        for k, i in enumerate(h):
            for j in h[:k]:
                shared[j, i] += 1
    for (i, j), n in shared.items():
        if 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
            parent[root(i)] = root(j)
    lowest = {}
    for i, (d, _) in enumerate(rows):
        lowest[root(i)] = d if d is None else min(d, lowest.get(root(i), d))
    return sorted(((d, len(sets[i]), lowest[root(i)]) for i, (d, _) in enumerate(rows)), key=str)


def result(df):
    rows = df.collect()
    assert all(r.kept == (r[0] == r.component_id) for r in rows)
    return sorted([(r[0], r.n_shingles, r.component_id) for r in rows], key=str)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert result(queries.op2(spark, sf)) == brute_force(rows, 3, 85)


@pytest.fixture(scope="module")
def drifting():
    """Groups in which the smallest id is not the middle: copies of copies, and edits of one original."""
    rng = random.Random(4)
    words = [f"w{i}" for i in range(3000)]

    def edit(text, n):
        out = list(text)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(words)
        return out

    texts = []
    for group in range(3):
        text = [rng.choice(words) for _ in range(120)]
        texts += [edit(text, rng.randrange(1, 5)) for _ in range(50)] + [text]
        for _ in range(25):
            text = edit(text, 2)
            texts.append(text)
    texts += [[rng.choice(words) for _ in range(n)] for n in (1, 2, 3, 4, 5, 6, 7, 8) for _ in range(3)]
    texts += [t[:6] for t in texts[:4]] + [["A", "b"], ["a", "B"], ["a"], [], []]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, "null id text here"), (None, "null id text here"), (10_000, None)]


@pytest.mark.parametrize("width,percent,block", [(3, 85, 16), (5, 80, 512)])
def test_no_link_is_lost_in_large_groups(spark, drifting, monkeypatch, width, percent, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = spark.createDataFrame([(d, t, None, "s", 1, 2, "x", "y") for d, t in drifting], SCHEMA).repartition(5)
    want = brute_force(drifting, width, percent)
    if block == 16:
        assert result(minhash.near_duplicates(docs, width=width, percent=percent)) == want
        return
    kept = minhash.near_dedup(docs, width=width, percent=percent)
    assert kept.columns == docs.columns
    assert sorted(map(str, (r.doc_id for r in kept.collect()))) == sorted(str(d) for d, _, c in want if d == c)


def test_defined_results(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (1, "x y z q"), (2, "X Y z  q"), (3, "")], "doc_id long, text string")
    out = sorted((r.id, r.component_id, r.n_copies, r.kept) for r in minhash.near_duplicates(docs, width=3, percent=85).collect())
    assert out == [(1, 1, 2, True), (1, 1, 2, True), (1, 1, 2, True), (2, 1, 2, False), (3, 3, 1, True)]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.near_dedup(docs.limit(0)).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(300)] + [(1000 + i, 1001 + i) for i in range(60)] + [(0, i) for i in range(1, 90)]
    rows = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {}
    for a, b in edges:
        if a != b:
            x, y = group.get(a, {a}), group.get(b, {b})
            for n in x | y:
                group[n] = x | y
            for n in x | y:
                group[n] = group[a]
    assert rows == {n: min(g) for n, g in group.items()}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
