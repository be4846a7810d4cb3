"""Runs against a scan of all periods; suffix trees against sorted suffixes."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_tokens import HARD, SCHEMA
from tickloom.llm import periods, queries, vec
from tickloom.llm.suffix_tree import SuffixTree

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_of(w, least, exponent):
    found, n = set(), len(w)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j - i + q
            if j > i and size >= max(least, exponent * q) and all(w[i:i + size - p] != w[i + p:i + size] for p in range(1, q)):
                found.add((i, size, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(w, runs):
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(w):
    runs = runs_of(w, 6, 4)
    best = min(((-size, s, q) for s, size, q in runs), default=None)
    top = (best[1], -best[0], best[2], 1000 * -best[0] // best[2]) if best else (None,) * 4
    return (len(runs), *top, digest("".join(f"{s},{size},{q}\n" for s, size, q in runs)), digest(collapsed(w, runs)))


def derived(doc_id, text):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_query_matches_brute_force(spark):
    want = {r.doc_id: expected(derived(r.doc_id, r.text)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r[0]: tuple(r[1:]) for r in queries.op13(spark, SF).collect()}
    assert got == want and sum(w[0] > 0 for w in want.values()) > 10


def test_random_strings():
    rng = np.random.default_rng(1)
    for _ in range(800):
        least, exponent = [(6, 4), (2, 2), (6, 2), (6, 3), (1, 2)][rng.integers(5)]
        texts = []
        for _ in range(rng.integers(1, 5)):
            k = [1, 2, 3, 5, 50][rng.integers(5)]
            w = rng.integers(0, k, rng.integers(0, 40)).tolist()
            block = rng.integers(0, k, rng.integers(1, 7)).tolist()
            at = int(rng.integers(0, len(w) + 1))
            w[at:at] = (block * 12)[:rng.integers(0, 12 * len(block) + 1)]
            texts.append(w)
        first = np.cumsum([0, *map(len, texts)])
        hashes = vec.mix(np.array([x for w in texts for x in w], np.uint64) + np.uint64(7))
        got = periods.slice_runs(hashes, first, least, exponent, string_words=[1, 30, 1000][rng.integers(3)])
        want = [(s + int(f), size, q) for w, f in zip(texts, first) for s, size, q in runs_of(w, least, exponent)]
        assert [tuple(r) for r in got.T.tolist()] == want


def test_tree_orders_and_extends_suffixes():
    rng = np.random.default_rng(2)
    for _ in range(100):
        text = [*(rng.integers(2, 5, rng.integers(1, 60)) if rng.random() < .5 else [2, 3] * 20), 1, *rng.integers(2, 4, 10), 0]
        text = [int(x) for x in text]
        tree, n = SuffixTree(text), len(text)
        order = sorted(range(n), key=lambda i: text[i:])
        assert sorted(range(n), key=tree.suffix_ranks().__getitem__) == order
        turned = [x if x < 2 else 100 - x for x in text]
        assert sorted(range(n), key=tree.suffix_ranks(True, 2).__getitem__) == sorted(range(n), key=lambda i: turned[i:])
        a, b = (x[:200] for x in np.nonzero(~np.eye(n, dtype=bool)))
        want = [next(k for k in range(n) if text[i + k] != text[j + k]) for i, j in zip(a.tolist(), b.tolist())]
        assert tree.tour().common(a, b).tolist() == want


def test_hard_texts(spark):
    texts = [*HARD, "a " * 40, "x " + "one two three " * 9 + "y", "a a a a a a b b b b b b a a a a a a b b b b b b " * 4, "w w " * 8]
    rows = [(i if i != 4 else None, t, None, "s", 1, 2, "ids", "nth") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).union(spark.createDataFrame(rows[-3:], SCHEMA)).repartition(3).withColumn("runs", F.lit(1))
    got = periods.find_runs(docs).collect()
    want = []
    for i, t in [(r[0], r[1]) for r in rows + rows[-3:]]:
        w = WORD.findall(t or "")
        runs = runs_of(w, 6, 4)
        want.append((i, len(w), runs, collapsed(w, runs)))
    assert sorted(map(str, want)) == sorted(str((r.id, r.n_words, [tuple(x) for x in r.runs], r.collapsed)) for r in got)
    assert periods.find_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.find_runs(docs, min_exponent=1)


def test_very_long_texts(spark):
    """A period of thousands of words, one word repeated, and a long text without runs."""
    words = [f"w{i}" for i in range(3000)]
    rows = [(1, " ".join(["start", *words * 12, "end"])), (2, "same " * 60_000), (3, " ".join(f"n{i}" for i in range(100_000)))]
    got = {r.id: r for r in periods.summary(periods.find_runs(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert (got[1].n_runs, got[1].start, got[1].length, got[1].period) == (1, 1, 36_000, 3000)
    assert (got[2].start, got[2].length, got[2].period, got[2].collapsed_sha256) == (0, 60_000, 1, digest("same"))
    assert got[3].n_runs == 0 and got[3].exponent_milli is None
