"""Substring dedup against a plain table of all windows."""

import hashlib
import random
import re

import pytest

from tickloom.llm import queries, substring
from tests.llm.test_tokens import SCHEMA

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, width):
    words = [WORD.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        for i in range(len(w) - width + 1 if d is not None else 0):
            k = tuple(w[i:i + width])
            first[k] = min(d, first.get(k, d))
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - width + 1 if d is not None else 0):
            if first[tuple(w[i:i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.id), r.n_words, r.n_removed, hashlib.sha256(r.kept.encode()).hexdigest()) for r in df.collect())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in queries.op3(spark, sf).collect())
    assert got == brute_force(rows, 13)


@pytest.mark.parametrize("width,bits", [(13, 1 << 27), (5, 1 << 15), (3, 1 << 20), (1, 1 << 15)])
def test_overlaps_and_hard_texts(spark, width, bits):
    rng = random.Random(width)
    words = [f"w{i}é" for i in range(60)]
    base = [rng.choice(words) for _ in range(400)]
    rows = []
    for i in range(60):
        a, b, c = (rng.randrange(380) for _ in range(3))
        rows.append((i, "\n".join(base[a:a + 30] + [rng.choice(words)] + base[b:b + 20] + base[c:c + 15])))
    rows += [(70, " ".join(["a"] * 100)), (71, " ".join(["a"] * 12)), (72, "\t\x0b"), (73, ""), (74, None), (None, rows[0][1]), (None, rows[0][1]),
             (75, " ".join(base * 3)), (76, "Same words Only differ in CASE " * 4), (77, "same words only differ in case " * 4),
             (80, "x " + rows[3][1]), (80, rows[4][1] + " y"), (80, "x " + rows[3][1]), (-5, rows[5][1])]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(d, t, "en", None, 1, 2, "x", "y") for d, t in rows], SCHEMA).repartition(4)
    got = substring.remove_repeats(docs, width=width, bits=bits)
    assert result(got) == brute_force(rows, width)
    for r in got.collect():
        assert sum(b - a for a, b in zip(r.starts, r.ends)) == r.n_removed and all(b < a for b, a in zip(r.ends[:-1], r.starts[1:]))


def test_empty_table(spark):
    assert substring.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0
