"""Best-two-fit packing against a plain list of pieces packed one sequence at a time."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.test_tokens import HARD, SCHEMA
from tickloom.llm import queries, twofit

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def brute_force(lengths, size):
    left, out = sorted(lengths, reverse=True), []
    while left:
        bin_, room, i = [], size, 0
        while i < len(left):
            if left[i] <= room:
                room -= left[i]
                bin_.append(left.pop(i))
            else:
                i += 1
        if room and len(bin_) > 1:
            shortest, best = bin_[-1], None
            for i in range(len(left)):
                for j in range(i + 1, len(left)):
                    pair = left[i] + left[j]
                    if shortest < pair <= room + shortest and (best is None or (pair, left[i]) > (best[0], left[best[1]])):
                        best = pair, i, j
            if best:
                _, i, j = best
                bin_[-1:] = [left[i], left[j]]
                del left[j], left[i]
                left = sorted([*left, shortest], reverse=True)
        out.append(tuple(sorted(bin_, reverse=True)))
    return Counter(out)


def test_patterns_decide_as_one_sequence_at_a_time():
    rng = random.Random(2)
    for _ in range(600):
        size = rng.choice([8, 16, 50, 100])
        lengths = [rng.randint(1, size) if rng.random() < .7 else rng.randint(1, max(1, size // 3)) for _ in range(rng.randint(0, 60))]
        plan = twofit.patterns(dict(Counter(lengths)), size)
        assert Counter(tuple(n) for times, n in plan for _ in range(times)) == brute_force(lengths, size)


def test_two_fit_step_is_taken():
    # 60 + 30 leaves a gap of 10; without the 30 it is 40, which 21 + 19 fill
    stock = twofit.Stock({60: 1, 30: 1, 21: 1, 19: 1}, 100)
    assert twofit.next_pattern(stock, 100) == [60, 21, 19]


def test_plan_grows_with_lengths_not_with_documents():
    lengths = np.minimum(np.exp(np.random.default_rng(0).normal(5.9, .9, 200_000)).astype(int) + 1, 1024)
    small, large = (twofit.patterns({n: k * times for n, k in Counter(lengths.tolist()).items()}) for times in (1, 1000))
    assert len(large) < 3000 and len(small) < 3000
    assert sum(t for t, _ in large) <= 1.002 * 1000 * lengths.sum() / 1024


def check(tokenizer, docs, pieces, size=1024):
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    found, bins = {}, {}
    for p in pieces.collect():
        found.setdefault(p.doc_id, []).append((p.piece, p.start, p.length, p.ids_crc32))
        bins.setdefault(p.sequence_id, []).append((p.offset, p.length))
    lengths = []
    assert set(found) == set(texts)
    for d, ts in texts.items():
        want = []
        for t in ts:
            ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2]
            head = len(ids) - (-(-len(ids) // size) - 1) * size
            edges = [0, *range(head, len(ids) + 1, size)]
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                want.append((k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
        assert sorted(found[d]) == sorted(want)
        lengths += [w[2] for w in want]
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert Counter(tuple(sorted((n for _, n in parts), reverse=True)) for parts in bins.values()) == brute_force(lengths, size)


def test_query_matches_brute_force(spark, tokenizer):
    check(tokenizer, spark.read.parquet(f"{SF}/documents.parquet"), queries.op12(spark, SF))


def test_hard_texts(spark, tokenizer):
    rows = [(i if i != 4 else None, t, None, "s", 1, 2, "ids", "nth") for i, t in enumerate([*HARD, "long text, " * 20_000])]
    docs = spark.createDataFrame(rows, SCHEMA).union(spark.createDataFrame(rows[:3], SCHEMA)).repartition(4).withColumn("length", F.lit("x"))
    packed = twofit.pack(docs, added=True)
    check(tokenizer, docs, packed.withColumnRenamed("id", "doc_id").withColumn("ids_crc32", F.crc32("ids")))
    assert twofit.pack(docs.limit(0)).count() == 0
    for r in twofit.sequences(packed).collect():
        assert len(r.ids) == 4 * r.n_tokens and r.n_tokens <= 1024


def test_one_length_holds_most_pieces(spark):
    """Equal texts in many tasks: every piece gets its own place."""
    docs = spark.range(0, 5000, 1, 16).selectExpr("id as doc_id", "if(id % 10 = 0, 'a few more words', 'x') as text")
    packed = twofit.pack(docs, max_tokens=16)
    assert packed.select("sequence_id", "offset").distinct().count() == 5000
    full = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert full.where("n <> end or n > 16").count() == 0 and full.where("n < 15").count() <= 1
