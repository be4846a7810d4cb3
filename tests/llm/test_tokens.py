"""Packing and edit-aware counts against the tokenizer itself on whole texts."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tickloom.llm import counting, packing, queries

SF = "/root/testdata/sf0.001"
HARD = [None, "", " ", "   ", "a   b \n c", "x\n\n\n y <|endoftext|> z", "a\x1c b", "it's  don't\tx", " 　 a  b", "é\u0085 x \r\n y",
        "naïve,word;x!? 12,5 'll a'b", "ab" * 5000, "tail ", "\n", "wörd, “quoted” — x", "same", "same"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, ids string, edits string"


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(i if i != 4 else None, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", 1, 2, "x", "y") for i, t in enumerate(HARD)]
    return spark.createDataFrame(rows, SCHEMA).union(spark.createDataFrame(rows[:2], SCHEMA))


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def check_pieces(tokenizer, docs, pieces):
    texts = {}
    for r in docs.select("doc_id", "text").collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    by_doc = {}
    for p in pieces.collect():
        assert p.offset == 0 and p.length & (p.length - 1) == 0 and p.length <= 2048
        by_doc.setdefault(p.doc_id, []).append(p)
    assert set(by_doc) == set(texts)
    for d, ts in texts.items():
        want = []
        for t in ts:
            ids, start = [*ids_of(tokenizer, t), 1], 0
            for n in packing.piece_lengths(len(ids)):
                want.append((start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes()), len(ids)))
                start += n
            assert start == len(ids)
        assert sorted((p.start, p.length, p.ids_crc32, p.doc_tokens) for p in by_doc[d]) == sorted(want)


def test_pieces_hold_every_id_once(spark, tokenizer):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pieces = queries.op7(spark, SF)
    check_pieces(tokenizer, docs, pieces)
    assert pieces.select("sequence_id").distinct().count() == pieces.count()


def test_hard_texts(spark, tokenizer, hard):
    pieces = packing.pack(hard).select(F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "offset")
    check_pieces(tokenizer, hard, pieces)
    assert packing.pack(hard.limit(0)).count() == 0
    assert [packing.piece_lengths(n, 8) for n in (1, 7, 8, 21)] == [[1], [4, 2, 1], [8], [8, 8, 4, 1]]
    with pytest.raises(ValueError):
        packing.pack(hard, max_tokens=100)


def edited(text, edits):
    for _, e in sorted(enumerate(edits), key=lambda x: (x[1]["at"] or 0, x[0]), reverse=True):
        at = min(max(e["at"] or 0, 0), len(text))
        text = text[:at] + (e["put"] or "") + text[at + (e["drop"] or 0):]
    return text


def test_counts_follow_edits(spark, tokenizer, hard):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(hard.select("doc_id", "text", "lang", "source", "n_chars"))
    trees = counting.build_trees(docs, "doc_id", "text", queries.derived_edits().alias("edits"))
    plan = {r.doc_id: r for r in trees.where("id is not null").select(F.col("id").alias("doc_id"), "text", "edits").collect()}
    done = counting.apply_edits(trees).where("id is not null").collect()
    both = counting.recount(docs, queries.derived_edits()).where("id is not null").collect()
    assert sorted(map(str, both)) == sorted(map(str, done))
    for r in done:
        before = plan[r.id]
        if r.n_before != len(ids_of(tokenizer, before.text)):  # a repeated id
            continue
        assert r.text == edited(before.text, before.edits)
        assert r.counts[1] == len(ids_of(tokenizer, r.text)) and r.chars[1] == len(r.text)
    assert sum(r.encoded_chars for r in done) < 0.8 * sum(len(r.text) for r in done)
    assert {r.id: r.n_tokens for r in counting.token_counts(trees).where("id = 150").collect()} == {150: next(r.n_before for r in done if r.id == 150)}


def test_many_edits_of_one_text(spark, tokenizer):
    rng = np.random.default_rng(3)
    base = " ".join("".join(rng.choice(list("abc é,.\n"), rng.integers(1, 9))) for _ in range(3000))
    edits = [(1, i, int(rng.integers(0, len(base) + 10)), int(rng.integers(0, 60)), "".join(rng.choice(list("xy \n'é"), rng.integers(0, 30)))) for i in range(200)]
    edits += [(1, 900, None, None, None), (2, 0, 5, 5, "a")]
    docs = spark.createDataFrame([(1, base), (2, None), (3, "untouched text")], "doc_id long, text string")
    table = spark.createDataFrame(edits, "id long, seq long, at long, drop long, put string")
    rows = {r.id: r for r in counting.apply_edits(counting.attach_edits(counting.build_trees(docs), table)).collect()}
    want = edited(base, [dict(at=a, drop=d, put=p) for i, _, a, d, p in edits if i == 1])
    assert rows[1].text == want and rows[1].counts[1] == len(ids_of(tokenizer, want))
    assert (rows[2].text, rows[2].counts[1]) == ("a", 1)
    assert rows[3].text == "untouched text" and rows[3].encoded_chars == 0
    assert counting.build_trees(docs.limit(0)).count() == 0


def test_query_edits_stored_trees(spark, tokenizer):
    """The query reads written trees, and its counts are those of the edited texts."""
    rows = {r.doc_id: r for r in queries.op5(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("edits", queries.derived_edits())
    for r in docs.collect():
        got, text = rows[r.doc_id], edited(r.text or "", r.edits)
        assert got.n_chars_after == len(text) and got.encoded_chars >= sum(len(e["put"]) for e in r.edits)
        if "<|endoftext|>" not in text + (r.text or ""):
            assert (got.n_tokens, got.n_tokens_after) == (len(ids_of(tokenizer, r.text)), len(ids_of(tokenizer, text)))
    files = queries.op5(spark, SF).inputFiles()
    assert files and all("token-trees-" in f for f in files)
