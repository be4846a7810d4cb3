"""Texts that hold the mark of an added token, against the tokenizer in its default setting."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.test_tokens import SCHEMA, check_pieces, edited, ids_of
from tickloom.llm import counting, queries, tokens

MARK = "<|endoftext|>"
TEXTS = [f"a {MARK} b", MARK, f"{MARK}{MARK}", f"x  {MARK}  y", f"it's{MARK}'s", f"é{MARK}\n\n", f"<{MARK}>", "<|endoftext|", "|>", f"<|endof{MARK}text|>",
         "plain words", None, "<|endof", "text|>"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(5)
    parts = [MARK, MARK[:7], MARK[7:], MARK[:-1], ">", " ", "  ", "\n", "a", "it's ", "é", "word, "]
    texts = TEXTS + ["".join(rng.choice(parts, rng.integers(1, 400))) for _ in range(60)]
    path = str(tmp_path_factory.mktemp("marks"))
    rows = [(i, t, "en", "s", 1, 2, "x", "y") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{path}/documents.parquet")
    return path


def test_packed_ids(spark, tokenizer, folder):
    assert ids_of(tokenizer, TEXTS[0]) == [64, 220, 50256, 275]
    check_pieces(tokenizer, spark.read.parquet(f"{folder}/documents.parquet"), queries.op7(spark, folder))


def test_counts_after_derived_edits(spark, tokenizer, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumn("e", queries.derived_edits()).collect()
    got = {r.doc_id: (r.n_tokens, r.n_tokens_after) for r in queries.op5(spark, folder).collect()}
    assert got == {r.doc_id: (len(ids_of(tokenizer, r.text)), len(ids_of(tokenizer, edited(r.text or "", r.e)))) for r in docs}


def test_edits_make_and_break_marks(tokenizer):
    encoder, rng = tokens.encoder(added=True), np.random.default_rng(6)
    words = ["a", "b ", "  ", "\n", "t|", "<|", "it's", MARK, MARK[:7], MARK[7:]]
    texts = ["".join(rng.choice(words, 900)) for _ in range(20)] + ["word " * 300 + MARK[:-1], "word " * 300 + MARK[:-2] + "x"]
    documents = [counting.Document(t, *tree) for t, tree in zip(texts, counting._trees(encoder, texts))]
    edits = [[dict(at=int(rng.integers(0, len(t))), drop=int(rng.integers(0, 4)), put=str(rng.choice(["", *words]))) for _ in range(60)] for t in texts[:-2]]
    edits += [[dict(at=len(texts[-2]), drop=0, put=">")], [dict(at=len(texts[-1]) - 1, drop=1, put="|>")]]
    counting._edited(encoder, documents, edits)
    for d, t, e in zip(documents, texts, edits):
        assert d.text == edited(t, e) and d.counts[1] == len(ids_of(tokenizer, d.text))


def test_overlapping_marks_are_an_error(tmp_path):
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.add_special_tokens([">>x"])
    t.save(f"{tmp_path}/v.json")
    with pytest.raises(ValueError):
        tokens.encoder(f"{tmp_path}/v.json", added=True)
