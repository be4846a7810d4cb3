"""Licence and secret scans against plain regular expressions over every text."""

import hashlib
import re

import pytest

from tickloom.llm import licenses, queries, secrets
from tests.llm.test_tokens import SCHEMA

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
ASSIGN = re.compile(r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
GH = "ghp_" + "a1B2" * 10
TEXTS = [None, "", "CC BY", "cc-by cc by CC  BY\nall rights reserved", "all rights all rights reserved", "general public",
         "license General Public License. General public license", "Released under the MIT License", "çc by", "cc by" + "x" * 70000 + " cc by",
         "Licensed under the Apache Licence, Version 2.0", "licensed under the Apache License, Version 2.0 the license", "all", "reserved",
         "password=short token: 'abcdefgh12' é secret = \"x\"secret=abcdefgh", "paſſword=abcdefgh12 toKen=abcdefgh12", "AKIA1234 AKIA1234567890AB12",
         "é" * 5 + "0123456789abcdef0123456789abcdef0 0123", "password=password=abcdefgh", GH, GH, "x " + GH, "tokentoken=aaaaaaaa=b", "same", "same",
         "permission is hereby granted, free of charge, to any person obtaining a copy of this software and x documentation files"]


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(None if i == 5 else i % 24, t, "en", None if i == 3 else f"s{i}", 1, 2, "x", "y") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


def license_row(doc_id, text):
    words = WORD.findall((text or "").translate(UPPER))
    places, labels = [], set()
    for label, phrase in [("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved")]:
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        labels |= {label} if at else set()
    return (str(doc_id), len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


def license_rows(df):
    rows = df.collect()
    for r in rows:
        assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) - {""} <= set(r.labels.split(","))
    return sorted([(str(r[0]), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows], key=str)


def secret_row(doc_id, text):
    text, spans = text or "", []
    spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    spans.sort()
    kinds = ("assign", "access", "hex")
    joined = ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in spans)
    return (str(doc_id), *(sum(k == i for _, k, _ in spans) for i in range(3)), hashlib.sha256(joined.encode()).hexdigest())


def secret_rows(df):
    return sorted((str(r[0]), r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in df.collect())


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_licenses_match_brute_force(spark, hard):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert license_rows(queries.op1(spark, SF)) == sorted([license_row(*p) for p in pairs(docs)], key=str)
    got = licenses.summary(licenses.scan(hard))
    assert license_rows(got) == sorted([license_row(*p) for p in pairs(hard)], key=str)
    labels = {(r.id, r.labels): r.score for r in got.where("id is not null").collect()}
    assert labels[7, "mit"] == 1.0 and (11, "apache-2.0") in labels and (10, "") in labels and 0.6 <= labels[1, "mit"] < 1
    assert licenses.summary(licenses.scan(hard.limit(0))).count() == 0


def all_matches(text, templates, min_share=0.6):
    """Every start of every template, also before the text, judged by itself."""
    w = WORD.findall((text or "").translate(UPPER))
    out = []
    for label, template, keys in templates:
        t = template.split()
        must = {at + k for phrase in keys for p in [phrase.split()] for at in [next(i for i in range(len(t)) if t[i:i + len(p)] == p)] for k in range(len(p))}
        for start in range(1 - len(t), len(w)):
            same = [0 <= start + k < len(w) and w[start + k] == x for k, x in enumerate(t)]
            if all(same[k] for k in must) and sum(same) / len(t) >= min_share:
                out.append((start, label, len(t), round(sum(same) / len(t), 9)))
    return sorted(out)


def whole_templates():
    return [(label, text, [text]) for label, text in licenses.PHRASES] + licenses.TEMPLATES


def test_all_labels_match_brute_force(spark, hard):
    notices = [" ".join(["x"] * (i % 3) + t.split()[i % 5:] + ["the", "mit"]) for i, (_, t, _) in enumerate(whole_templates())]
    notices += [t.replace("license", "licence") for _, t, _ in whole_templates()] + [" ".join(t for _, t, _ in licenses.TEMPLATES)]
    rows = [(i, t, None, None, 1, 2, "x", "y") for i, t in enumerate(notices)]
    docs = spark.createDataFrame(rows, SCHEMA).union(spark.read.parquet(f"{SF}/documents.parquet").limit(60).selectExpr(
        "doc_id + 1000 as doc_id", "text", "lang", "source", "n_chars", "1", "'a'", "'b'")).union(hard.where("doc_id IS NOT NULL").selectExpr(
            "doc_id + 5000 as doc_id", *hard.columns[1:]))
    texts = {}
    for d, t in pairs(docs):
        texts.setdefault(d, []).append(all_matches(t, whole_templates()))
    got = {}
    for r in licenses.scan(docs.repartition(3)).collect():
        got.setdefault(r.id, []).append(sorted((m.start, m.label, m.words, round(m.share, 9)) for m in r.matches))
    assert {d: sorted(m) for d, m in got.items()} == {d: sorted(m) for d, m in texts.items()}


def test_labels_do_not_depend_on_other_documents(spark):
    mine = [(0, "by the MIT License"), (1, "released under an mit license")]
    for others in ([], [(i + 10, "mit mit License released under the") for i in range(50)], [(i + 10, "by the way") for i in range(50)]):
        rows = [(d, t, None, None, 1, 2, "x", "y") for d, t in mine + others]
        got = {r.id: r.labels for r in licenses.summary(licenses.scan(spark.createDataFrame(rows, SCHEMA))).collect()}
        assert got[0] == got[1] == "mit"


def test_cost_does_not_grow_with_the_templates():
    import time

    import numpy as np
    import pyarrow as pa

    from tickloom.llm import vec

    rng = np.random.default_rng(3)
    more = [(f"l{i}", " ".join(f"t{w}" for w in rng.integers(0, 5000, 120)) + f" key{i} phrase{i}", [f"key{i} phrase{i}"]) for i in range(1000)]
    texts = pa.array([" ".join(f"t{w}" if w % 3 else f"o{w}" for w in rng.integers(0, 5000, 400)) + " released under the MIT license" for _ in range(300)])
    slices = [licenses.word_hashes(d, o) for _, d, o in vec.slices(texts)]

    def seconds(templates):
        index = licenses.Index(templates).open_by(_held(licenses.Index(templates)))
        best = []
        for _ in range(5):
            began = time.perf_counter()
            found = [index.matches(index.place(h), first, 0.6) for h, first in slices]
            best.append(time.perf_counter() - began)
        assert sum(len(f[0]) for f in found) == 300
        return min(best)

    def _held(index):
        return np.array([1 if w.startswith(("key", "phrase")) else 100 for w in index.words])

    assert seconds(licenses.TEMPLATES + more) <= 3 * seconds(licenses.TEMPLATES) + 0.05


def test_templates_are_checked():
    with pytest.raises(ValueError, match="not in its template"):
        licenses.Index([("a", "one two", ["three"])])
    with pytest.raises(ValueError, match="without words"):
        licenses.Index([("a", "", [])])


def test_secrets_match_brute_force(spark, hard):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert secret_rows(queries.op9(spark, SF)) == sorted(secret_row(*p) for p in pairs(docs))
    assert secret_rows(secrets.summary(secrets.scan(hard))) == sorted(secret_row(*p) for p in pairs(hard))
    assert secrets.summary(secrets.scan(hard.limit(0))).count() == 0


def test_ownership_separates_examples(spark):
    token = "password=Zx9Qw3Er7Ty1"
    rows = [(i, f"{token} {GH}", "en", f"owner{i}", 1, 2, "x", "y") for i in range(6)] + [(9, "password=Lk4Jh8Gf2Ds6 " + GH[:-1] + "9", "en", "one", 1, 2, "x", "y")]
    out = {r.id: r for r in secrets.summary(secrets.scan(spark.createDataFrame(rows, SCHEMA))).collect()}
    assert out[0].spans == f"assign:0:{len(token)}" and (out[0].n_live, out[0].n_example) == (0, 1)
    assert out[9].spans.count("platform:") == 1 and out[9].n_live == 1
