"""Every stage of the pipeline against a plain version of it on what the stage before returned."""

import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
from tests.llm.test_minhash import brute_force
from tests.llm.test_tokens import SCHEMA, check_pieces, tokenizer  # noqa: F401
from tickloom.llm import mixing, quality
from tickloom.session import materialize

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_mix(rows):
    """``{doc_id: words taken}`` for rows ``(doc_id, text, source)`` with distinct ids."""
    size = {d: len(WORD.findall(t or "")) for d, t, _ in rows}
    members = defaultdict(list)
    for d, _, s in rows:
        members[s].append(d)
    sources = sorted(members, key=lambda s: (s is None, s))
    weight = {s: i % 3 + 1 for i, s in enumerate(sources)}
    total = {s: sum(size[d] for d in members[s]) for s in sources}
    target, rest, left = {}, set(sources), sum(total.values())
    while rest:
        level = left / sum(weight[s] for s in rest)
        over = [s for s in rest if level * weight[s] > 3 * total[s]]
        for s in over or rest:
            target[s] = 3 * total[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        rest = rest - set(over) if over else set()
    taken = {}
    for s in sources:
        passes, part = divmod(min(int(target[s] + 0.5), 3 * total[s]), total[s]) if total[s] else (0, 0)
        for d in sorted(members[s], key=lambda d: hashlib.md5(f"{mixing.SEED}{'' if d is None else d}:{size[d]}".encode()).hexdigest()):
            head = min(size[d], part)
            part -= head
            taken[d] = size[d] * passes + head
    return taken


def words_by_id(rows):
    out = Counter()
    for r in rows:
        out[r.doc_id] += len(WORD.findall(r.text or ""))
    return out


def test_stages(spark, tokenizer):  # noqa: F811
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(materialize(stage(spark, tables[-1], SF), name))
    for t in tables[:-1]:
        assert t.dtypes == docs.dtypes
    start, good, exact, near, mixed = ([(r.doc_id, r.text, r.source) for r in t.collect()] for t in tables[:-1])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {d for d, _, _ in good}
    assert sum(labels.get(d) == 1 and d not in kept for d, _, _ in start) <= 0.01 * sum(v == 1 for v in labels.values())
    assert sum(labels.get(d) == 0 and d in kept for d, _, _ in start) <= 0.1 * sum(v == 0 for v in labels.values())
    lowest = {}
    for d, t, _ in good:
        t = re.sub(r"[\x20\x09-\x0D]+", " ", t)
        lowest[t] = min(d, lowest.get(t, d))
    assert sorted(d for d, _, _ in exact) == sorted(lowest.values())
    assert sorted(d for d, _, _ in near) == sorted(d for d, _, c in brute_force([r[:2] for r in exact], 5, 80) if d == c)
    taken = {d: n for d, n in plain_mix(near).items() if n}
    assert words_by_id(tables[4].collect()) == taken
    check_copies(tokenizer, tables[4], tables[5])
    again = corpus_pipeline.run(spark, SF)
    assert again.columns == tables[5].columns
    assert sorted(map(tuple, again.drop("sequence_id", "ids").collect())) == sorted(map(tuple, tables[5].drop("sequence_id", "ids").collect()))


def check_copies(tokenizer, docs, pieces):  # noqa: F811
    check_pieces(tokenizer, docs, pieces)
    assert pieces.select("sequence_id").distinct().count() == pieces.count()


def test_hard_rows_pass_all_stages(spark, tmp_path):
    text = "one two three four five six seven eight nine ten. "
    rows = [(None, text * 3, "en", None, 1, 2, "x", "y"), (None, None, None, "s", None, None, None, None), (1, "", "en", "s", 0, 2, "x", "y"),
            (1, text * 2, "en", "s", 1, 2, "x", "y"), (1, text * 2, "en", "s", 1, 2, "x", "y"), (2, text.replace(" ", "\n") * 2, "en", "b", 1, 2, "x", "y"),
            (3, "alpha beta " * 30_000, "en", "b", 1, 2, "x", "y")]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, str(tmp_path)), name)
        seen.append(docs.count())
    assert seen[:3] == [7, 4, 4] and seen[4] > 0
    empty = spark.createDataFrame([], SCHEMA)
    for name, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, str(tmp_path))
    assert empty.count() == 0


def test_labels_are_not_inputs():
    assert not {"quality", "toxic", "lang", "source", "doc_id"} & set(quality.FEATURES)
