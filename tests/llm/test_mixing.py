"""Mixing against the plain rule, and copies against the plan."""

from collections import Counter

from tests.llm.test_pipeline import WORD, plain_mix
from tests.llm.test_tokens import SCHEMA
from tickloom.llm import mixing


def make(spark, rows):
    return spark.createDataFrame([(d, t, "en", s, 1, 2, "x", "y") for d, t, s in rows], SCHEMA).repartition(5)


def hard_rows():
    rows = [(i, "w " * (i % 17) + "\tend\n" * (i % 3), f"s{i % 7}" if i % 11 else None) for i in range(400)]
    rows += [(500, None, "s1"), (501, "", "empty"), (502, None, "empty"), (503, "one", "Z"), (504, " \x0b two words \r", "z"), (505, "long " * 40_000, "huge")]
    return rows + [(600 + i, "hot words here", "hot") for i in range(900)]


def test_plan_matches_the_rule(spark, monkeypatch):
    rows = hard_rows()
    want, sizes = plain_mix(rows), {d: len(WORD.findall(t or "")) for d, t, _ in rows}
    for block_rows in (5_000, 20):
        monkeypatch.setattr(mixing, "BLOCK_ROWS", block_rows)
        out = mixing.mix_plan(make(spark, rows)).collect()
        assert {r.id: r.taken for r in out} == want and {r.id: r.size for r in out} == sizes
    per_source = Counter()
    for r in out:
        per_source[r.source] += r.taken
        assert r.taken <= 3 * r.size and (r.first_position is None) == (r.taken == 0)
        assert r.first_position is None or 0 <= r.first_position <= 1
    assert all(abs(per_source[r.source] - r.target) <= 0.5 and r.target <= 3 * r.source_size for r in out)
    assert abs(sum(per_source.values()) - sum(sizes.values())) <= len(per_source)


def test_copies_follow_the_plan(spark):
    rows = hard_rows()
    docs = make(spark, rows)
    out = mixing.mix(docs)
    assert out.dtypes == docs.dtypes
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({d: n for d, n in plain_mix(rows).items() if n})
    assert sorted(map(tuple, mixing.mix(docs).collect())) == sorted(map(tuple, out.collect()))
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mix_plan(docs.limit(0)).count() == 0


def test_curriculum_moves_heavy_sources_back(spark):
    docs = make(spark, [(i, "w " * 10, s) for i in range(300) for s in ("a", "b", "c")])
    order = [r.source for r in mixing.mix(docs).collect()]
    mean = {s: sum(i for i, x in enumerate(order) if x == s) / order.count(s) for s in set(order)}
    assert mean["a"] < mean["b"] < mean["c"]


def test_repeated_ids_are_taken_each(spark):
    rows = [(1, "a b c", "s"), (1, "a b c", "s"), (1, "d e", "s"), (None, "f g h i", "s"), (None, None, None)]
    out = mixing.mix_plan(make(spark, rows)).collect()
    assert sorted((str(r.id), r.size, r.taken) for r in out) == [("1", 2, 2), ("1", 3, 3), ("1", 3, 3), ("None", 0, 0), ("None", 4, 4)]
    assert sorted(r.text for r in mixing.mix(make(spark, rows)).collect()) == ["a b c", "a b c", "d e", "f g h i"]


def test_the_schedule_moves_positions(spark):
    docs = make(spark, hard_rows())
    plans = [{r.id: r for r in mixing.mix_plan(docs, slope=lambda w, k=k: k * mixing.default_slope(w)).collect()} for k in (1, 0)]
    moved = [d for d, r in plans[0].items() if r.first_position != plans[1][d].first_position]
    assert len(moved) > 100 and all(plans[0][d].taken == plans[1][d].taken for d in plans[0])
    assert all(r.last_position >= r.first_position for r in plans[0].values() if r.taken)
    assert any(r.last_position > r.first_position for r in plans[0].values() if r.taken > r.size)


def test_rows_without_id_are_spread(spark, monkeypatch):
    """30,000 rows without an id: alike ones are one entry, others lie in several blocks."""
    rows = spark.range(0, 30_000, 1, 8).selectExpr("cast(null as long) doc_id", "repeat('w ', cast(1 + id % 3000 as int)) as text", "'s' as source")
    sized = mixing._sized(rows, "doc_id", "text", "source")
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 500)
    kept = {}
    real = mixing.materialize
    monkeypatch.setattr(mixing, "materialize", lambda df, label: kept.setdefault(label, real(df, label)))
    offsets = mixing._offsets(sized, 3, mixing.cyclic_weights, mixing.default_slope, "mix-1")
    assert offsets.count() == 3000 and kept["mix-placed"].select("block").distinct().count() >= 5
    monkeypatch.undo()
    monkeypatch.setattr(mixing, "LIKE_ROWS", 3)
    plan = mixing.mix_plan(rows)
    assert plan.count() == 30_000 and plan.where("taken <> size").count() == 0
    assert plan.select("size", "first_position").distinct().count() == 30_000


def test_many_sources(spark):
    docs = spark.range(5000).selectExpr("id as doc_id", "repeat('w ', cast(1 + id % 7 as int)) as text", "concat('site', id) as source")
    plan = mixing.mix_plan(docs)
    rows = plan.collect()
    assert len(rows) == 5000 and all(abs(r.taken - r.target) <= 0.5 and r.target <= 3 * r.size for r in rows)
    assert abs(sum(r.taken for r in rows) - sum(r.size for r in rows)) <= 2500


def test_alike_rows_of_other_content_are_copied_each(spark):
    rows = [(None, f"w{i} x y", "s") for i in range(50)] + [(None, "same text now", "s")] * 30 + [(7, "a b", "s")]
    out = sorted(r.text for r in mixing.mix(make(spark, rows)).collect())
    words = Counter(w for t in out for w in t.split())
    assert sum(words.values()) == sum(r.taken for r in mixing.mix_plan(make(spark, rows)).collect())
    assert all(words[f"w{i}"] >= 1 for i in range(50)) and words["same"] >= 30
