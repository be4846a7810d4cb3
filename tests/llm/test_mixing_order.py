"""The registered mixing query gives its rows in training order."""

from tickloom.llm import mixing, queries
from tickloom.llm.common import documents

SF = "/root/testdata/sf0.001"


def test_rows_come_in_training_order(spark):
    at = {r.id: r.first_position for r in mixing.mix_plan(documents(spark, SF)).collect()}
    got = [r.doc_id for r in queries.op4(spark, SF).collect()]
    assert len(set(got)) == len(got) == len(at)
    assert got == sorted(got, key=lambda d: (at[d] is None, at[d] or 0.0, d))
