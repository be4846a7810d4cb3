"""Archives planned by the sizes of their members."""

import zipfile

import pytest
from pyspark.sql import functions as F

from tickloom.sources import zips


def test_one_huge_member_among_small_ones(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(500):
            z.writestr(f"small/{k}.txt", f"line {k}\n" * 50)
        z.writestr("huge.txt", "one more line of a large member\n" * 2_000_000)
        for k in range(500, 1000):
            z.writestr(f"small/{k}.txt", f"line {k}\r\nlast {k}")
        z.writestr("../outside.txt", "never\n")
        z.writestr("empty.txt", "")
    (tmp_path / "note.txt").write_text("no archive")
    lines = zips.scan_zip_members(spark, str(tmp_path)).withColumn("task", F.spark_partition_id())
    per_task = {r["task"]: (r["members"], r["n"]) for r in lines.groupBy("task").agg(
        F.count_distinct("member").alias("members"), F.count(F.lit(1)).alias("n")).collect()}
    huge = [t for t, (_, n) in per_task.items() if n > 1_000_000]
    assert len(huge) == 1 and per_task[huge[0]] == (1, 2_000_000)
    assert len(per_task) >= 6 and max(m for t, (m, _) in per_task.items() if t != huge[0]) <= 300
    assert lines.count() == 500 * 50 + 2_000_000 + 500 * 2
    assert [tuple(r) for r in lines.where("member = 'small/700.txt'").orderBy("line_no").select("line_no", "line").collect()] == [
        (0, "line 700"), (1, "last 700")]


def test_runs_of_members_are_balanced():
    members = [("a", f"m{k}", 10) for k in range(1000)]
    runs = zips.deal(members, 10 * (10 + zips.MEMBER_BYTES))
    assert len(runs) == 100 and [m for r in runs for m in r] == members
    assert [len(r) for r in zips.deal([("a", "s", 1), ("a", "huge", 1 << 40), ("a", "t", 1)], 1 << 20)] == [1, 1, 1]
    assert zips.deal([], 100) == []


def test_no_archives(spark, tmp_path):
    assert zips.scan_zip_members(spark, str(tmp_path)).count() == 0
    with pytest.raises(Exception, match="gone"):
        zips.scan_zip_members(spark, str(tmp_path / "gone")).count()


def test_one_archive_by_its_own_path(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as z:
        z.writestr("m.txt", "x\ny\n")
    assert [r["line"] for r in zips.scan_zip_members(spark, f"file://{tmp_path}/b.zip").collect()] == ["x", "y"]
