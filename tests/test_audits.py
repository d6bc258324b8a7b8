"""Rules counted beside the write: planted breaches exactly, samples of keys, and nothing left of what isn't published."""

import pytest

from racelab.operators import audits as au
from racelab.operators.audits import Rule

RULES = [Rule("no_name", "name IS NULL"), Rule("old", "age > 99", hard=False), Rule("late", "split > finish")]


def rows(spark, broken):
    made = [(i, f"n{i}", 30, 10.0, 20.0) for i in range(500)]
    for i in broken.get("no_name", ()):
        made[i] = (i, None, *made[i][2:])
    for i in broken.get("old", ()):
        made[i] = (*made[i][:2], 120, *made[i][3:])
    for i in broken.get("late", ()):
        made[i] = (*made[i][:3], 30.0, 20.0)
    for i in broken.get("unknown", ()):
        made[i] = (*made[i][:3], 30.0, None)  # can't be decided
    return spark.createDataFrame(made, "rid int, name string, age int, split double, finish double").repartition(5)


def test_findings(spark):
    got = {tuple(r) for r in au.findings(rows(spark, {"no_name": [7, 3, 99], "old": [5], "unknown": [8]}), RULES, "rid").collect()}
    assert got == {("no_name", True, 3, 3, 99), ("old", False, 1, 5, 5), ("late", True, 0, None, None)}
    assert {r["value"] for r in au.findings(rows(spark, {}).limit(0), RULES, "rid").collect()} == {0}


def test_published(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    found = au.publish(rows(spark, {"old": [4, 9], "unknown": [8]}), folder, RULES, "rid", ["rid", "name"])
    assert [tuple(f) for f in found] == [("no_name", True, 0, None, None), ("old", False, 2, 4, 9), ("late", True, 0, None, None)]
    back = spark.read.parquet(folder)
    assert back.columns == ["rid", "name"] and back.count() == 500
    with pytest.raises(FileExistsError):
        au.publish(rows(spark, {}), folder, RULES, "rid")
    assert [p.name for p in tmp_path.iterdir()] == ["out"] and spark.read.parquet(folder).count() == 500


def test_hard_breach_undoes_the_write(spark, tmp_path):
    with pytest.raises(ValueError, match="no_name: 2 rows, keys 1 to 499; late: 1 rows, keys 6 to 6"):
        au.publish(rows(spark, {"no_name": [499, 1], "late": [6], "old": [3]}), f"file://{tmp_path}/out", RULES, "rid")
    assert list(tmp_path.iterdir()) == []
