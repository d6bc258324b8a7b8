"""Ranks and order statistics across tasks: one race has a third of all rows, many values are tied."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from racelab.operators import ranks


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    made = [("big", i, float(rng.choice((600, 601, 602, 603)) if i % 3 else rng.randint(1, 4000))) for i in range(2000)]
    made += [(None if i % 10 == 0 else f"r{i % 30}", 10_000 + i, float(rng.randint(1, 50))) for i in range(4000)]
    return made + [("same", 50_000 + i, 7.0) for i in range(300)] + [("one", 60_000, 1.0), ("none", 60_001, None)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")  # so few rows would make one range
    yield spark.createDataFrame(rows, "race string, rid int, value double").repartition(7).cache()
    spark.conf.unset(setting)


@pytest.fixture(scope="module")
def groups(rows):
    out = defaultdict(list)
    for race, rid, value in rows:
        out[race].append((value, rid))
    return out


@pytest.mark.parametrize("within", [None, 10_000])
def test_numbered(frame, groups, within):
    order = [F.desc_nulls_last("value"), F.col("rid")]
    got = {r["rid"]: r["n"] for r in ranks.numbered(frame, ["race"], order, "n", within).collect()}
    for g in groups.values():
        want = sorted(g, key=lambda x: (x[0] is None, -(x[0] or 0), x[1]))
        assert [got[rid] for _, rid in want] == list(range(1, len(g) + 1))


def test_no_task_has_a_race(frame):
    """The windows that number rows are by race and range; the big race has several ranges."""
    out = ranks.numbered(frame, ["race"], [F.col("value"), F.col("rid")], "n")
    dealt = ranks.stored(frame.repartitionByRange("race", F.col("value"), F.col("rid")).withColumn("part", F.spark_partition_id()))
    assert dealt.where("race = 'big'").select("part").distinct().count() > 1
    windows = [line for line in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in line]
    assert all("_range#" in line.split("windowspecdefinition")[1] for line in windows) and windows


@pytest.mark.parametrize("within", [None, 10_000])
def test_slower_and_standings(frame, groups, within):
    known = frame.where("race is not null and value is not null")
    got = {r["rid"]: r for r in ranks.slower(known, ["race"], "value", within).collect()}
    stood = {r["rid"]: r["place"] for r in ranks.standings(known, ["race"], "value", "place", within).collect()}
    largest = {r["rid"]: r["most"] for r in ranks.with_largest(known, ["race"], "value", "most", within).collect()}
    assert len(got) == len(stood) == known.count()
    for race, g in groups.items():
        values = sorted(v for v, _ in g if v is not None)
        for v, rid in g if race is not None else []:
            if v is not None:
                more = len(values) - sum(x <= v for x in values)
                assert (got[rid]["n"], got[rid]["slower"], stood[rid], largest[rid]) == (len(values), more, more + 1, values[-1])


@pytest.mark.parametrize(("buckets", "gathered"), [(4, 3), (2, 0), (1024, 10_000)])
def test_order_statistics(frame, groups, buckets, gathered):
    wanted = {"first": lambda n: F.lit(0), "p50": ranks.nearest_rank_at(0.5), "p95": ranks.nearest_rank_at(0.95), "r90": ranks.rounded_at(0.9), "last": lambda n: n - 1}
    got = {r["race"]: r for r in ranks.order_statistics(frame, ["race"], "value", wanted, buckets, gathered).collect()}
    assert got.keys() == groups.keys() - {"none"}
    for race, r in got.items():
        v = sorted(x for x, _ in groups[race] if x is not None)
        want = (v[0], v[math.ceil(0.5 * len(v)) - 1], v[math.ceil(0.95 * len(v)) - 1], v[round((len(v) - 1) * 0.9)], v[-1])
        assert tuple(r[name] for name in wanted) == want
    assert ranks.order_statistics(frame.limit(0), ["race"], "value", wanted).count() == 0
