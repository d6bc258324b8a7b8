"""Stretches, anchors, peers and reported elevations on literal routes."""

import pytest
from pyspark.errors import PySparkException

from racelab.operators import routes as rt

DEGREE = 111195.0802


def route(spark, ele, step=100.0):
    rows = [(k, i, i * step / DEGREE, 0.0, e) for k, es in ele.items() for i, e in enumerate(es)]
    return spark.createDataFrame(rows, "route_id long, idx int, lat double, lon double, ele double")


def test_terrain_on_stretches(spark):
    points = route(spark, {1: [10.0, 30.0, None, 50.0] + [40.0] * 16, 2: [1.0, None, None], 3: [7.0]})
    got = {(r["route_id"], r["stretch"]): r for r in rt.terrain_on(points, {"all": (0, 1e9), "far": (950, 450), "gap": (0, 350), "none": (5000, 6000)}).collect()}
    r = got[1, "all"]
    assert (r["ascent"], r["descent"], r["lowest"], r["highest"], r["coverage"]) == (20, 10, 10, 50, 0.95) and r["length_m"] == pytest.approx(1900, abs=0.1)
    assert (got[1, "far"]["ascent"], got[1, "far"]["descent"]) == (0, 0) and got[1, "far"]["length_m"] == pytest.approx(400, abs=0.1)
    assert (got[1, "gap"]["ascent"], got[1, "gap"]["coverage"]) == (None, 0.75)  # under 90 %
    assert got[2, "all"]["length_m"] is None and got[3, "all"]["lowest"] is None and not any(k[1] == "none" for k in got)


def test_inventory(spark):
    got = {r["route_id"]: r for r in rt.inventory(route(spark, {1: [10.0, 30.0, None, 50.0, 45.0], 2: [None, None], 3: [5.0, None]})).collect()}
    assert (got[1]["points"], got[1]["with_ele"], got[1]["raw_ascent"], got[1]["raw_descent"]) == (5, 4, 20, 5)
    assert got[1]["km"] == pytest.approx(0.4, abs=1e-4) and (got[1]["start_lat"], got[1]["finish_lat"]) == (0, 400 / DEGREE)
    assert (got[2]["raw_ascent"], got[3]["raw_ascent"]) == (None, 0)


def test_anchors(spark):
    points = route(spark, {1: [None] * 10})
    rows = [("near", 1, 305 / DEGREE, 0.0, 10.0), ("far", 1, 305 / DEGREE, 0.001, 100.0), ("lost", 9, 0.0, 0.0, 1e9)]
    x = rt.snapped(spark.createDataFrame(rows, "key string, route_id long, lat double, lon double, max_offset_m double"), points, "key")
    got = {r["key"]: r for r in x.collect()}
    assert (got["near"]["idx"], got["near"]["ok"], got["far"]["ok"], got["lost"]["ok"], got["lost"]["idx"]) == (3, True, False, False, None)
    assert got["near"]["offset_m"] == pytest.approx(5, abs=0.01) and got["near"]["km"] == pytest.approx(0.3, abs=1e-4)
    assert [r["key"] for r in rt.required(x.where("key = 'near'"), "key").collect()] == ["near"]
    for key in ("far", "lost"):
        with pytest.raises(PySparkException, match="too far off"):
            rt.required(x.where(f"key = '{key}'"), "key").collect()


def test_peers(spark):
    points = route(spark, {1: [1.0, 2.0, 3.0], 2: [1.0, 2.0, 3.0], 3: [1.0, 2.0, 4.0]})
    manifest = [(1, 0.2, [2]), (2, 0.2, [1, 3]), (3, 0.3, []), (4, 0.2, [1]), (5, None, [6])]
    got = {r["route_id"]: tuple(r)[2:] for r in rt.verified(points, spark.createDataFrame(manifest, "route_id long, expected_km double, peers array<long>")).collect()}
    assert got == {1: (True, 1, 1, True), 2: (True, 2, 1, False), 3: (False, 0, 0, False), 4: (False, 1, 0, False), 5: (False, 1, 0, False)}


def test_elevation_evidence(spark):
    points = route(spark, {1: [10.0, 30.0, 25.0], 2: [10.0, 30.0], 3: [None, None], 4: [1.0, 2.0]})
    manifest = spark.createDataFrame([(1, 18.0, 7.0), (2, None, 3.0), (3, 5.0, 5.0)], "route_id long, ascent double, descent double")
    got = {r["route_id"]: (r["ascent"], r["descent"], r["ascent_delta"], r["descent_delta"]) for r in rt.elevation_evidence(points, manifest).collect()}
    assert got == {1: (20, 5, 2, -2), 2: (20, 0, None, None), 3: (None, None, None, None), 4: (1, 0, None, None)}
