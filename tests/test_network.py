"""Edges against traces and spliced courses, by plain loops."""

import math

import pytest

from racelab.operators import geo as g
from racelab.operators import routes as rt

M = 1 / 111195.08


def test_edge_costs(spark):
    """Deviations by the fourth and fifth of five distances, capped; relations can't help a grossly deviating edge."""
    c = math.cos(math.radians(56))
    at = lambda north, east: (56 + north * M, 14 + east * M / c)
    line = [(1, 1, i, *at(0, 1000 * i), None) for i in range(5)]
    lines = rt.segments(spark.createDataFrame(line, "route_id int, family int, idx int, lat double, lon double, ele double"), ["family"])
    rows = {
        (1, 0, 1.0): ((10, 100), (10, 500)),
        (1, 1, 0.72): ((0, 100), (200, 100)),  # 0, 50, 100, 150, 200: 160
        (2, 0, 0.72): ((200, 100), (200, 900)),
        (3, 0, 0.72): ((0, 100), (1400, 100)),  # 0 ... 1400: beyond the cap
        (4, 0, 1.0): ((5000, 100), (5000, 500)),
        (5, 0, 1.0): ((7, 7), (7, 7)),
    }
    edges = [(w, p, 1, f, *at(*u), *at(*v)) for (w, p, f), (u, v) in rows.items()] + [(9, 0, 2, 1.0, *at(0, 0), *at(0, 90))]
    edges = spark.createDataFrame(edges, "way int, pos int, family int, factor double, lat0 double, lon0 double, lat1 double, lon1 double")
    got = {(r["way"], r["pos"]): r for r in rt.edge_costs(edges, lines, ["family"]).collect()}
    want = {(1, 0): (400, 10, 1.0), (1, 1): (200, 160, 0.72), (2, 0): (800, 200, 1.35), (3, 0): (1400, 300, 1.35), (4, 0): (400, 300, 1.35), (9, 0): (90, 300, 1.35)}
    assert got.keys() == want.keys()
    for k, (length, dev, factor) in want.items():
        assert abs(got[k]["length_m"] - length) < 1 and abs(got[k]["deviation_m"] - dev) < 1
        assert abs(got[k]["cost"] / (length * (1 + (dev / 32) ** 2) * factor) - 1) < 0.02


@pytest.fixture(scope="module")
def course(spark):
    """1 km out, a square of 4 x 500 m, and on for 1 km; route 2 has no loop."""
    c = math.cos(math.radians(56))
    line = [(0, x) for x in range(0, 1001, 100)]
    line += [(0, 1000 + x) for x in range(100, 501, 100)] + [(x, 1500) for x in range(100, 501, 100)] + [(500, 1500 - x) for x in range(100, 501, 100)] + [(500 - x, 1003) for x in range(100, 501, 100)]
    line += [(-x, 1003) for x in range(100, 1001, 100)]
    rows = [(1, i, 56 + y * M, 14 + x * M / c) for i, (y, x) in enumerate(line, 1)] + [(2, i, 56.0, 14 + 100 * i * M / c) for i in range(1, 41)]
    return spark.createDataFrame(rows, "route_id int, idx int, lat double, lon double")


def test_splice(course):
    bounds = {"apart": 15.0, "first": (500.0, 1500.0), "loop": (1500.0, 2500.0), "rest": (500.0, 1500.0), "wanted": (1000.0, 1000.0)}
    (row,) = rt.splice(course, **bounds).collect()
    assert (row["route_id"], row["i"], row["j"]) == (1, 11, 31) and abs(row["apart_m"] - 3) < 0.1
    assert abs(row["loop_m"] - 2000) < 10 and abs(row["first_m"] - 1000) < 2 and abs(row["rest_m"] - 1000) < 2
    choice = rt.splice(course, **bounds)
    cut = rt.spliced(course, choice, (1990.0, 2020.0)).orderBy("idx").collect()
    assert [r["idx"] for r in cut] == list(range(1, 23)) and abs(cut[-1]["cum_m"] - 2003) < 2 and {r["route_id"] for r in cut} == {1}
    with pytest.raises(Exception, match="out of bounds"):
        rt.spliced(course, choice, (2500.0, 3000.0)).collect()
    assert rt.splice(course, **bounds | {"rest": (1200.0, 1500.0)}).count() == 0  # the bounds leave no pair
    assert g.measured(course).count() == course.count()
