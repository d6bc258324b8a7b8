"""Nearest points at all latitudes, against brute force."""

import math
import random

from racelab.operators import geo as g


def hav(a, b, c, d):
    s = math.sin(math.radians(c - a) / 2) ** 2 + math.cos(math.radians(a)) * math.cos(math.radians(c)) * math.sin(math.radians(d - b) / 2) ** 2
    return 2 * g.EARTH_M * math.asin(math.sqrt(min(1.0, s)))


def points(rng, n):
    for i in range(n):
        lat = (0.0, 55.5, 62.0, 68.0, -78.0)[i % 5]
        yield i % 5, i, lat + rng.uniform(-0.004, 0.004), 14 + rng.uniform(-0.01, 0.01) / math.cos(math.radians(lat))


def frames(spark):
    rng = random.Random(1)
    left, right = list(points(rng, 200)), list(points(rng, 150))
    # due east by just under the radius, on both sides of a cell's edge
    left += [(9, 1000 + i, 68.0, 14 + i * 0.0007) for i in range(40)]
    right += [(9, 0, 68.0, 14 + 249 / (111195 * math.cos(math.radians(68.0))))]
    return left, right, spark.createDataFrame(left, "k int, i int, lat double, lon double"), spark.createDataFrame(right, "k int, i int, lat double, lon double").drop("i")


def best(left, right):
    return {i: min(hav(lat, lon, c, d) for k2, _, c, d in right if k2 == k) for k, i, lat, lon in left}


def test_nearest_within(spark):
    left, right, a, b = frames(spark)
    want = {i: d if d <= 250 else None for i, d in best(left, right).items()}
    got = {r["i"]: r["separation"] for r in g.nearest(a, b, ["k"], 250.0).collect()}
    assert got.keys() == want.keys()
    assert all((got[i] is None) == (want[i] is None) and (want[i] is None or abs(got[i] - want[i]) < 1e-3) for i in want)
    assert any(d is None for d in want.values())


def test_nearest_however_far(spark):
    left, right, a, b = frames(spark)
    want = best(left, right)
    got = {r["i"]: r["separation"] for r in g.nearest_anywhere(a, b, ["k"], 30.0).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-3 for i in want)
