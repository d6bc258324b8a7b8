"""Comparisons of routes against brute force over all samples of all pairs of a family."""

import math
import random
import statistics
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from racelab.operators import geo as g
from racelab.operators import routes as rt
from racelab.plans import routes
from racelab.sources.shared import stored
from test_nearest import hav

#: Routes of one family by the metres east and north of their points; 100 and 101 are far apart as ids.
LINES = {
    1: [(i * 90.0, 0.0) for i in range(40)],
    2: [(i * 70.0 + 20, 0.0) for i in range(51)],
    30: [(i * 90.0, 0.0) for i in range(15)],
    60: [(i * 90.0, 0.0 if i < 15 or i > 21 else 150.0) for i in range(40)],
    99: [(i * 90.0, max(0, i - 20) * 200.0) for i in range(40)],
}


@pytest.fixture(scope="module")
def data(spark):
    rows = [(r, 1, i, 55.5 + y / 111195, 14 + x / 111195 / math.cos(math.radians(55.5)), None) for r, line in LINES.items() for i, (x, y) in enumerate(line, 1)]
    return SimpleNamespace(points=spark.createDataFrame(rows, "route_id long, family long, idx int, lat double, lon double, ele double").cache())


def samples(frame, order):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: [r[c] for c in order]):
        out.setdefault(r["route_id"], []).append((r[order[0]], r["lat"], r["lon"]))
    return out


def brute(s):
    return {(a, b): [(m, min(hav(lat, lon, c, d) for _, c, d in s[b])) for m, lat, lon in s[a]] for a in s for b in s if a != b}


def pct(v, q):
    v, pos = sorted(v), (len(v) - 1) * q
    lo = math.floor(pos)
    return v[lo] + (v[math.ceil(pos)] - v[lo]) * (pos - lo)


def near(x, y):
    return abs(x - y) < 1e-3


def alike(want, over=100, least=0.7):
    """Ordered pairs that are near each other over enough samples, both ways."""
    share = {k: sum(round(x, 3) <= over for _, x in v) / len(v) for k, v in want.items()}
    return {(a, b) for a, b in want if min(share[a, b], share[b, a]) >= least}


def test_corridor(data):
    want = brute(samples(g.resampled(data.points, 50.0), ["along_m"]))
    got = {(r["a"], r["b"]): r for r in routes.geo_pair_corridor(data).collect()}
    assert set(got) == {k for k in alike(want) if k[0] < k[1]} == {(1, 2), (1, 60), (2, 60)}
    for (a, b), r in got.items():
        for way, key in (("a", (a, b)), ("b", (b, a))):
            v = [x for _, x in want[key]]
            assert r[f"points_{way}"] == len(v) and near(r[f"median_{way}"], pct(v, 0.5)) and near(r[f"p95_{way}"], pct(v, 0.95)) and near(r[f"most_{way}"], max(v))
            assert near(r[f"within_50_{way}"], sum(x <= 50 for x in v) / len(v))
    assert got[1, 2]["class"] == "strong"  # the same course, samples out of phase
    assert got[1, 60]["class"] == "substantial"


def test_divergence(data):
    want = set()
    both = brute(samples(g.resampled(data.points, 50.0), ["along_m"]))
    for (a, b), series in both.items():
        run = []
        for m, x in [*series, (0, 0)]:
            if x > 100:
                run.append((m, x))
            else:
                if (a, b) in alike(both) and run and run[-1][0] - run[0][0] >= 300:
                    want.add((a, b, round(run[0][0], 2), round(run[-1][0], 2), len(run), round(statistics.median(x for _, x in run), 2), round(max(x for _, x in run), 2)))
                run = []
    got = {(r["a"], r["b"], round(r["from_m"], 2), round(r["to_m"], 2), r["points"], round(r["median"], 2), round(r["most"], 2)) for r in routes.geo_pair_divergence(data).collect()}
    assert got == want
    assert any(x[:2] == (60, 1) and x[3] - x[2] < 1000 for x in got)


def test_overlap(data):
    want = brute(samples(g.resampled(data.points, 100.0), ["along_m"]))
    pools = {(a, b): [round(x, 3) for key in ((a, b), (b, a)) for _, x in want[key]] for a, b in want if a < b}
    pools = {k: v for k, v in pools.items() if sum(x <= 100 for x in v) / len(v) >= 0.9}
    got = {(r["a"], r["b"]): r for r in routes.geo_pair_overlap(data).collect()}
    assert set(got) == set(pools) and (1, 2) in got
    for k, r in got.items():
        v = pools[k]
        assert r["points"] == len(v) and near(r["median"], pct(v, 0.5)) and near(r["p95"], pct(v, 0.95)) and near(r["most"], max(v))
        assert near(r["within_100"], sum(x <= 100 for x in v) / len(v))


def test_overlap_of_all(spark, monkeypatch):
    """Every pair of a family has its row, also far apart, copies and across tiles; a sample without a place is counted only."""
    lines = LINES | {r: [(x + r, y + 9.0 * r) for x, y in LINES[60]] for r in range(3, 12)} | {5: LINES[1], 200: LINES[1], 201: LINES[99], 300: [(9e4, 5e6), (9.1e4, 5e6)], 301: [(50.0, 0.0)]}
    lines = [(f, r, line) for r, line in lines.items() for f in (1, 2) if f == 1 or r < 60]
    rows = [(f * 1000 + r, f, i, 55.5 + y / 111195, 14 + x / 111195 / math.cos(math.radians(55.5)), None) for f, r, line in lines for i, (x, y) in enumerate(line, 1)]
    rows += [(r, 3, i, None if r == 9001 and i == 3 else 55.5 + i / 1000, 14.0, None) for r in (9000, 9001) for i in range(1, 4)]
    given = SimpleNamespace(points=spark.createDataFrame(rows, "route_id long, family long, idx int, lat double, lon double, ele double"))
    s, family = samples(g.resampled(given.points, 100.0), ["along_m"]), {r: f for r, f, *_ in rows}
    unknown = sum(lat is None for _, lat, _ in s[9001])
    s[9001] = [x for x in s[9001] if x[1] is not None]
    want = {(a, b): sorted(round(min(hav(lat, lon, c, d) for _, c, d in s[y]), 3) for x, y in ((a, b), (b, a)) for _, lat, lon in s[x]) for a in s for b in s if a < b and family[a] == family[b]}
    for tile in (16, 2):
        monkeypatch.setattr(rt, "TILE", tile)
        monkeypatch.setattr(rt, "DISTANCES", 1000 * tile)
        shares = routes.geo_within_share(given).collect()
        got = {(r["a"], r["b"]): r for r in shares}
        assert set(got) == set(want) and len(shares) == len(want)
        for k, v in want.items():
            r, n = got[k], len(v) + (unknown if k[1] == 9001 else 0)
            assert r["points"] == n and near(r["median"], pct(v, 0.5)) and near(r["p95"], pct(v, 0.95)) and abs(r["most"] - v[-1]) < 1e-2
            assert all(abs(r[f"within_{m}"] - sum(x <= m for x in v) / n) < 1e-4 for m in (10, 25, 50, 100, 250))
    assert unknown and got[1001, 1300]["within_250"] == 0 and got[1001, 1300]["most"] > 4e6 and got[1001, 1200]["most"] == 0 and got[1001, 1099]["within_100"] < 0.9


def test_hint_of_all(data):
    """A different pair has its row and hint, too."""
    want = brute(samples(g.resampled(data.points, 100.0), ["along_m"]))
    got = {(r["a"], r["b"]): r for r in routes.geo_overlap_hint(data).collect()}
    assert set(got) == {k for k in want if k[0] < k[1]}
    for k, r in got.items():
        v = [round(x, 3) for key in (k, k[::-1]) for _, x in want[key]]
        w50, w100 = (round(sum(x <= m for x in v) / len(v), 4) for m in (50, 100))
        hint = "same" if w50 >= 0.98 else "near" if w50 >= 0.95 else "similar" if w100 >= 0.9 else "different"
        assert abs(r["within_50"] - w50) < 1e-4 and abs(r["within_100"] - w100) < 1e-4 and r["hint"] == hint
    assert {"same", "different"} <= {r["hint"] for r in got.values()}


def test_benchmark(data):
    want = brute(samples(g.densified(data.points, 10.0), ["idx", "part"]))
    pairs = {(a, b) for a, b in alike(want) if a < b}
    truth = {(a, 1) for a in LINES if a != 1}
    for got, keys in ((routes.geo_pair_benchmark(data).collect(), pairs), (routes.geo_benchmark(data).collect(), truth)):
        assert {(r["a"], r["b"]) for r in got} == keys
        for r in got:
            v = sorted(x for key in ((r["a"], r["b"]), (r["b"], r["a"])) for _, x in want[key])
            assert r["points"] == len(v) and all(abs(r[f"within_{m}"] - sum(x <= m for x in v) / len(v)) < 2e-3 for m in (25, 50))
            assert near(r["p50"], v[math.ceil(0.5 * len(v)) - 1]) and near(r["p95"], v[math.ceil(0.95 * len(v)) - 1])
    assert max(r["p95"] for r in routes.geo_benchmark(data).collect()) > 1000  # far parts are measured, too


def test_candidates_lose_no_pair(spark):
    """Random walks: every pair that reaches the share is a candidate, at any latitude, and few others are."""
    rng = random.Random(4)
    for lat0 in (0.0, 61.0, -78.0):
        rows = []
        for r in range(40):
            y, x = (0.0, 0.0) if r % 2 else (rng.uniform(-3000, 3000), rng.uniform(-3000, 3000))
            for i in range(30):
                rows.append((r, r % 3 == 0, i, lat0 + y / 111195, 20 + x / 111195 / math.cos(math.radians(lat0))))
                y, x = y + rng.uniform(20, 80), x + rng.uniform(-60, 60) * (1 + r % 4)
        walks = spark.createDataFrame(rows, "route_id int, family boolean, idx int, lat double, lon double")
        s = samples(walks, ["idx"])
        family = {r: f for r, f, *_ in rows}
        for reach, share in ((100, 0.7), (150, 0.95)):
            found = {(r["a"], r["b"]) for r in rt.may_cover(walks, ["family"], reach, share).collect()}
            due = {k for k, v in brute(s).items() if family[k[0]] == family[k[1]] and sum(x <= reach for _, x in v) >= share * len(v)}
            assert due <= found and (not due or len(found) < 800)


def test_however_far(spark):
    """Half around the earth, in cells of doubling size; a point without any other side has no separation."""
    rng = random.Random(7)
    some = lambda n: [(k, i, rng.uniform(-80, 80), rng.uniform(-80, 80)) for k in range(3) for i in range(n)]
    rows, there = [*some(25), (9, 0, 1.0, 1.0)], some(12)
    left, right = (spark.createDataFrame(x, "k int, i int, lat double, lon double") for x in (rows, there))
    got = {(r["k"], r["i"]): r["separation"] for r in g.nearest_anywhere(left, right, ["k"], 300_000.0).collect()}
    assert len(got) == len(rows) and got.pop((9, 0)) is None
    for k, i, lat, lon in rows[:-1]:
        assert abs(got[k, i] - min(hav(lat, lon, c, d) for key, _, c, d in there if key == k)) < 1


def test_projection(spark):
    """Landmarks on lines against all segments, with a line without length, a long one and other keys."""
    rng = random.Random(5)
    lines = {r: [(56 + rng.uniform(-0.01, 0.01), 14 + rng.uniform(-0.02, 0.02)) for _ in range(12)] for r in range(6)}
    lines[6] = [(56.0, 14.0), (56.0, 14.0), (56.3, 14.5), (55.9, 14.0)]
    points = [(r, r % 2, i, *p, None) for r, line in lines.items() for i, p in enumerate(line, 1)]
    marks = [(n, n % 2, 56 + rng.uniform(-0.012, 0.012), 14 + rng.uniform(-0.025, 0.025), "clash") for n in range(60)]
    points = spark.createDataFrame(points, "route_id int, family int, idx int, lat double, lon double, ele double")
    landmarks = spark.createDataFrame(marks, "landmark int, family int, lat double, lon double, segment string")
    got = {(r["landmark"], r["route_id"]): r for r in rt.projected(landmarks, rt.segments(points, ["family"]), ["family"], 400.0).collect()}
    n = 0
    for m, family, lat, lon, _ in marks:
        for r, line in lines.items():
            best, cum = None, 0.0
            for i, (p, q) in enumerate(zip(line, line[1:])):
                at = lambda z: (math.radians(z[1] - lon) * g.EARTH_M * math.cos(math.radians(lat)), math.radians(z[0] - lat) * g.EARTH_M)  # noqa: E731, B023
                (ax, ay), (bx, by) = at(p), at(q)
                long = (bx - ax) ** 2 + (by - ay) ** 2
                t = max(0, min(1, -(ax * (bx - ax) + ay * (by - ay)) / long)) if long else 0
                off = round(math.hypot(ax + t * (bx - ax), ay + t * (by - ay)), 3)
                if best is None or off < best[0]:
                    best = (off, cum + t * hav(*p, *q), i, t)
                cum += hav(*p, *q)
            if family == r % 2 and best[0] <= 400:
                n += 1
                x = got[m, r]
                assert x["segment"] == best[2] and near(x["off_m"], best[0]) and abs(x["m"] - best[1]) < 0.01 and near(x["fraction"], best[3])
            else:
                assert (m, r) not in got
    assert n > 30 and rt.projected(landmarks.limit(0), rt.segments(points, ["family"]), ["family"], 400.0).count() == 0


#: Queries whose copies of a route take that route's comparison.
ONCE = ["geo_benchmark", "geo_classify", "geo_corridor_stats", "geo_pair_corridor", "geo_divergence", "geo_pair_divergence", "geo_pair_benchmark", "geo_pair_overlap", "jn_nearest_neighbor", "geo_nearest_series"]


@pytest.mark.parametrize("name", ONCE)
def test_copies_are_compared_once(spark, data, monkeypatch, name):
    """Copies have the rows of what they copy, and what is kept between jobs grows with routes and courses, not with their pairs or samples."""
    shifted = (F.col("route_id") + 1000 * F.col("id")).alias("route_id")
    copies = SimpleNamespace(points=data.points.crossJoin(spark.range(5)).select(shifted, "family", "idx", "lat", "lon", "ele"))
    kept = []

    def counted(frame):
        kept.append((out := stored(frame)).count())
        return out

    monkeypatch.setattr(rt, "stored", counted)
    monkeypatch.setattr(g, "stored", counted)
    got = [r.asDict() for r in getattr(routes, name)(copies).collect()]
    assert sum(kept) < 200
    want = [r.asDict() for r in getattr(routes, name)(data).collect()]
    row = lambda r, a, b: tuple((c, round(v, 6) if isinstance(v, float) else v) for c, v in sorted(r.items()) if c not in "ab") + (a, b)
    same = lambda rows: sorted(rows, key=repr)
    second = [r for r in got if r["a"] // 1000 == 2 and r["b"] // 1000 == (0 if name == "geo_benchmark" else 2) and r["a"] % 1000 != r["b"] % 1000]
    assert want and same(row(r, r["a"] % 1000, r["b"] % 1000) for r in second) == same(row(r, r["a"], r["b"]) for r in want)
    assert any((r["a"] - r["b"]) % 1000 == 0 for r in got) or name.endswith("divergence")


@pytest.mark.parametrize("name", ["geo_within_share", "geo_overlap_hint"])
def test_many_copies_span_tasks(spark, name):
    """The pairs of one course that very many routes share are made in several tasks, and none is lost."""
    routes_of = spark.range(200).select(F.col("id").alias("route_id"), F.lit(1).cast("long").alias("family"))
    line = [(i, 55.5 + i / 1000, 14.0, 1.0) for i in range(1, 4)]
    points = routes_of.crossJoin(spark.createDataFrame(line, "idx int, lat double, lon double, ele double"))
    got = getattr(routes, name)(SimpleNamespace(points=points)).withColumn("task", F.spark_partition_id()).select("a", "b", "within_50", "task").collect()
    assert sorted((r["a"], r["b"]) for r in got) == [(a, b) for a in range(200) for b in range(a + 1, 200)]
    assert {r["within_50"] for r in got} == {1.0} and len({r["task"] for r in got}) > 1


@pytest.mark.parametrize("name", ["geo_project_point", "geo_anchor_nearest"])
def test_copies_and_places_are_measured_once(spark, data, monkeypatch, name):
    """Landmarks of one place and copies of a route have the same row, from one measuring."""
    kept = []
    monkeypatch.setattr(routes, "stored", lambda frame: kept.append((out := stored(frame)).count()) or out, raising=False)
    marks = spark.createDataFrame([(i, f"m{i}", 1, 55.5, 14.001 + (i % 2) / 1000) for i in range(100)], "landmark long, title string, family long, lat double, lon double")
    suppliers = spark.range(100).select(F.col("id").alias("s_suppkey"), F.lit(1).alias("s_nationkey"))
    copies = data.points.crossJoin(spark.range(4)).select((F.col("route_id") + 1000 * F.col("id")).alias("route_id"), "family", "idx", "lat", "lon", "ele")
    rows = getattr(routes, name)(SimpleNamespace(points=copies, landmarks=marks, table=lambda _: suppliers)).collect()
    rest = lambda r: tuple(v for k, v in r.asDict().items() if k not in ("landmark", "title", "route_id"))
    due = {r for r in LINES if name == "geo_project_point" or r % 25 == 1}
    assert len(rows) == 400 * len(due) == len({(r["landmark"], r["route_id"]) for r in rows})
    assert len({(r["landmark"] % 2, r["route_id"] % 1000, rest(r)) for r in rows}) == 2 * len(due) == kept[-1]
