"""Positions in time, state and heights against plain Python on literal rows; indices and trends on planted editions."""

import pytest
from pyspark.sql import functions as F

from racelab.operators import replay as rp
from racelab.plans import compare

KM = {"start": 0.0, "cp1": 20.0, "cp2": 45.0, "finish": 60.0}
SEEN = {
    1: (0.0, 1000.0, 3000.0, 4000.0), 2: (0.0, 1000.0, 900.0, 4100.0), 3: (0.0, None, 2500.0, None), 4: (None, None, None, None), 5: (0.0, 2000.0, None, 4000.0), 6: (0.0, 1500.0, 1500.0, 3600.0),
}
TIMES = (0.0, 500.0, 1000.0, 2999.0, 3600.0, 9000.0)


@pytest.fixture(scope="module")
def laid(spark):
    rows = [("r", rid, [(cp, i, KM[cp], s, None if s is None or rid == 5 else 10 * i + rid) for i, (cp, s) in enumerate(zip(KM, seen, strict=True))]) for rid, seen in SEEN.items()]
    return spark.createDataFrame(rows, "race_key string, rid long, observed array<struct<cp_key:string,seq:int,km:double,seconds:double,place:int>>")


def plain_anchors(seen):
    out = []
    for km, s in zip(KM.values(), seen, strict=True):
        if s is not None and s > (out[-1][0] if out else -1):
            out.append((s, km))
    return out


def plain_km(anchors, t):
    before = [a for a in anchors if a[0] <= t]
    if not before:
        return None
    if len(before) == len(anchors):
        return anchors[-1][1]
    (t0, k0), (t1, k1) = before[-1], anchors[len(before)]
    return k0 + (t - t0) / (t1 - t0) * (k1 - k0)


def test_anchors_and_positions(laid):
    got = {r["rid"]: [(a["t"], a["km"]) for a in r["a"]] for r in laid.select("rid", rp.row_anchors(F.col("observed")).alias("a")).collect()}
    assert got == {rid: plain_anchors(seen) for rid, seen in SEEN.items()}
    at = {(r["rid"], r["t"]): r["km"] for r in rp.positions(laid, TIMES).collect()}
    want = {(rid, t): plain_km(plain_anchors(seen), t) for rid, seen in SEEN.items() for t in TIMES}
    assert at == {k: pytest.approx(v) for k, v in want.items() if v is not None}


@pytest.mark.parametrize("within", [None, 6])
def test_leaderboard(laid, within):
    rows = rp.leaderboard(laid, TIMES, within).collect()
    assert len(rows) == 5 * len(TIMES)
    for r in rows:
        all_km = {rid: plain_km(plain_anchors(seen), r["t"]) for rid, seen in SEEN.items() if plain_anchors(seen)}
        mine = all_km[r["rid"]]
        seen = [(s, i, cp) for i, (cp, s) in enumerate(zip(KM, SEEN[r["rid"]], strict=True)) if s is not None and s <= r["t"]]
        assert r["rank"] == 1 + sum(round(k, 6) > round(mine, 6) for k in all_km.values())
        assert (r["behind_km"], r["last_cp"]) == (pytest.approx(max(all_km.values()) - mine), max(seen)[2])


def test_now_state(spark, laid):
    lines = spark.createDataFrame([("r", "field", i, km, s) for i, (km, s) in enumerate(zip(KM.values(), (0.0, 1200.0, 2900.0, 4000.0), strict=True))], "race_key string, line string, seq int, km double, seconds double")
    x = {(r["rid"], r["t"]): r for r in rp.now_state(laid, lines, TIMES, ("field", "women")).collect()}
    assert len(x) == 5 * len(TIMES)
    r = x[1, 2999.0]
    assert (r["last_cp"], r["segment"], r["place"], r["to_women"]) == ("cp1", "cp1>cp2", 11, None) and r["pace"] == 2000 / 25
    assert r["left_km"] == pytest.approx(60 - r["km"]) and r["to_field"] == pytest.approx(45 + 99 / 1100 * 15 - r["km"])
    assert (x[1, 1000.0]["last_cp"], x[1, 1000.0]["segment"]) == ("cp1", "start>cp1")  # on a boundary the earlier segment
    assert x[2, 9000.0]["segment"] == "cp2>finish" and x[2, 1000.0]["place"] == 22  # the later checkpoint was published earlier
    assert x[3, 500.0]["pace"] is None and x[5, 9000.0]["place"] is None and x[3, 9000.0]["km"] == 45


def test_heights(spark):
    from math import radians

    from racelab.operators.geo import EARTH_M

    step = 100 / (radians(1) * EARTH_M)  # a point each 100 m northward
    ele = {1: [10.0, None, 30.0, 25.0, None, 35.0], 2: [None, 5.0, 6.0, None, None, None], 3: [None] * 6}
    rows = [(k, i, i * step, 0.0, e) for k, es in ele.items() for i, e in enumerate(es)]
    got = {(r["route_id"], r["at_m"]): r for r in rp.heights(spark.createDataFrame(rows, "route_id int, idx int, lat double, lon double, ele double"), (0.0, 250.0, 499.0, 900.0)).collect()}
    assert set(k[1] for k in got) == {0.0, 250.0, 499.0}

    def height(es, d):
        known = [(100.0 * i, e) for i, e in enumerate(es) if e is not None]
        if not known:
            return None
        for (a, x), (b, y) in zip(known, known[1:], strict=False):
            if a < d <= b:
                return x + (d - a) / (b - a) * (y - x)
        return known[0][1] if d <= known[0][0] else known[-1][1]

    for (k, d), r in got.items():
        es, top = ele[k], max((100.0 * i for i, e in enumerate(ele[k]) if e is not None), default=None)
        if top is None:
            assert (r["ele"], r["grade"], r["chart_grade"]) == (None, None, None)
            continue
        lo, hi = max(0, d - 50), min(500, d + 50)
        assert r["ele"] == pytest.approx(height(es, d), abs=1e-6) and r["grade"] == pytest.approx(100 * (height(es, hi) - height(es, lo)) / (hi - lo), abs=1e-6)
        lo, hi = max(0, d - 160), min(top, d + 160)
        assert r["chart_grade"] == pytest.approx(100 * (height(es, hi) - height(es, lo)) / (hi - lo) if hi > lo else 0, abs=1e-6)


def test_fingerprint(spark):
    cols = "race_key string, year int, median double, dnf long, starters long, starters_with_sex long, starters_f long"
    rows = [("a", 2001, 100.0, 10, 100, 90, 45), ("b", 2002, 200.0, 30, 300, 200, 50), ("c", 2003, None, 5, 50, 50, 10), ("d", 2004, 300.0, 40, 200, 190, 95)]
    pairs = [(a[0], b[0], {a[0], b[0]} != {"b", "d"}) for a in rows for b in rows]
    e, p = spark.createDataFrame(rows, cols), spark.createDataFrame(pairs, "a string, b string, comparable boolean")
    d = {r["race_key"]: r for r in compare.fingerprint(e, p).collect()}
    assert (d["d"]["earlier"], d["d"]["median_index"], d["d"]["dnf_index"]) == (3, None, None)  # only a compares and has a median
    assert d["d"]["starters_index"] == 200.0 and d["d"]["women_index"] == pytest.approx(100 * 0.5 / 0.35)  # b's sexes are too few
    assert d["b"]["starters_index"] is None and d["c"]["median_index"] is None
    d = {r["race_key"]: r for r in compare.fingerprint(e, p.withColumn("comparable", F.lit(True))).collect()}
    assert d["d"]["median_index"] == 200.0 and d["d"]["dnf_index"] == pytest.approx(200.0) and d["c"]["dnf_index"] == pytest.approx(100.0)


def test_segment_trend(spark):
    rows = [("a", "start", "cp1", 20.0, 5.0), ("b", "start", "cp1", 20.15, 6.0), ("c", "start", "cp1", 20.16, 7.0), ("d", "start", "cp1", None, 8.0), ("e", "start", "cp1", 20.0, 9.0), ("b", "start", "cp2", 20.0, 1.0)]
    stats = spark.createDataFrame(rows, "race_key string, from_key string, to_key string, distance_km double, pace_median double")
    pairs = spark.createDataFrame([("a", k, k != "e") for k in "abcde"], "reference string, race_key string, comparable boolean")
    got = {r["race_key"]: r["pace_median"] for r in compare.segment_trend(stats, pairs, 0.1501).collect()}
    assert got == {"a": 5.0, "b": 6.0, "c": None, "d": None, "e": None}
