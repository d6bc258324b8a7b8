"""Routes of a family compared with each other, and landmarks on them."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelab.operators import geo as g
from racelab.operators import routes as rt
from racelab.plans.base import Book, Data
from racelab.plans.geo import HAVERSINE, MEASURED, resampled_sql
from racelab.sources.shared import stored

book = Book()
query = book.query

#: Metres between samples of the plain series and of corridors, of pooled overlaps, and the parts of a benchmark.
COARSE, FINE, OVERLAP, BENCHMARK = 500, 50, 100, 10
#: Routes are compared that lie within so many metres of each other over so much of their samples.
CORRIDOR, LEAST_SHARE, LEAST_POOLED = 100.0, 0.7, 0.9
METRES, NEAR_METRES = (25, 50, 100, 250), (10, 25, 50, 100, 250)

_D = HAVERSINE.format(a="x.lat", b="x.lon", c="y.lat", d="y.lon")
_ALL = f"e AS MATERIALIZED (SELECT x.route_id AS a, y.route_id AS b, round(x.along_m, 3) AS along_m, round(min({_D}), 3) AS separation FROM r x JOIN r y ON x.family = y.family AND x.route_id <> y.route_id GROUP BY 1, 2, x.along_m)"


def _share(m: float) -> str:
    return f"avg(CASE WHEN separation <= {m} THEN 1.0::DOUBLE ELSE 0 END)"


def _both(step: int, reach: float = CORRIDOR) -> str:
    """SQL: n has both ways of the pairs that share so much both ways, of all pairs of a family."""
    return f"""r AS MATERIALIZED ({resampled_sql(step)}), {_ALL}, s AS (SELECT a, b, round({_share(reach)}, 4) AS s FROM e GROUP BY 1, 2),
p AS (SELECT x.a, x.b FROM s x JOIN s y ON x.a = y.b AND x.b = y.a WHERE least(x.s, y.s) >= {LEAST_SHARE}), n AS MATERIALIZED (SELECT e.* FROM e SEMI JOIN p ON e.a = p.a AND e.b = p.b)"""


_POOLED = f"""r AS MATERIALIZED ({resampled_sql(OVERLAP)}), {_ALL}, q AS MATERIALIZED (SELECT least(a, b) AS a, greatest(a, b) AS b, separation FROM e),
p AS (SELECT a, b FROM q GROUP BY 1, 2 HAVING round({_share(CORRIDOR)}, 4) >= {LEAST_POOLED}), n AS MATERIALIZED (SELECT q.* FROM q SEMI JOIN p ON q.a = p.a AND q.b = p.b)"""


#: SQL: n has both ways of all pairs of a family.
_WHOLE = f"r AS MATERIALIZED ({resampled_sql(OVERLAP)}), {_ALL}, n AS (SELECT least(a, b) AS a, greatest(a, b) AS b, separation FROM e)"


def sampled(points: DataFrame, step: float) -> DataFrame:
    return g.resampled(points, float(step)).withColumn("along_m", F.round("along_m", 3))


@query(f"WITH {_both(COARSE, 250)} SELECT * FROM n")
def geo_nearest_series(d: Data) -> DataFrame:
    """Both ways: each sample's metres to the other route's nearest sample, however far, for pairs within 250 m mostly."""
    courses, near = rt.distinct(d.points), (250.0, LEAST_SHARE)
    of_pair = lambda a, b, there, back: [(a.at, there)] if rt.alike(there, back, *near) else []
    met = rt.all_pairs(sampled(courses.points, COARSE), ["along_m"], courses.routes, "along_m array<double>, separation array<double>", of_pair, *near)
    x = rt.of_all(met, courses.members, directed=True).select("a", "b", F.inline(F.arrays_zip("along_m", "separation")))
    return x.withColumn("separation", F.when(~F.isnan("separation"), F.col("separation")))


@query(f"WITH {_both(COARSE, 250)} SELECT a, b, count(*) AS points, count(*) FILTER (WHERE separation <= 250) AS near, min(separation) AS closest, max(separation) AS farthest FROM n GROUP BY 1, 2")
def jn_nearest_neighbor(d: Data) -> DataFrame:
    courses, near = rt.distinct(d.points), (250.0, LEAST_SHARE)

    def of_pair(a: rt.Line, b: rt.Line, there: np.ndarray, back: np.ndarray) -> list[tuple]:
        return [(len(there), np.count_nonzero(there <= 250), *rt.quantiles(there, 0.0, 1.0))] if rt.alike(there, back, *near) else []

    met = rt.all_pairs(sampled(courses.points, COARSE), ["along_m"], courses.routes, "points long, near long, closest double, farthest double", of_pair, *near)
    return rt.of_all(met, courses.members, directed=True)


_ENDS = f"l AS (SELECT route_id, max(cum_m) AS m, arg_min(lat, idx) AS la0, arg_min(lon, idx) AS lo0, arg_max(lat, idx) AS la1, arg_max(lon, idx) AS lo1 FROM ({MEASURED}) GROUP BY 1)"
_HASH = """SELECT route_id, sha256(string_agg({at}, ';' ORDER BY idx)) AS hash FROM f_route_points GROUP BY 1"""
_AT = "CAST(floor({c} * {u} + 0.5::DOUBLE) AS BIGINT)"
_POINT = f"{_AT.format(c='lat', u=10**7)} || ',' || {_AT.format(c='lon', u=10**7)} || ',' || coalesce(CAST({_AT.format(c='ele', u=100)} AS VARCHAR), '')"
_PLACE = f"{_AT.format(c='lat', u=10**5)} || ',' || {_AT.format(c='lon', u=10**5)}"
_APART = HAVERSINE.format(a="x.la{i}", b="x.lo{i}", c="y.la{i}", d="y.lo{i}")
_FIGURES = ("points", "median", "p95", "most", *(f"within_{m}" for m in METRES))
_ONE = "count(*) AS points, quantile_cont(separation, 0.5) AS median, quantile_cont(separation, 0.95) AS p95, max(separation) AS most, " + ", ".join(f"{_share(m)} AS within_{m}" for m in METRES)
_CLASS = """CASE WHEN hash_equal THEN 'exact' WHEN within_50_least >= 0.98{d} AND abs(mb - ma) <= 500 AND start_m <= 100 AND finish_m <= 100 THEN 'strong'
  WHEN within_100_least >= 0.95{d} THEN 'largely' WHEN within_100_least >= 0.7{d} THEN 'substantial' ELSE 'different' END"""
_PAIR = f"""WITH {_both(FINE)}, {_ENDS}, h AS ({_HASH.format(at=_POINT)}), one AS (SELECT a, b, {_ONE} FROM n GROUP BY 1, 2)
SELECT *, {_CLASS.format(d="::DOUBLE")} AS class FROM (SELECT u.a, u.b, {", ".join(f"u.{f} AS {f}_a, v.{f} AS {f}_b" for f in _FIGURES)},
  {", ".join(f"round(least(u.within_{m}, v.within_{m}), 4) AS within_{m}_least, round((u.within_{m} + v.within_{m}) / 2, 4) AS within_{m}_mean" for m in METRES)},
  x.m AS ma, y.m AS mb, round({_APART.format(i=0)}, 3) AS start_m, round({_APART.format(i=1)}, 3) AS finish_m, hx.hash = hy.hash AS hash_equal
  FROM one u JOIN one v ON u.a = v.b AND u.b = v.a AND u.a < u.b JOIN l x ON x.route_id = u.a JOIN l y ON y.route_id = u.b JOIN h hx ON hx.route_id = u.a JOIN h hy ON hy.route_id = u.b)"""


def _one_way(metres: np.ndarray) -> list:
    return [len(metres), *rt.quantiles(metres, 0.5, 0.95, 1.0), *(rt.covered(metres, m) for m in METRES)]


def _corridor(a: rt.Line, b: rt.Line, there: np.ndarray, back: np.ndarray) -> list[tuple]:
    """Both ways' figures in turn; a pair's second row would only repeat them."""
    if a.id > b.id and not b.copied or not rt.alike(there, back, CORRIDOR, LEAST_SHARE):
        return []
    return [tuple(f for both in zip(_one_way(there), _one_way(back), strict=True) for f in both)]


def corridor(d: Data) -> DataFrame:
    """Pairs a < b with separations and shares each way, their least and mean, lengths, ends and a class.

    A pair without a row is different: it doesn't share the corridor that the lowest class asks for.
    """
    courses = rt.distinct(d.points)
    columns = ", ".join(f"{f}_{w} {'long' if f == 'points' else 'double'}" for f in _FIGURES for w in "ab")
    wide = rt.all_pairs(sampled(courses.points, FINE), ["along_m"], courses.routes, columns, _corridor, CORRIDOR, LEAST_SHARE)
    least = {f"within_{m}_least": F.round(F.least(f"within_{m}_a", f"within_{m}_b"), 4) for m in METRES}
    mean = {f"within_{m}_mean": F.round((F.col(f"within_{m}_a") + F.col(f"within_{m}_b")) / 2, 4) for m in METRES}
    hashes = rt.geometry_hash(courses.points)
    side = lambda c: hashes.select(F.col("route_id").alias(c), F.col("hash").alias(f"hash_{c}"))
    x = rt.with_ends(wide, courses.points).withColumns(least | mean).join(side("a"), "a").join(side("b"), "b").withColumn("hash_equal", F.col("hash_a") == F.col("hash_b"))
    x = x.drop("hash_a", "hash_b").withColumn("class", F.expr(_CLASS.format(d="D")))
    return rt.of_all(x, courses.members)


_ROUNDED = " ".join([*(f"{f}_{w}" for f in _FIGURES[1:] for w in "ab"), "ma", "mb"])


@query(_PAIR, rounded=_ROUNDED)
def geo_pair_corridor(d: Data) -> DataFrame:
    return corridor(d)


_SHARES = [f"within_{m}_{w}" for m in METRES for w in ("a", "b", "least", "mean")]
_STATS = [f"{f}_{w}" for f in _FIGURES[:4] for w in "ab"]


@query(f"SELECT a, b, {', '.join(_STATS + _SHARES)} FROM ({_PAIR})", rounded=" ".join([*_STATS[2:], *(s for s in _SHARES if s[-2:] in ("_a", "_b"))]))
def geo_corridor_stats(d: Data) -> DataFrame:
    return corridor(d).select("a", "b", *_STATS, *_SHARES)


@query(f"SELECT a, b, round((mb - ma) / 1000, 3) AS longer_km, start_m, finish_m, hash_equal, class FROM ({_PAIR})")
def geo_classify(d: Data) -> DataFrame:
    """By shares within 50 and 100 m both ways, lengths within 500 m and ends within 100 m; or one and the same geometry."""
    return corridor(d).select("a", "b", F.round((F.col("mb") - F.col("ma")) / 1000, 3).alias("longer_km"), "start_m", "finish_m", "hash_equal", "class")


_RUNS = f"""WITH {_both(FINE)}, f AS (SELECT *, separation > 100 AS far FROM n), m AS (SELECT *, CASE WHEN far AND NOT coalesce(lag(far) OVER (PARTITION BY a, b ORDER BY along_m), FALSE) THEN 1 ELSE 0 END AS fresh FROM f),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY a, b ORDER BY along_m) AS run FROM m)
SELECT a, b, min(along_m) AS from_m, max(along_m) AS to_m, count(*) AS points, quantile_cont(separation, 0.5) AS median, max(separation) AS most FROM i WHERE far GROUP BY a, b, run HAVING max(along_m) - min(along_m) >= 300"""


@query(_RUNS, rounded="median")
def geo_divergence(d: Data) -> DataFrame:
    """Both ways: stretches of 300 m and more on which a route's samples, 50 m apart, are all over 100 m from the other."""
    courses, near = rt.distinct(d.points), (CORRIDOR, LEAST_SHARE)
    of_pair = lambda a, b, there, back: rt.stretches_apart(a.at, there, 100.0, 300.0) if rt.alike(there, back, *near) else []
    met = rt.all_pairs(sampled(courses.points, FINE), ["along_m"], courses.routes, "from_m double, to_m double, points long, median double, most double", of_pair, *near)
    return rt.of_all(met, courses.members, directed=True)


@query(_RUNS, rounded="median")
def geo_pair_divergence(d: Data) -> DataFrame:
    return geo_divergence(d)


_OVER = "count(*) AS points, " + ", ".join(f"round({_share(m)}, 4) AS within_{m}" for m in NEAR_METRES) + ", quantile_cont(separation, 0.5) AS median, quantile_cont(separation, 0.95) AS p95, max(separation) AS most"
_HINT = "CASE WHEN within_50 >= 0.98{d} THEN 'same' WHEN within_50 >= 0.95{d} THEN 'near' WHEN within_100 >= 0.9{d} THEN 'similar' ELSE 'different' END"


_OVERLAP_COLUMNS = "points long, " + ", ".join(f"within_{m} double" for m in NEAR_METRES) + ", median double, p95 double, most double"


def _overlap(a: rt.Line, b: rt.Line, there: np.ndarray, back: np.ndarray, least: float = 0.0) -> list[tuple]:
    """Both ways pooled, shares to four places; a pair's second row would only repeat them."""
    if a.id > b.id and not b.copied:
        return []
    both = np.concatenate([there, back])
    if rt.four(rt.covered(both, CORRIDOR)) < least:
        return []
    return [(len(both), *(rt.four(rt.covered(both, m)) for m in NEAR_METRES), *rt.quantiles(both, 0.5, 0.95, 1.0))]


def overlap(d: Data, least: float = 0.0) -> tuple[rt.Distinct, DataFrame]:
    """Courses, samples 100 m apart, both ways pooled, of every pair of a family, or of those that share so much."""
    courses = rt.distinct(d.points)
    of_pair = lambda *pair: _overlap(*pair, least)
    return courses, rt.all_pairs(sampled(courses.points, OVERLAP), ["along_m"], courses.routes, _OVERLAP_COLUMNS, of_pair)


@query(f"WITH {_WHOLE} SELECT a, b, {_OVER} FROM n GROUP BY 1, 2", rounded="median p95")
def geo_within_share(d: Data) -> DataFrame:
    courses, met = overlap(d)
    return rt.of_all(met, courses.members)


@query(f"WITH {_WHOLE}, o AS (SELECT a, b, {_OVER} FROM n GROUP BY 1, 2) SELECT a, b, within_50, within_100, {_HINT.format(d='::DOUBLE')} AS hint FROM o")
def geo_overlap_hint(d: Data) -> DataFrame:
    courses, met = overlap(d)
    return rt.of_all(met.select("a", "b", "within_50", "within_100", F.expr(_HINT.format(d="D")).alias("hint")), courses.members)


@query(f"WITH {_POOLED}, {_ENDS}, o AS (SELECT a, b, {_OVER} FROM n GROUP BY 1, 2) SELECT o.*, x.m AS ma, y.m AS mb, round({_APART.format(i=0)}, 3) AS start_m, round({_APART.format(i=1)}, 3) AS finish_m, {_HINT.format(d='::DOUBLE')} AS hint FROM o JOIN l x ON x.route_id = a JOIN l y ON y.route_id = b", rounded="median p95 ma mb")
def geo_pair_overlap(d: Data) -> DataFrame:
    """Pairs within 100 m over 0.9 of the samples of both; a pair without a row is different."""
    courses, met = overlap(d, LEAST_POOLED)
    return rt.of_all(rt.with_ends(met, courses.points).withColumn("hint", F.expr(_HINT.format(d="D"))), courses.members)


_DENSE = f"""SELECT route_id, family, idx, part, CASE WHEN part = parts THEN lat ELSE lat0 + part / parts * (lat - lat0) END AS lat, CASE WHEN part = parts THEN lon ELSE lon0 + part / parts * (lon - lon0) END AS lon
FROM (SELECT *, unnest(range(1, parts + 1)) AS part FROM (SELECT *, CASE WHEN lat0 IS NULL THEN 1 ELSE greatest(CAST(ceil(leg / {BENCHMARK}) AS BIGINT), 1) END AS parts FROM (SELECT *, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM ({MEASURED}) WINDOW w AS (PARTITION BY route_id ORDER BY idx))))"""


@query(f"""WITH r AS MATERIALIZED ({_DENSE}), t AS (SELECT family, min(route_id) AS truth FROM r GROUP BY 1), {_ENDS},
w AS (SELECT x.route_id AS a, t.truth AS b, x.idx, x.part, min({_D}) AS separation FROM r x JOIN t USING (family) JOIN r y ON y.route_id = t.truth WHERE x.route_id <> t.truth GROUP BY ALL
  UNION ALL SELECT y.route_id, t.truth, x.idx, x.part, min({_D}) FROM r x JOIN t ON x.route_id = t.truth JOIN r y ON y.family = x.family WHERE y.route_id <> t.truth GROUP BY ALL)
SELECT a, b, round(x.m / 1000, 3) AS km, round(y.m / 1000, 3) AS truth_km, round(100.0::DOUBLE * (x.m - y.m) / nullif(y.m, 0), 2) AS length_error_pct, points, p50, p95, within_10, within_25, within_50
FROM (SELECT a, b, count(*) AS points, quantile_disc(round(separation, 3), 0.5) AS p50, quantile_disc(round(separation, 3), 0.95) AS p95, {", ".join(f"round(avg(CASE WHEN round(separation, 3) <= {m} THEN 1.0::DOUBLE ELSE 0 END), 4) AS within_{m}" for m in (10, 25, 50))} FROM w GROUP BY 1, 2)
JOIN l x ON x.route_id = a JOIN l y ON y.route_id = b""")
def geo_benchmark(d: Data) -> DataFrame:
    """Every route against its family's reference route, the one with the smallest id: legs in parts of 10 m, both ways pooled."""
    courses = rt.distinct(d.points)

    def of_pair(a: rt.Line, b: rt.Line, there: np.ndarray, back: np.ndarray) -> list[tuple]:
        both = np.concatenate([there, back])
        return [(len(both), *rt.nearest_ranks(both, 0.5, 0.95), *(rt.four(rt.covered(both, m)) for m in (10, 25, 50)))] if b.side == -1 else []

    x = rt.against_first(g.densified(courses.points, float(BENCHMARK)), ["idx", "part"], courses.routes, "points long, p50 double, p95 double, within_10 double, within_25 double, within_50 double", of_pair)
    km = lambda c: F.round(F.col(c) / 1000, 3)
    error = F.round(100.0 * (F.col("ma") - F.col("mb")) / F.nullif(F.col("mb"), F.lit(0.0)), 2)
    x = rt.with_ends(x, courses.points).select("a", "b", km("ma").alias("km"), km("mb").alias("truth_km"), error.alias("length_error_pct"), "points", "p50", "p95", "within_10", "within_25", "within_50")
    # the reference is the route itself, not those that share its course
    own = courses.members.select(F.col("same").alias("a"), F.explode("ids").alias("route"))
    return x.join(own, "a").where("route <> b").select(F.col("route").alias("a"), *x.columns[1:])


@query()
def geo_pair_benchmark(d: Data) -> DataFrame:
    """Each route of a similar pair against the other ``b``, legs in parts of 10 m, both ways pooled: nearest ranks and shares."""
    courses = rt.distinct(d.points)

    def of_pair(a: rt.Line, b: rt.Line, there: np.ndarray, back: np.ndarray) -> list[tuple]:
        if a.id > b.id and not b.copied or not rt.alike(there, back, CORRIDOR, LEAST_SHARE):
            return []
        both = np.concatenate([there, back])
        return [(len(both), *(rt.covered(both, m) for m in (10, 25, 50)), *rt.nearest_ranks(both, 0.5, 0.95))]

    columns = "points long, within_10 double, within_25 double, within_50 double, p50 double, p95 double"
    x = rt.all_pairs(g.densified(courses.points, float(BENCHMARK)), ["idx", "part"], courses.routes, columns, of_pair, CORRIDOR, LEAST_SHARE)
    x = rt.with_ends(x, courses.points).withColumn("length_error_pct", F.round(100 * (F.col("ma") - F.col("mb")) / F.nullif(F.col("mb"), F.lit(0.0)), 4)).drop("start_m", "finish_m")
    return rt.of_all(x, courses.members)


@query(f"SELECT p.route_id, p.hash AS fingerprint, q.hash AS point_hash FROM ({_HASH.format(at=_PLACE)}) p JOIN ({_HASH.format(at=_POINT)}) q USING (route_id)")
def geo_fingerprint(d: Data) -> DataFrame:
    """Hashes of a route's ordered coordinates: in hundred-thousandths of a degree, and to seven places with elevation."""
    rough = rt.geometry_hash(d.points, 5, elevation=False).withColumnRenamed("hash", "fingerprint")
    return rough.join(rt.geometry_hash(d.points).withColumnRenamed("hash", "point_hash"), "route_id")


REACH = 500.0
_OFF = "round(sqrt(pow(ax + fraction * vx, 2) + pow(ay + fraction * vy, 2)), 3)"
_QUALITY = "CASE WHEN off_m <= 25 THEN 'excellent' WHEN off_m <= 75 THEN 'good' WHEN off_m <= 200 THEN 'review' ELSE 'poor' END"
_RAD = "radians({a} - {b}) * 6371008.8::DOUBLE"


@query(f"""WITH s AS (SELECT route_id, family, CAST(idx - 2 AS INTEGER) AS segment, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lat AS lat1, lon AS lon1, lag(cum_m) OVER w AS m0, cum_m AS m1 FROM ({MEASURED}) WINDOW w AS (PARTITION BY route_id ORDER BY idx) QUALIFY idx > 1),
j AS (SELECT *, {_RAD.format(a="lon0", b="l.lon")} * cos(radians(l.lat)) AS ax, {_RAD.format(a="lat0", b="l.lat")} AS ay, {_RAD.format(a="lon1", b="l.lon")} * cos(radians(l.lat)) AS gx, {_RAD.format(a="lat1", b="l.lat")} AS gy FROM f_landmarks l JOIN s USING (family)),
v AS (SELECT *, gx - ax AS vx, gy - ay AS vy FROM j), t AS (SELECT *, CASE WHEN vx * vx + vy * vy > 0 THEN greatest(0.0::DOUBLE, least(1.0::DOUBLE, -(ax * vx + ay * vy) / (vx * vx + vy * vy))) ELSE 0 END AS fraction FROM v),
o AS (SELECT *, {_OFF} AS off_m, m0 + fraction * (m1 - m0) AS m FROM t)
SELECT landmark, title, route_id, off_m, round(m / 1000, 3) AS km, segment, round(fraction, 4) AS fraction, {_QUALITY} AS quality FROM o WHERE off_m <= {REACH} QUALIFY row_number() OVER (PARTITION BY landmark, route_id ORDER BY off_m, segment) = 1""")
def geo_project_point(d: Data) -> DataFrame:
    """All landmarks on all routes of their family: offset, kilometre, segment, place in it, quality; no row beyond 500 m."""
    courses, at = rt.distinct(d.points), ["family", "lat", "lon"]
    places = d.landmarks.groupBy(*at).agg(F.min("landmark").alias("landmark"))
    found = stored(rt.projected(places, rt.segments(courses.points, ["family"]), ["family"], REACH))
    figures = found.select("landmark", "route_id", "off_m", F.round(F.col("m") / 1000, 3).alias("km"), "segment", F.round("fraction", 4).alias("fraction"), rt.projection_quality(F.col("off_m")).alias("quality"))
    x = rt.spread(figures, {"route_id": courses.members, "landmark": rt.gathered(d.landmarks, at, "landmark", "landmark", "title")})
    return x.select("landmark.landmark", "landmark.title", "route_id", "off_m", "km", "segment", "fraction", "quality")


_STEPS = f"SELECT *, ele - lag(ele) OVER (PARTITION BY route_id ORDER BY idx) AS step FROM ({MEASURED})"
_CLIMB = "CASE WHEN count(ele) > 0 THEN round(coalesce(sum(CASE WHEN {v} > 0 THEN {v} END), 0), 4) END"


@query(f"""SELECT i.*, h.hash AS sha256 FROM (SELECT route_id, count(*) AS points, round(max(cum_m) / 1000, 4) AS km, arg_min(lat, idx) AS start_lat, arg_min(lon, idx) AS start_lon, arg_max(lat, idx) AS finish_lat, arg_max(lon, idx) AS finish_lon,
  count(ele) AS with_ele, {_CLIMB.format(v="step")} AS raw_ascent, {_CLIMB.format(v="-step")} AS raw_descent FROM ({_STEPS}) GROUP BY 1) i JOIN ({_HASH.format(at=_POINT)}) h ON h.route_id = i.route_id""")
def geo_inventory(d: Data) -> DataFrame:
    return rt.inventory(d.points).withColumns({c: F.round(c, 4) for c in ("km", "raw_ascent", "raw_descent")})


@query("SELECT *, round(degrees(atan(sinh((asinh(tan(radians(south))) + asinh(tan(radians(north)))) / 2))), 8) AS centre_lat, (west + east) / 2 AS centre_lon FROM (SELECT family, route_id, min(lat) AS south, max(lat) AS north, min(lon) AS west, max(lon) AS east FROM f_route_points GROUP BY ROLLUP (family, route_id))")
def geo_bounds(d: Data) -> DataFrame:
    """Boxes and centres of each route, family and all."""
    return rt.bounds(d.points, "family", "route_id").withColumn("centre_lat", F.round("centre_lat", 8))


#: Stretches of a route in metres.
STRETCHES = {"whole": (0.0, 1e9), "first": (0.0, 1000.0), "middle": (2500.0, 1000.0)}
_OK = "count(ele) >= 2 AND count(ele) >= 0.9::DOUBLE * count(*)"


@query(f"""SELECT route_id, stretch, {", ".join(f"CASE WHEN {_OK} THEN {v} END AS {n}" for n, v in {"ascent": "round(coalesce(sum(CASE WHEN step > 0 THEN step END), 0), 4)", "descent": "round(coalesce(sum(CASE WHEN step < 0 THEN -step END), 0), 4)", "lowest": "min(ele)", "highest": "max(ele)", "length_m": "round(max(cum_m) FILTER (WHERE ele IS NOT NULL) - min(cum_m) FILTER (WHERE ele IS NOT NULL), 3)"}.items())},
  count(ele) / count(*) AS coverage FROM (SELECT *, ele - lag(ele) OVER (PARTITION BY route_id, stretch ORDER BY idx) AS step FROM ({MEASURED}) JOIN (VALUES {", ".join(f"('{n}', {min(s)}::DOUBLE, {max(s)}::DOUBLE)" for n, s in STRETCHES.items())}) s(stretch, a, b) ON cum_m BETWEEN a AND b) GROUP BY 1, 2""")
def geo_terrain(d: Data) -> DataFrame:
    return rt.terrain_on(d.points, STRETCHES).withColumns({"ascent": F.round("ascent", 4), "descent": F.round("descent", 4), "length_m": F.round("length_m", 3)})


_ANCHOR = HAVERSINE.format(a="p.lat", b="p.lon", c="a.lat", d="a.lon")


@query(f"""WITH a AS (SELECT landmark, route_id, l.lat, l.lon, 40.0::DOUBLE + s_nationkey * 10 AS max_offset_m FROM f_landmarks l JOIN supplier ON s_suppkey = landmark JOIN (SELECT DISTINCT route_id, family FROM f_route_points) r ON r.family = l.family AND route_id % 25 = s_nationkey),
n AS (SELECT a.landmark, a.route_id, min({{'off': round({_ANCHOR}, 3), 'idx': p.idx, 'm': p.cum_m}}) AS s FROM a JOIN ({MEASURED}) p ON p.route_id = a.route_id GROUP BY 1, 2)
SELECT a.landmark, a.route_id, s.idx AS idx, round(s.m / 1000, 3) AS km, s.off AS offset_m, s.off <= max_offset_m AS ok FROM a JOIN n ON n.landmark = a.landmark AND n.route_id = a.route_id""")
def geo_anchor_nearest(d: Data) -> DataFrame:
    """Landmarks on the routes that they are assigned, by family and the nation that lays the route out."""
    nation = d.table("supplier").select(F.col("s_suppkey").alias("landmark"), F.col("s_nationkey").cast("long").alias("nation"))
    courses = rt.distinct(d.points.withColumn("nation", F.col("route_id") % 25), ["family", "nation"])
    marks, at = d.landmarks.join(nation, "landmark"), ["family", "nation", "lat", "lon"]
    places = marks.groupBy(*at).agg(F.min("landmark").alias("landmark"))
    assigned = places.join(courses.points.select("route_id", "family", "nation").distinct(), ["family", "nation"]).withColumn("max_offset_m", 40.0 + F.col("nation") * 10)
    x = stored(rt.snapped(assigned, courses.points, "landmark").withColumn("km", F.round("km", 3)))
    x = rt.spread(x, {"route_id": courses.members, "landmark": rt.gathered(marks, at, "landmark", "landmark")})
    return x.select("landmark.landmark", "route_id", "idx", "km", "offset_m", "ok")


_TRACES = "SELECT route_id, idx, lat, lon, ele FROM f_route_points UNION ALL SELECT -1 - route_id, idx, lat + CASE WHEN route_id % 4 = 0 AND idx = 5 THEN 0.0001::DOUBLE ELSE 0 END, lon, ele FROM f_route_points"


def traces(d: Data) -> DataFrame:
    """Routes, and each of them published again under another id; of some a point was moved."""
    moved = F.when((F.col("route_id") % 4 == 0) & (F.col("idx") == 5), 0.0001).otherwise(0.0)
    again = d.points.withColumns({"lat": F.col("lat") + moved, "route_id": -1 - F.col("route_id")})
    return d.points.unionByName(again)


@query(f"""WITH t AS MATERIALIZED ({_TRACES}), h AS ({_HASH.format(at=_POINT).replace("f_route_points", "t")}), m AS (SELECT route_id, max(cum_m) / 1000 AS km, max(idx) AS n FROM ({MEASURED}) GROUP BY 1),
p AS (SELECT m.route_id, unnest(CASE WHEN m.route_id % 6 = 0 THEN [-1 - m.route_id, m.route_id + 1000000] ELSE [-1 - m.route_id] END) AS peer FROM m),
q AS (SELECT p.route_id, count(*) AS peers, count(*) FILTER (WHERE x.hash = y.hash) AS equal_peers FROM p JOIN h x ON x.route_id = p.route_id LEFT JOIN h y ON y.route_id = p.peer GROUP BY 1)
SELECT route_id, round(km, 3) AS km, abs(m.route_id % 5 - 2) < 2 AS length_ok, peers, equal_peers, abs(m.route_id % 5 - 2) < 2 AND peers = equal_peers AS verified FROM m JOIN q USING (route_id)""")
def geo_verify_peer(d: Data) -> DataFrame:
    """Routes against a manifest of lengths, some of them 100 m off, and of peers, some of which moved or are gone."""
    km = g.measured(d.points).groupBy("route_id").agg((F.max("cum_m") / 1000).alias("km"))
    peers = F.when(F.col("route_id") % 6 == 0, F.array(-1 - F.col("route_id"), F.col("route_id") + 1000000)).otherwise(F.array(-1 - F.col("route_id")))
    manifest = km.select("route_id", (F.col("km") + (F.col("route_id") % 5 - 2) * 0.05).alias("expected_km"), peers.alias("peers"))
    return rt.verified(traces(d), manifest).withColumn("km", F.round("km", 3))


_SAID = "CASE WHEN route_id % 5 <> 0 THEN points * 40.0::DOUBLE END AS said_up, CASE WHEN route_id % 7 <> 0 THEN points * 38.0::DOUBLE END AS said_down"


@query(f"""SELECT route_id, points, round(up, 2) AS ascent, round(down, 2) AS descent, lowest, highest, round(up - said_up, 2) AS ascent_delta, CASE WHEN up - said_up IS NOT NULL THEN round(down - said_down, 2) END AS descent_delta FROM (SELECT *, {_SAID} FROM
  (SELECT route_id, count(*) AS points, {_CLIMB.format(v="step")} AS up, {_CLIMB.format(v="-step")} AS down, min(ele) AS lowest, max(ele) AS highest FROM ({_STEPS}) GROUP BY 1))""")
def geo_elevation_evidence(d: Data) -> DataFrame:
    """Routes beside a manifest that reports 40 m up and 38 m down a point, and of some routes nothing."""
    n = d.points.groupBy("route_id").agg(F.count("*").alias("n"))
    manifest = n.select("route_id", F.when(F.col("route_id") % 5 != 0, F.col("n") * 40.0).alias("ascent"), F.when(F.col("route_id") % 7 != 0, F.col("n") * 38.0).alias("descent"))
    return rt.elevation_evidence(d.points, manifest).withColumns({c: F.round(c, 2) for c in ("ascent", "descent", "ascent_delta", "descent_delta")})


QUERIES, ORACLE = book.queries, book.sql
