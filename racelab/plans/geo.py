"""Routes and positions in time."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import geo as g
from racelab.operators import replay as rp
from racelab.operators import stats as st
from racelab.operators.observations import finished
from racelab.plans.base import Book, Data
from racelab.plans.stats import FIN

book = Book()
query = book.query

HAVERSINE = "2 * 6371008.8::DOUBLE * asin(sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2)))"
_LEG = HAVERSINE.format(a="lag(lat) OVER w", b="lag(lon) OVER w", c="lat", d="lon")
MEASURED = f"SELECT *, sum(leg) OVER (PARTITION BY route_id ORDER BY idx) AS cum_m FROM (SELECT *, coalesce({_LEG}, 0) AS leg FROM f_route_points WINDOW w AS (PARTITION BY route_id ORDER BY idx))"


@query(f"SELECT route_id, idx, round(leg, 4) AS leg FROM ({MEASURED})")
def geo_haversine(d: Data) -> DataFrame:
    return g.measured(d.points).select("route_id", "idx", F.round("leg", 4).alias("leg"))


@query(f"SELECT route_id, idx, round(cum_m, 3) AS cum_m FROM ({MEASURED})")
def win_running_distance(d: Data) -> DataFrame:
    return g.measured(d.points).select("route_id", "idx", F.round("cum_m", 3).alias("cum_m"))


@query("SELECT route_id, CASE WHEN count(ele) = count(*) THEN round(sum(greatest(ele - prev, 0)), 4) END AS whole, round(sum(CASE WHEN ele - prev > 0 THEN ele - prev END), 4) AS pairwise FROM (SELECT *, lag(ele) OVER (PARTITION BY route_id ORDER BY idx) AS prev FROM f_route_points) GROUP BY 1")
def geo_ascent_all_or_nothing(d: Data) -> DataFrame:
    """Ascent of complete profiles only, and over every pair of known neighbours."""
    step = F.col("ele") - F.lag("ele").over(g.along())
    x = d.points.withColumn("step", step)
    return x.groupBy("route_id").agg(
        F.when(F.count("ele") == F.count("*"), F.round(F.sum(F.greatest("step", F.lit(0.0))), 4)).alias("whole"), F.round(F.sum(F.when(F.col("step") > 0, F.col("step"))), 4).alias("pairwise")
    )


def resampled_sql(step: int) -> str:
    return f"""SELECT route_id, family, CAST(k * {step} AS DOUBLE) AS along_m, lat0 + (k * {step} - m0) / (m1 - m0) * (lat - lat0) AS lat, lon0 + (k * {step} - m0) / (m1 - m0) * (lon - lon0) AS lon
FROM (SELECT *, unnest(range(CAST(ceil(m0 / {step}) AS BIGINT), CAST(ceil(m1 / {step}) AS BIGINT))) AS k FROM (SELECT *, lag(cum_m) OVER w AS m0, cum_m AS m1, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0 FROM ({MEASURED}) WINDOW w AS (PARTITION BY route_id ORDER BY idx)) WHERE m1 > m0)
UNION ALL SELECT route_id, family, max(cum_m), arg_max(lat, idx), arg_max(lon, idx) FROM ({MEASURED}) GROUP BY 1, 2"""


@query(f"SELECT route_id, round(along_m, 3) AS along_m, round(lat, 7) AS lat, round(lon, 7) AS lon FROM ({resampled_sql(500)})")
def geo_resample(d: Data) -> DataFrame:
    return g.resampled(d.points, 500.0).select("route_id", F.round("along_m", 3).alias("along_m"), F.round("lat", 7).alias("lat"), F.round("lon", 7).alias("lon"))


@query(f"SELECT route_id, idx, CAST(unnest(range(1, CAST(ceil(leg / 25) AS BIGINT) + 1)) AS INTEGER) AS part, ceil(leg / 25) AS parts FROM ({MEASURED}) WHERE leg > 0")
def geo_densify(d: Data) -> DataFrame:
    """Each leg in parts of 25 metres at most."""
    n = F.ceil(F.col("leg") / 25)
    return g.measured(d.points).where("leg > 0").select("route_id", "idx", F.explode(F.sequence(F.lit(1), n.cast("int"))).alias("part"), n.cast("double").alias("parts"))


@query("SELECT route_id, idx, round(radians(lon - 14) * cos(radians(55.5::DOUBLE)) * 6371008.8::DOUBLE, 4) AS x, round(radians(lat - 55.5::DOUBLE) * 6371008.8::DOUBLE, 4) AS y FROM f_route_points")
def geo_local_xy(d: Data) -> DataFrame:
    x = F.radians(F.col("lon") - 14) * F.cos(F.radians(F.lit(55.5))) * g.EARTH_M
    return d.points.select("route_id", "idx", F.round(x, 4).alias("x"), F.round(F.radians(F.col("lat") - 55.5) * g.EARTH_M, 4).alias("y"))


_R = "6378137.0::DOUBLE"


@query(f"SELECT route_id, idx, round(radians(lon) * {_R}, 3) AS x, round(asinh(tan(radians(lat))) * {_R}, 3) AS y, round(lat, 8) AS lat_back FROM f_route_points")
def geo_mercator_inverse(d: Data) -> DataFrame:
    """Web Mercator and back."""
    y = F.asinh(F.tan(F.radians("lat"))) * 6378137.0
    back = F.degrees(2 * F.atan(F.exp(y / 6378137.0)) - F.pi() / 2)
    return d.points.select("route_id", "idx", F.round(F.radians("lon") * 6378137.0, 3).alias("x"), F.round(y, 3).alias("y"), F.round(back, 8).alias("lat_back"))


@query("SELECT route_id, CAST(floor(lat / 0.0025::DOUBLE) AS BIGINT) AS cy, CAST(floor(lon / 0.0045::DOUBLE) AS BIGINT) AS cx, count(*) AS n FROM f_route_points GROUP BY 1, 2, 3")
def geo_grid_index(d: Data) -> DataFrame:
    return d.points.groupBy("route_id", F.floor(F.col("lat") / g.CELL_LAT).alias("cy"), F.floor(F.col("lon") / g.CELL_LON).alias("cx")).agg(F.count("*").alias("n"))


@query("SELECT route_id, idx, CASE WHEN ele IS NOT NULL THEN quantile_cont(ele, 0.5) OVER (PARTITION BY route_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) END AS smooth FROM f_route_points")
def win_median7(d: Data) -> DataFrame:
    w = g.along().rowsBetween(-3, 3)
    return d.points.select("route_id", "idx", F.when(F.col("ele").isNotNull(), F.percentile("ele", F.lit(0.5)).over(w)).alias("smooth"))


_THIN = f"""SELECT route_id, unnest(kept).idx AS idx, round(unnest(kept).cum_m, 3) AS cum_m FROM (SELECT route_id, list_reduce(list([{{'idx': idx, 'cum_m': cum_m, 'final': idx = n}}] ORDER BY idx),
  lambda acc, x: CASE WHEN x[1].cum_m - acc[-1].cum_m >= 50 OR x[1].final THEN list_concat(acc, x) ELSE acc END) AS kept FROM (SELECT *, max(idx) OVER (PARTITION BY route_id) AS n FROM ({MEASURED})) GROUP BY 1)"""


def thinned(points: DataFrame, step: float) -> DataFrame:
    """(route_id, idx, cum_m): the first point, each that is ``step`` metres or more after the last kept one, and the last.

    A route's points are looked at in turn, so a route is one group: its size is that of a course, not of the table.
    """

    def keep(route: pd.DataFrame) -> pd.DataFrame:
        route = route.sort_values("idx", ignore_index=True)
        metres, at, chosen = route["cum_m"].to_numpy(), 0, []
        while at < len(metres):
            chosen.append(at)
            at = int(np.searchsorted(metres, metres[at], "right"))
            while at < len(metres) and metres[at] - metres[chosen[-1]] < step:
                at += 1
        if chosen[-1] != len(metres) - 1:
            chosen.append(len(metres) - 1)
        return route.loc[chosen]

    kept = g.measured(points).select("route_id", "idx", "cum_m")
    return kept.groupBy("route_id").applyInPandas(keep, kept.schema)


@query(_THIN)
def win_thin_50m(d: Data) -> DataFrame:
    return thinned(d.points, 50.0).withColumn("cum_m", F.round("cum_m", 3))


@query(f"SELECT t.route_id, t.idx, cum_m, CASE WHEN ele IS NOT NULL THEN smooth END AS smooth FROM ({_THIN}) t JOIN (SELECT route_id, idx, ele, quantile_cont(ele, 0.5) OVER (PARTITION BY route_id ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING) AS smooth FROM f_route_points) m USING (route_id, idx)")
def geo_elevation_profile(d: Data) -> DataFrame:
    """Points 50 m apart with the median of seven elevations; unknown ones stay null."""
    return win_thin_50m(d).join(win_median7(d), ["route_id", "idx"])


@query("SELECT route_id, min(idx) AS from_idx, max(idx) AS to_idx, count(*) AS points FROM (SELECT *, idx - row_number() OVER (PARTITION BY route_id ORDER BY idx) AS run FROM f_route_points WHERE ele IS NULL) GROUP BY route_id, run")
def win_gaps_islands(d: Data) -> DataFrame:
    """Maximal runs of points without elevation."""
    w = g.along()
    lost = d.points.withColumn("gone", F.col("ele").isNull())
    fresh = (F.col("gone") & ~F.coalesce(F.lag("gone").over(w), F.lit(False))).cast("int")
    runs = lost.withColumn("fresh", fresh).withColumn("run", F.sum("fresh").over(w)).where("gone")
    return runs.groupBy("route_id", "run").agg(F.min("idx").alias("from_idx"), F.max("idx").alias("to_idx"), F.count("*").alias("points")).drop("run")


@query("SELECT route_id, round(sum(sqrt(pow(x - px, 2) + pow(y - py, 2))), 4) AS length FROM (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py FROM (SELECT route_id, idx, 2.0::DOUBLE * idx + 0.5::DOUBLE * family + 10 AS x, -0.5::DOUBLE * idx + 2.0::DOUBLE * family + 20 AS y FROM f_route_points) WINDOW w AS (PARTITION BY route_id ORDER BY idx)) WHERE px IS NOT NULL GROUP BY 1")
def geo_affine(d: Data) -> DataFrame:
    """Pixels by an affine map, and the length in the plane."""
    px, py, w = F.col("idx"), F.col("family"), g.along()
    xy = d.points.select("route_id", "idx", (2.0 * px + 0.5 * py + 10).alias("x"), (-0.5 * px + 2.0 * py + 20).alias("y"))
    step = F.sqrt(F.pow(F.col("x") - F.lag("x").over(w), 2) + F.pow(F.col("y") - F.lag("y").over(w), 2))
    return xy.withColumn("step", step).groupBy("route_id").agg(F.round(F.sum("step"), 4).alias("length"))


@query(f"SELECT route_id, third, round(ascent / nullif(km, 0), 3) AS per_km FROM (SELECT route_id, CAST(ntile AS INTEGER) AS third, sum(greatest(coalesce(ele - prev, 0), 0)) AS ascent, sum(leg) / 1000 AS km FROM (SELECT *, ntile(3) OVER w AS ntile, lag(ele) OVER w AS prev FROM ({MEASURED}) WINDOW w AS (PARTITION BY route_id ORDER BY idx)) GROUP BY 1, 2)")
def seg_climb_intensity(d: Data) -> DataFrame:
    """Ascent for each kilometre by thirds of a route."""
    w = g.along()
    x = g.measured(d.points).select("route_id", "leg", F.ntile(3).over(w).alias("third"), (F.col("ele") - F.lag("ele").over(w)).alias("step"))
    return x.groupBy("route_id", "third").agg(F.round(F.sum(F.greatest(F.coalesce("step", F.lit(0.0)), F.lit(0.0))) / F.nullif(F.sum("leg") / 1000, F.lit(0.0)), 3).alias("per_km"))


# positions in time -----------------------------------------------------------------------------------------------

def anchors_sql(source: str, key: str) -> str:
    return f"SELECT race_key, {key}, seconds AS t, km FROM (SELECT *, max(seconds) OVER (PARTITION BY race_key, {key} ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM ({source}) WHERE seconds IS NOT NULL) WHERE seconds > coalesce(top, -1)"


def positions_sql(source: str, key: str) -> str:
    return f"""SELECT race_key, {key}, g.t, CASE WHEN g.t >= max(a.t) THEN max(a.km) ELSE max(CASE WHEN a.t <= g.t AND a.nt > g.t THEN a.km + (g.t - a.t) / (a.nt - a.t) * (a.nkm - a.km) END) END AS km
FROM (SELECT *, lead(t) OVER w AS nt, lead(km) OVER w AS nkm FROM ({anchors_sql(source, key)}) WINDOW w AS (PARTITION BY race_key, {key} ORDER BY t)) a, (VALUES {", ".join(f"({t}::DOUBLE)" for t in _TIMES)}) g(t) GROUP BY race_key, {key}, g.t HAVING min(a.t) <= g.t"""


_TIMES = (1200, 3600, 7200)
_ANCH, _AT = anchors_sql("SELECT * FROM f_obs", "rid"), positions_sql("SELECT * FROM f_obs", "rid")


def anchors(d: Data) -> DataFrame:
    """(race_key, rid, t, km): observations later than all before them."""
    return d.laid.select("race_key", "rid", F.inline(rp.row_anchors(F.col("observed"))))


def positions(d: Data) -> DataFrame:
    return rp.positions(d.laid, _TIMES).select("race_key", "rid", "t", "km")


@query(_ANCH)
def rep_anchors(d: Data) -> DataFrame:
    return anchors(d)


@query(f"SELECT race_key, rid, t, round(km, 6) AS km FROM ({_AT})")
def rep_distance_at_time(d: Data) -> DataFrame:
    return positions(d).withColumn("km", F.round("km", 6))


@query(f"SELECT race_key, rid, t, round(least(greatest(km, 1), 50), 6) AS km FROM ({_AT})")
def rep_distance_clamped(d: Data) -> DataFrame:
    return positions(d).withColumn("km", F.round(F.least(F.greatest("km", F.lit(1.0)), F.lit(50.0)), 6))


@query(f"SELECT rid, round(t + (30 - km) / (nkm - km) * (nt - t), 6) AS t FROM (SELECT *, lead(t) OVER w AS nt, lead(km) OVER w AS nkm FROM ({_ANCH}) WINDOW w AS (PARTITION BY rid ORDER BY t)) WHERE km <= 30 AND nkm > 30")
def rep_time_at_distance(d: Data) -> DataFrame:
    w = Window.partitionBy("rid").orderBy("t")
    a = anchors(d).select("rid", "t", "km", F.lead("t").over(w).alias("nt"), F.lead("km").over(w).alias("nkm")).where("km <= 30 and nkm > 30")
    return a.select("rid", F.round(F.col("t") + (30 - F.col("km")) / (F.col("nkm") - F.col("km")) * (F.col("nt") - F.col("t")), 6).alias("t"))


_CUT = f"SELECT route_id, {{v}} FROM (SELECT *, lag(cum_m) OVER w AS m0, lag(lat) OVER w AS lat0, lag(lon) OVER w AS lon0, lag(ele) OVER w AS ele0 FROM ({MEASURED}) WINDOW w AS (PARTITION BY route_id ORDER BY idx)) WHERE m0 <= 1000 AND cum_m > 1000"


def cut_at(d: Data, metres: float) -> DataFrame:
    """Each route's leg that holds a distance, with the part of it up to there."""
    w = g.along()
    x = g.measured(d.points).select("route_id", "lat", "lon", "ele", "cum_m", *(F.lag(c).over(w).alias(f"{c}0") for c in ("cum_m", "lat", "lon", "ele")))
    return x.where((F.col("cum_m0") <= metres) & (F.col("cum_m") > metres)).withColumn("part", (metres - F.col("cum_m0")) / (F.col("cum_m") - F.col("cum_m0")))


@query(_CUT.format(v="round(lat0 + (1000 - m0) / (cum_m - m0) * (lat - lat0), 6) AS lat, round(lon0 + (1000 - m0) / (cum_m - m0) * (lon - lon0), 6) AS lon"))
def rep_point_at_distance(d: Data) -> DataFrame:
    mix = lambda c: F.round(F.col(f"{c}0") + F.col("part") * (F.col(c) - F.col(f"{c}0")), 6).alias(c)
    return cut_at(d, 1000.0).select("route_id", mix("lat"), mix("lon"))


_HEIGHTS = f"""WITH m AS MATERIALIZED ({MEASURED}), v AS (SELECT *, lag(cum_m) OVER w AS m0, lag(ele) OVER w AS e0 FROM m WHERE ele IS NOT NULL WINDOW w AS (PARTITION BY route_id ORDER BY idx)),
r AS (SELECT route_id, max(cum_m) AS full_m, max(cum_m) FILTER (WHERE ele IS NOT NULL) AS top, arg_max(ele, idx) FILTER (WHERE ele IS NOT NULL) AS last_ele FROM m GROUP BY 1),
q AS (SELECT r.*, g.at_m, o.off, g.at_m + o.off AS d FROM r, (VALUES (1000.0::DOUBLE), (2500)) g(at_m), (VALUES (0.0::DOUBLE), (-50), (50), (-160), (160)) o(off) WHERE g.at_m <= r.full_m),
e AS (SELECT q.route_id, q.at_m, q.off, any_value(full_m) AS full_m, any_value(top) AS top, coalesce(max(CASE WHEN v.m0 IS NULL THEN v.ele ELSE e0 + (d - m0) / (cum_m - m0) * (ele - e0) END), any_value(last_ele)) AS h
  FROM q LEFT JOIN v ON v.route_id = q.route_id AND q.d <= v.cum_m AND (v.m0 IS NULL OR q.d > v.m0) GROUP BY 1, 2, 3),
p AS (SELECT route_id, at_m, max(h) FILTER (WHERE off = 0) AS ele, 100.0::DOUBLE * (max(h) FILTER (WHERE off = 50) - max(h) FILTER (WHERE off = -50)) AS near, 100.0::DOUBLE * (max(h) FILTER (WHERE off = 160) - max(h) FILTER (WHERE off = -160)) AS wide,
  least(at_m + 50, any_value(full_m)) - greatest(at_m - 50, 0) AS near_m, least(at_m + 160, any_value(top)) - greatest(at_m - 160, 0) AS wide_m FROM e GROUP BY 1, 2)
SELECT route_id, at_m, round(ele, 3) AS ele, round(CASE WHEN near_m > 1 THEN near / near_m END, 3) AS grade, round(CASE WHEN ele IS NOT NULL THEN CASE WHEN wide_m > 0 THEN wide / wide_m ELSE 0 END END, 3) AS chart_grade FROM p"""


@query(_HEIGHTS)
def rep_elevation_at(d: Data) -> DataFrame:
    """Elevation at 1,000 and 2,500 m of each route that is so long, with the grades over 50 and 160 m to both sides."""
    return rp.heights(d.points, (1000.0, 2500.0)).select("route_id", "at_m", *(F.round(c, 3).alias(c) for c in ("ele", "grade", "chart_grade")))


@query("SELECT route_id, idx, round(coalesce(sum(up) OVER (PARTITION BY route_id ORDER BY idx ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 0), 4) AS remaining FROM (SELECT *, CASE WHEN ele - lag(ele) OVER w > 0 THEN ele - lag(ele) OVER w END AS up FROM f_route_points WINDOW w AS (PARTITION BY route_id ORDER BY idx))")
def rep_ascent_remaining(d: Data) -> DataFrame:
    step = F.col("ele") - F.lag("ele").over(g.along())
    after = Window.partitionBy("route_id").orderBy("idx").rowsBetween(1, Window.unboundedFollowing)
    return d.points.withColumn("up", F.when(step > 0, step)).select("route_id", "idx", F.round(F.coalesce(F.sum("up").over(after), F.lit(0.0)), 4).alias("remaining"))


@query(f"""SELECT a.race_key, a.t, a.rid, rank, behind_km, last_cp FROM (SELECT race_key, t, rid, rank() OVER (PARTITION BY race_key, t ORDER BY round(km, 6) DESC) AS rank, round(max(km) OVER (PARTITION BY race_key, t) - km, 5) AS behind_km FROM ({_AT})) a
JOIN (SELECT rid, g.t, arg_max(cp_key, (seconds, seq)) AS last_cp FROM f_obs, (VALUES {", ".join(f"({t}::DOUBLE)" for t in _TIMES)}) g(t) WHERE seconds <= g.t GROUP BY 1, 2) c ON c.rid = a.rid AND c.t = a.t""")
def rep_leaderboard(d: Data) -> DataFrame:
    return rp.leaderboard(d.laid, _TIMES, d.most).withColumn("behind_km", F.round("behind_km", 5))


_LINES = ("women", "men", "field")
_LINE_SQL = f"""SELECT race_key, line, seq, km, quantile_cont(seconds, 0.5) AS seconds FROM (SELECT *, unnest(CASE sex WHEN 'F' THEN ['field', 'women'] WHEN 'M' THEN ['field', 'men'] ELSE ['field'] END) AS line FROM f_obs WHERE {FIN} AND seconds IS NOT NULL)
GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5"""


def reference_lines(obs: DataFrame) -> DataFrame:
    """(race_key, line, seq, km, seconds): median times of finishers at each boundary, of all and by sex, of five rows at least."""
    sexes = F.when(F.col("sex") == "F", F.array(F.lit("field"), F.lit("women"))).when(F.col("sex") == "M", F.array(F.lit("field"), F.lit("men"))).otherwise(F.array(F.lit("field")))
    known = obs.where(finished() & F.col("seconds").isNotNull()).withColumn("line", F.explode(sexes))
    return known.groupBy("race_key", "line", "seq", "km").agg(F.count("*").alias("n"), st.quantile("seconds", 0.5).alias("seconds")).where("n >= 5").drop("n")


@query(f"""WITH p AS MATERIALIZED ({_AT}), c AS (SELECT p.rid, p.t, max(o.km) AS full_km, arg_max(cp_key, (o.km, seq)) FILTER (WHERE o.km <= p.km + 0.001::DOUBLE) AS last_cp, arg_max(place, seq) FILTER (WHERE seconds <= p.t AND place IS NOT NULL) AS place FROM p JOIN f_obs o ON o.rid = p.rid GROUP BY 1, 2),
s AS (SELECT p.rid, p.t, min({{'n': g.seg_no, 'name': from_key || '>' || to_key, 'pace': g.pace}}) AS s FROM p JOIN f_seg g ON g.rid = p.rid JOIN f_checkpoints k ON k.race_key = g.race_key AND k.seq = g.seg_no WHERE p.km BETWEEN k.km - 0.001::DOUBLE AND k.km + g.km + 0.001::DOUBLE GROUP BY 1, 2),
l AS MATERIALIZED ({positions_sql(_LINE_SQL, "line")}), w AS (SELECT race_key, t, {", ".join(f"max(km) FILTER (WHERE line = '{n}') AS line_{n}" for n in _LINES)} FROM l GROUP BY 1, 2)
SELECT p.race_key, p.rid, p.t, round(km, 6) AS km, round(full_km - km, 6) AS left_km, last_cp, s.s.name AS segment, round(s.s.pace, 6) AS pace, place, {", ".join(f"round(line_{n} - km, 6) AS to_{n}" for n in _LINES)}
FROM p JOIN c ON c.rid = p.rid AND c.t = p.t LEFT JOIN s ON s.rid = p.rid AND s.t = p.t LEFT JOIN w ON w.race_key = p.race_key AND w.t = p.t""")
def rep_now_state(d: Data) -> DataFrame:
    x = rp.now_state(d.laid, reference_lines(d.obs), _TIMES, _LINES)
    return x.withColumns({c: F.round(c, 6) for c in ("km", "left_km", "pace", *(f"to_{n}" for n in _LINES))})


@query("SELECT rid, arg_max(place_overall, elapsed_seconds) AS place FROM f_splits WHERE elapsed_seconds <= 3600 GROUP BY 1")
def rep_ranks_at(d: Data) -> DataFrame:
    x = d.splits.where("elapsed_seconds <= 3600").groupBy("rid").agg(F.max(F.struct("elapsed_seconds", "place_overall")).alias("s"))
    return x.select("rid", F.col("s.place_overall").alias("place"))


@query(f"SELECT race_key, sex, seq, km, quantile_cont(seconds, 0.5) AS seconds FROM f_obs WHERE {FIN} AND sex IS NOT NULL AND seconds IS NOT NULL GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5")
def rep_reference_lines(d: Data) -> DataFrame:
    """Median time at each anchor by sex, of five rows at least."""
    known = d.obs.where(finished() & F.col("sex").isNotNull() & F.col("seconds").isNotNull())
    return known.groupBy("race_key", "sex", "seq", "km").agg(F.count("*").alias("n"), st.quantile("seconds", 0.5).alias("seconds")).where("n >= 5").drop("n")


QUERIES, ORACLE = book.queries, book.sql
