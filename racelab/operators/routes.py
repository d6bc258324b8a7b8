"""Comparisons of whole routes, and points projected on them, without forming pairs that have nothing in common."""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import geo as g
from racelab.sources.shared import stored


def may_cover(samples: DataFrame, keys: list[str], reach: float, share: float) -> DataFrame:
    """(a, b): two routes with equal ``keys`` of which b may lie within ``reach`` metres of ``share`` of a's samples.

    A set-similarity join with a prefix filter. A sample within reach of b lies in b's cells or beside them. Of a's
    cells, the rarest first, so many are asked for that the samples in the others are too few for the share: a b that
    has none of these can't reach it. Cells that all routes pass, as around a common start, come last and are hardly
    ever asked for. No pair is lost; some of those returned fall short.
    """
    own = g.in_cells(samples, reach).groupBy(*keys, F.col("route_id").alias("a"), "cy", "cx").agg(F.count("*").alias("n"))
    grown = g.around_cells(samples, reach).select(*keys, F.col("route_id").alias("b"), "cy", "cx").distinct()
    routes = grown.groupBy(*keys, "cy", "cx").agg(F.count("*").alias("routes"))
    rarest = Window.partitionBy("a").orderBy("routes", "cy", "cx").rowsBetween(Window.unboundedPreceding, -1)
    whole = F.sum("n").over(Window.partitionBy("a"))
    asked = own.join(routes, [*keys, "cy", "cx"]).select("*", F.coalesce(F.sum("n").over(rarest), F.lit(0)).alias("before"), whole.alias("whole"))
    asked = asked.where(F.col("before") <= F.col("whole") * (1 - share)).select(*keys, "a", "cy", "cx")
    return asked.join(grown, [*keys, "cy", "cx"]).where("a <> b").select("a", "b").distinct()


#: Routes of each side of a tile, about; consecutive samples of a block; the most distances that a step holds at once; copies in a row.
TILE, BLOCK, DISTANCES, COPIES = 32, 16, 60_000, 64


class Distinct(NamedTuple):
    """Courses of which no two have the same points.

    ``points`` are those of each course's route with the smallest id, ``routes`` (route_id, n) such routes with how many
    share the course, and ``members`` (same, ids) the ids of all routes under that route's id, some 64 in a row.
    """

    points: DataFrame
    routes: DataFrame
    members: DataFrame


def distinct(points: DataFrame, keys: list[str] = ["family"]) -> Distinct:  # noqa: B006
    """Routes with equal ``keys`` and the very same points, elevations included, are one course."""
    text = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lat", "lon", "ele")))
    line = F.transform(F.array_sort(F.collect_list(F.struct("idx", text.alias("at")))), lambda p: F.concat_ws(":", p["idx"].cast("string"), p["at"]))
    shapes = stored(points.groupBy("route_id", *keys).agg(F.sha2(F.array_join(line, ";"), 256).alias("shape")))
    same = shapes.groupBy(*keys, "shape").agg(F.min("route_id").alias("same"), F.count("*").alias("n"))
    routes = stored(shapes.join(same, [*keys, "shape"]).select("route_id", "same", "n"))
    members = routes.groupBy("same", F.pmod(F.xxhash64("route_id"), F.ceil(F.col("n") / COPIES)).alias("row")).agg(F.collect_list("route_id").alias("ids"))
    first = routes.where("route_id = same").select("route_id", "n")
    return Distinct(points.join(first.select("route_id"), "route_id", "left_semi"), first, stored(members.drop("row")))


def of_all(met: DataFrame, members: DataFrame, directed: bool = False) -> DataFrame:
    """Rows of pairs of courses, (a, b, ...), for all routes on them: once a pair, a < b, or ``directed`` both ways."""
    rest = [c for c in met.columns if c not in ("a", "b")]
    of = lambda c, ids: members.select(F.col("same").alias(c), F.col("ids").alias(ids))
    # few rows in, many out: dealt out before they multiply
    x = met.join(of("a", "us"), "a").join(of("b", "vs"), "b").repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    x = x.select(F.explode("us").alias("a"), "vs", *rest).select("a", F.explode("vs").alias("b"), *rest)
    return x.where("a <> b" if directed else "a < b")


def gathered(rows: DataFrame, keys: list[str], key: str, *values: str) -> DataFrame:
    """(same, ids): structs of the rows' values under the smallest ``key`` of those with equal ``keys``, some 64 in a row."""
    x = rows.join(rows.groupBy(*keys).agg(F.min(key).alias("same"), F.count("*").alias("n")), keys)
    row = F.pmod(F.xxhash64(key), F.ceil(F.col("n") / COPIES))
    return x.groupBy("same", row.alias("row")).agg(F.collect_list(F.struct(*values)).alias("ids")).drop("row")


def spread(met: DataFrame, members: dict[str, DataFrame]) -> DataFrame:
    """Rows of what was measured once, for all ``members`` (same, ids) of each named column, dealt out before they multiply."""
    for c, m in members.items():
        met = met.join(m.select(F.col("same").alias(c), F.col("ids").alias(f"_{c}")), c)
    met = met.repartition(int(met.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    for c in members:
        met = met.withColumn(c, F.explode(f"_{c}")).drop(f"_{c}")
    return met


def _local(lat: np.ndarray, lon: np.ndarray, lat0: float, lon0: float) -> np.ndarray:
    """Points of the unit sphere from a place on it, to the east, north and up, without cancellation nearby."""
    y, x, lat, lat0 = np.radians(lat - lat0), np.radians(lon - lon0), np.radians(lat), np.radians(lat0)
    bent = 2 * np.cos(lat) * np.sin(x / 2) ** 2
    return np.stack([np.cos(lat) * np.sin(x), np.sin(y) + np.sin(lat0) * bent, -2 * np.sin(y / 2) ** 2 - np.cos(lat0) * bent])


class Line:
    """A route of a tile: its samples' order (``at``) and, of those with a place, blocks of consecutive ones in their boxes."""

    def __init__(self, route: tuple, lat0: float, lon0: float):
        self.id, self.side, self.copied, self.at = route.route_id, route.side, route.copied, np.asarray(route.at, float)
        at = _local(np.asarray(route.lat, float), np.asarray(route.lon, float), lat0, lon0)
        self.known = ~np.isnan(at[0])
        at = at[:, self.known]
        n = -(-at.shape[1] // BLOCK)
        self.blocks = np.concatenate([at, np.repeat(at[:, -1:], n * BLOCK - at.shape[1], axis=1)], axis=1).reshape(3, n, BLOCK)
        self.low, self.high = self.blocks.min(axis=2), self.blocks.max(axis=2)
        self.held = np.bincount(np.arange(at.shape[1]) // BLOCK, minlength=n)


def _nearest(one: Line, others: list[Line], reach: float | None, share: float) -> dict:
    """By the other's id: metres, to the millimetre, from each sample of a route to the other's nearest one.

    Boxes bound how near and how far a block's samples are, so only blocks that may hold a nearest one are measured.
    Others that can't lie within ``reach`` of that share of the samples have no entry. NaN is a sample without a place,
    or another route without any.
    """
    blank = np.full(len(one.known), np.nan)
    found = {x.id: blank for x in others if reach is None and not (x.held.size and one.held.size)}
    others = [x for x in others if x.held.size and one.held.size]
    if not others:
        return found
    low, high = (np.concatenate([getattr(x, c) for x in others], axis=1) for c in ("low", "high"))
    sizes = np.array([x.held.size for x in others])
    nearer, farther = np.zeros((2, one.held.size, low.shape[1]))
    for k in range(3):
        u, v = one.low[k][:, None], one.high[k][:, None]
        nearer += np.maximum(np.maximum(low[k] - v, u - high[k]), 0.0) ** 2
        farther += np.maximum(high[k] - u, v - low[k]) ** 2
    starts = np.cumsum(sizes) - sizes
    if reach is not None:  # a chord is shorter than the way along the sphere
        may = np.minimum.reduceat(nearer, starts, axis=1) <= (reach / g.EARTH_M) ** 2 * 1.0001
        may = one.held @ may >= share * len(one.known)
        if not may.all():
            return _nearest(one, [x for x, m in zip(others, may, strict=True) if m], reach, share) if may.any() else found
    of = np.repeat(np.arange(len(others)), sizes)
    bound = np.minimum.reduceat(farther, starts, axis=1)
    mine, theirs = np.nonzero(nearer <= bound[:, of] * 1.000001)
    least, step = np.empty((len(mine), BLOCK)), max(1, DISTANCES // BLOCK**2)
    target = np.ascontiguousarray(np.concatenate([x.blocks for x in others], axis=1).transpose(0, 2, 1))
    for i in range(0, len(mine), step):
        p, q = mine[i : i + step], theirs[i : i + step]
        d = np.zeros((BLOCK, len(p), BLOCK))
        for k in range(3):
            apart = one.blocks[k][p][None] - target[k][:, q][:, :, None]
            apart *= apart
            d += apart
        least[i : i + step] = d.min(axis=0)
    group = mine * len(others) + of[theirs]
    least = np.minimum.reduceat(least, np.flatnonzero(np.diff(group, prepend=-1)), axis=0)
    least = least.reshape(one.held.size, len(others), BLOCK).transpose(1, 0, 2).reshape(len(others), -1)[:, : one.held.sum()]
    metres = np.round(2 * g.EARTH_M * np.arcsin(np.minimum(np.sqrt(least) / 2, 1.0)), 3)
    for x, m in zip(others, metres, strict=True):
        whole = blank.copy()
        whole[one.known] = m
        found[x.id] = whole
    return found


def _tile(rows: pd.DataFrame, columns: list[str], figures: Callable, reach: float | None, share: float) -> pd.DataFrame:
    """The figures of the pairs between the two sides of a tile, both ways; of a side with itself also of a route with copies."""
    placed = rows["lat"].map(lambda x: np.flatnonzero(~np.isnan(np.asarray(x, float))))
    first = next(((r, p[0]) for r, p in placed.items() if p.size), None)
    lat0, lon0 = (rows["lat"][first[0]][first[1]], rows["lon"][first[0]][first[1]]) if first else (0.0, 0.0)
    lines = [Line(r, lat0, lon0) for r in rows.sort_values("route_id").itertuples()]
    i, j = rows["i"].iloc[0], rows["j"].iloc[0]
    apart, out = {}, []
    for x in lines:
        facing = [y for y in lines if y is not x and (i == j or y.side != x.side)]
        apart[x.id] = _nearest(x, facing, reach, share)
    for x in lines:
        if x.copied and i == j:
            same = np.where(x.known, 0.0, np.nan)
            out += [(x.id, x.id, *f) for f in figures(x, x, same, same)]
        for y in lines:
            if y.id in apart[x.id] and x.id in apart[y.id]:
                out += [(x.id, y.id, *f) for f in figures(x, y, apart[x.id][y.id], apart[y.id][x.id])]
    return pd.DataFrame(out, columns=["a", "b", *columns])


def _lines(samples: DataFrame, order: list[str], keys: list[str]) -> DataFrame:
    """(route_id, *keys, at, lat, lon): the samples of a route in its row."""
    line = F.array_sort(F.collect_list(F.struct(*order, "lat", "lon")))
    lines = samples.groupBy("route_id", *keys).agg(line.alias("line"))
    return lines.select("route_id", *keys, F.col(f"line.{order[0]}").alias("at"), F.col("line.lat").alias("lat"), F.col("line.lon").alias("lon"))


def _measured(dealt: DataFrame, keys: list[str], columns: str, figures: Callable, reach: float | None = None, share: float = 0.0) -> DataFrame:
    kind, names = dealt.schema["route_id"].dataType.simpleString(), [c.split()[0] for c in columns.split(", ")]
    return stored(dealt.groupBy(*keys, "i", "j").applyInPandas(lambda rows: _tile(rows, names, figures, reach, share), f"a {kind}, b {kind}, {columns}"))


def all_pairs(samples: DataFrame, order: list[str], routes: DataFrame, columns: str, figures: Callable, reach: float | None = None, share: float = 0.0, keys: list[str] = ["family"]) -> DataFrame:  # noqa: B006
    """(a, b, *columns): what ``figures`` makes of every ordered pair of courses with equal ``keys``, however far apart.

    ``figures`` takes two lines and the metres, to the millimetre, from each sample of one to the nearest of the other,
    there and back, and returns rows of ``columns``, none for a pair that doesn't count. A course with copies, by n of
    ``routes``, is a pair with itself. With a ``reach``, pairs that can't lie so near over that share of samples, to
    four places, both ways, may be left out. Courses of a key are dealt out to the sides of square tiles; a tile is a
    group and holds some 2 x 32 courses, so a key spans as many tasks as it has tiles.
    """
    lines = stored(_lines(samples, order, keys).join(routes, "route_id"))
    sides = lines.groupBy(*keys).agg(F.ceil(F.count("*") / TILE).cast("int").alias("sides"))
    dealt = lines.join(sides, keys).withColumns({"copied": F.col("n") > 1, "side": F.pmod(F.hash("route_id"), "sides"), "other": F.explode(F.sequence(F.lit(0), F.col("sides") - 1))})
    dealt = dealt.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("sides", "other", "n")
    return _measured(dealt, keys, columns, figures, reach, share - 0.00005)


def against_first(samples: DataFrame, order: list[str], routes: DataFrame, columns: str, figures: Callable, keys: list[str] = ["family"]) -> DataFrame:  # noqa: B006
    """(a, b, *columns): as ``all_pairs``, but b is the first course of a's keys. Some 32 courses meet it in a group."""
    lines = stored(_lines(samples, order, keys).join(routes, "route_id"))
    first = lines.groupBy(*keys).agg(F.min("route_id").alias("first"), F.ceil(F.count("*") / TILE).cast("int").alias("sides"))
    x = lines.join(first, keys).withColumn("copied", F.col("n") > 1)
    own = F.col("route_id") == F.col("first")
    side = F.when(own, -1).otherwise(F.pmod(F.hash("route_id"), "sides"))
    met = F.when(own, F.sequence(F.lit(-1), F.col("sides") - 1)).otherwise(F.array(side))
    dealt = x.withColumns({"i": F.lit(-1), "side": side, "j": F.explode(met)}).drop("n", "first", "sides")
    return _measured(dealt, keys, columns, figures).join(first.select(F.col("first").alias("b")), "b", "left_semi").select("a", "b", *(c.split()[0] for c in columns.split(", ")))


# figures of a pair from the metres there and back ------------------------------------------------------------------


def covered(metres: np.ndarray, reach: float) -> float:
    return np.count_nonzero(metres <= reach) / len(metres)


def four(share: float) -> float:
    """Rounded to four places, halves up."""
    return math.floor(share * 10_000 + 0.5) / 10_000


def alike(there: np.ndarray, back: np.ndarray, reach: float, share: float) -> bool:
    return min(four(covered(there, reach)), four(covered(back, reach))) >= share


def quantiles(metres: np.ndarray, *qs: float) -> list[float | None]:
    """Linear interpolation between ranks of the known metres."""
    v = np.sort(metres[~np.isnan(metres)])
    if not v.size:
        return [None] * len(qs)
    at = [(v.size - 1) * q for q in qs]
    return [float(v[math.floor(x)] + (v[math.ceil(x)] - v[math.floor(x)]) * (x - math.floor(x))) for x in at]


def nearest_ranks(metres: np.ndarray, *qs: float) -> list[float | None]:
    """The values at ranks ceil(q n) of the known metres."""
    v = np.sort(metres[~np.isnan(metres)])
    return [float(v[max(0, math.ceil(q * v.size) - 1)]) if v.size else None for q in qs]


def stretches_apart(at: np.ndarray, metres: np.ndarray, over: float, least: float) -> list[tuple]:
    """(from, to, samples, median, most) of maximal runs of samples more than ``over`` metres away that span ``least``."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], metres > over, [False]])))
    return [(at[i], at[j - 1], j - i, *quantiles(metres[i:j], 0.5, 1.0)) for i, j in zip(edges[::2], edges[1::2], strict=True) if at[j - 1] - at[i] >= least]


def ends(points: DataFrame) -> DataFrame:
    """Each route's length and its first and last point."""
    at = lambda f, c: f(c, "idx").alias(f"{'from' if f is F.min_by else 'to'}_{c}")
    return g.measured(points).groupBy("route_id").agg(F.max("cum_m").alias("m"), *(at(f, c) for f in (F.min_by, F.max_by) for c in ("lat", "lon")))


def with_ends(pairs: DataFrame, points: DataFrame) -> DataFrame:
    """Pairs with both routes' lengths (``ma``, ``mb``) and how far their starts and finishes are apart."""
    e = ends(points)
    side = lambda x: e.select(F.col("route_id").alias(x), *(F.col(c).alias(f"{c}{x}") for c in e.columns[1:]))
    gap = lambda p: F.round(g.haversine(F.col(f"{p}_lata"), F.col(f"{p}_lona"), F.col(f"{p}_latb"), F.col(f"{p}_lonb")), 3)
    x = pairs.join(side("a"), "a").join(side("b"), "b").withColumns({"start_m": gap("from"), "finish_m": gap("to")})
    return x.select(*pairs.columns, "ma", "mb", "start_m", "finish_m")


def geometry_hash(points: DataFrame, places: int = 7, elevation: bool = True) -> DataFrame:
    """(route_id, hash): sha256 of a route's ordered coordinates in units of the last place, with elevation in centimetres."""
    at = lambda c, unit: F.coalesce(F.floor(F.col(c) * unit + 0.5).cast("string"), F.lit(""))
    parts = [at("lat", 10**places), at("lon", 10**places), *([at("ele", 100)] if elevation else [])]
    ordered = F.array_sort(F.collect_list(F.struct("idx", F.concat_ws(",", *parts).alias("at"))))
    return points.groupBy("route_id").agg(F.sha2(F.array_join(F.transform(ordered, lambda s: s["at"]), ";"), 256).alias("hash"))


# points on lines ---------------------------------------------------------------------------------------------------


def segments(points: DataFrame, keys: list[str]) -> DataFrame:
    """(route_id, *keys, segment, lat0, lon0, lat1, lon1, m0, m1): a route's lines; a segment has its first point's place, from 0 on."""
    w = g.along()
    before = [F.lag(c).over(w).alias(f"{c}0") for c in ("lat", "lon", "cum_m")]
    x = g.measured(points).select("route_id", *keys, (F.row_number().over(w) - 2).alias("segment"), "lat", "lon", "cum_m", *before)
    return x.where("segment >= 0").select("route_id", *keys, "segment", "lat0", "lon0", F.col("lat").alias("lat1"), F.col("lon").alias("lon1"), F.col("cum_m0").alias("m0"), F.col("cum_m").alias("m1"))


def cells_passed(lines: DataFrame, side: float) -> DataFrame:
    """Lines in every cell that they pass: cut into parts no longer than a cell, each in the two by two cells of its ends.

    A row's cells differ in width from the next row's, so a part's columns are asked for in each of its rows.
    """
    rows = F.abs(F.col("lat1") - F.col("lat0")) * g.METRES_A_DEGREE / side
    columns = F.abs(F.col("lon1") - F.col("lon0")) * F.cos(F.radians(F.least(F.abs("lat0"), F.abs("lat1")))) * g.METRES_A_DEGREE / side
    n = F.greatest(F.ceil(F.greatest(rows, columns)), F.lit(1)).cast("int")
    parts = lines.withColumn("_n", n).withColumn("_i", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    at = lambda c, i: F.col(f"{c}0") + i / F.col("_n") * (F.col(f"{c}1") - F.col(f"{c}0"))
    parts = parts.withColumns({f"_{c}{j}": at(c, F.col("_i") + j) for c in ("lat", "lon") for j in (0, 1)})
    row = [g.cell_row(F.col(f"_lat{j}"), side) for j in (0, 1)]
    parts = parts.withColumn("cy", F.explode(F.sequence(F.least(*row), F.greatest(*row))))
    column = [g.cell_column(F.col(f"_lon{j}"), F.col("cy"), side) for j in (0, 1)]
    parts = parts.withColumn("cx", F.explode(F.sequence(F.least(*column), F.greatest(*column))))
    return parts.select(*lines.columns, "cy", "cx").distinct()


def projected(landmarks: DataFrame, lines: DataFrame, keys: list[str], reach: float) -> DataFrame:
    """(landmark, route_id, off_m, m, segment, fraction) of every landmark and route, of equal ``keys``, within ``reach`` metres.

    Landmarks look into the nine cells around them, lines stand in every cell that they pass: an equi-join by cell finds
    every line near enough, and the distance to each is that to the line, in a plane around the landmark. Of equal
    distances, to the millimetre, the first segment counts. A line without length is its point.
    """
    look = g.around_cells(landmarks.select("landmark", *keys, "lat", "lon"), reach)
    met = look.join(cells_passed(lines, reach), [*keys, "cy", "cx"])
    c = F.cos(F.radians("lat"))
    x = lambda j: F.radians(F.col(f"lon{j}") - F.col("lon")) * g.EARTH_M * c
    y = lambda j: F.radians(F.col(f"lat{j}") - F.col("lat")) * g.EARTH_M
    met = met.withColumns({"ax": x(0), "ay": y(0), "vx": x(1) - x(0), "vy": y(1) - y(0)})
    long = F.col("vx") * F.col("vx") + F.col("vy") * F.col("vy")
    t = F.when(long > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), -(F.col("ax") * F.col("vx") + F.col("ay") * F.col("vy")) / long))).otherwise(0.0)
    met = met.withColumn("fraction", t)
    px, py = (F.col(f"a{k}") + F.col("fraction") * F.col(f"v{k}") for k in "xy")
    met = met.withColumn("off_m", F.round(F.sqrt(px * px + py * py), 3)).where(F.col("off_m") <= reach)
    met = met.withColumn("m", F.col("m0") + F.col("fraction") * (F.col("m1") - F.col("m0")))
    best = met.groupBy("landmark", "route_id").agg(F.min(F.struct("off_m", "segment", "fraction", "m")).alias("s"))
    return best.select("landmark", "route_id", "s.off_m", "s.m", "s.segment", "s.fraction")


def projection_quality(off_m: Column) -> Column:
    return F.when(off_m <= 25, "excellent").when(off_m <= 75, "good").when(off_m <= 200, "review").otherwise("poor")


def edge_costs(edges: DataFrame, lines: DataFrame, keys: list[str], cap: float = 300.0, scale: float = 32.0, gross: float = 180.0) -> DataFrame:
    """(way, pos, length_m, deviation_m, cost) of every network edge with a length: how far it is from a trace, and what it costs.

    ``edges`` are (way, pos, *keys, factor, lat0, lon0, lat1, lon1). Five points of an edge look for the nearest trace
    line of the same keys; the deviation is their 80th percentile, ``cap`` at most. Cost is the length times
    1 + (deviation / scale) ** 2 times the factor of the relations that the way is in; a grossly deviating edge has a
    factor of 1.35 at least. The search ends at five times the cap: a point beyond can't leave a deviation below it.
    """
    length = g.haversine(F.col("lat0"), F.col("lon0"), F.col("lat1"), F.col("lon1"))
    long = edges.withColumn("length_m", length).where("length_m > 0")
    at = lambda c: (F.col(f"{c}0") + F.col("i") / 4 * (F.col(f"{c}1") - F.col(f"{c}0"))).alias(c)
    points = long.select("*", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("i")).select(F.struct("way", "pos", "i").alias("landmark"), *keys, at("lat"), at("lon"))
    points = stored(points)
    near = stored(projected(points, lines, keys, scale).groupBy("landmark").agg(F.min("off_m").alias("off_m")))
    # only points that aren't near are searched for far
    far = projected(points.join(near, "landmark", "left_anti"), lines, keys, 5 * cap).groupBy("landmark").agg(F.min("off_m").alias("off_m"))
    off = near.unionByName(far)
    found = points.select("landmark").join(off, "landmark", "left").select("landmark.*", F.coalesce("off_m", F.lit(5 * cap)).alias("off_m"))
    deviation = found.groupBy("way", "pos").agg(F.least(F.percentile("off_m", F.lit(0.8)), F.lit(cap)).alias("deviation_m"))
    scored = long.join(deviation, ["way", "pos"])
    factor = F.when(F.col("deviation_m") > gross, F.greatest("factor", F.lit(1.35))).otherwise(F.col("factor"))
    return scored.select("way", "pos", "length_m", "deviation_m", (F.col("length_m") * (1 + F.pow(F.col("deviation_m") / scale, 2)) * factor).alias("cost"))


# loops -------------------------------------------------------------------------------------------------------------


def splice(points: DataFrame, apart: float, first: tuple[float, float], loop: tuple[float, float], rest: tuple[float, float], wanted: tuple[float, float]) -> DataFrame:
    """(route_id, i, j, apart_m, first_m, second_m, loop_m, rest_m): the pair of passages of a place between which a loop is cut.

    Passages are ``apart`` metres or less from each other; the way to the first, the loop and what remains after the
    second are within their bounds. The least |way - wanted| + |remainder - wanted| + 10 x metres apart wins, then the
    first points. A route without such a pair has no row. Points meet in cells as wide as ``apart``.
    """
    m = g.measured(points).withColumn("total", F.max("cum_m").over(Window.partitionBy("route_id"))).select("route_id", "idx", "lat", "lon", "cum_m", "total")
    a = g.in_cells(m.where(F.col("cum_m").between(*first)), apart)
    b = g.around_cells(m.where((F.col("total") - F.col("cum_m")).between(*rest)), apart)
    b = b.select("route_id", "cy", "cx", F.col("idx").alias("j"), F.col("lat").alias("jlat"), F.col("lon").alias("jlon"), F.col("cum_m").alias("jm"))
    d = F.round(g.haversine(F.col("lat"), F.col("lon"), F.col("jlat"), F.col("jlon")), 3)
    pairs = a.join(b, ["route_id", "cy", "cx"]).where((F.col("idx") < F.col("j")) & (F.col("jm") - F.col("cum_m")).between(*loop)).withColumn("apart_m", d).where(F.col("apart_m") <= apart)
    score = F.round(F.abs(F.col("cum_m") - wanted[0]) + F.abs(F.col("total") - F.col("jm") - wanted[1]) + 10 * F.col("apart_m"), 3)
    kept = F.struct(score.alias("score"), F.col("idx").alias("i"), "j", "apart_m", F.col("cum_m").alias("first_m"), F.col("jm").alias("second_m"), (F.col("jm") - F.col("cum_m")).alias("loop_m"), (F.col("total") - F.col("jm")).alias("rest_m"))
    return pairs.groupBy("route_id").agg(F.min(kept).alias("s")).select("route_id", "s.*").drop("score")


def spliced(points: DataFrame, choice: DataFrame, length: tuple[float, float] | None = None) -> DataFrame:
    """The points of the routes in ``choice`` without those between its passages, numbered from 1 on and measured anew.

    A route whose new length isn't within ``length`` metres fails the query.
    """
    kept = points.join(choice.select("route_id", "i", "j"), "route_id").where("idx <= i or idx >= j").drop("i", "j")
    m = g.measured(kept.withColumn("idx", F.row_number().over(g.along())))
    if not length:
        return m
    whole = F.max("cum_m").over(Window.partitionBy("route_id"))
    checked = F.when(whole.between(*length), F.col("cum_m")).otherwise(F.raise_error(F.concat(F.lit("spliced length out of bounds: "), whole.cast("string"))).cast("double"))
    return m.withColumn("cum_m", checked)


def inventory(points: DataFrame) -> DataFrame:
    """One row for each route: points, km, both ends, known elevations, raw ascent and descent between known neighbours,
    and the hash of its points. Ascent and descent are null without any elevation, 0 where no two neighbours have one."""
    x = g.measured(points).withColumn("step", F.col("ele") - F.lag("ele").over(g.along()))
    known = F.count("ele") > 0
    climb = lambda c: F.when(known, F.coalesce(F.sum(F.when(c > 0, c)), F.lit(0.0)))
    end = lambda f: f(F.struct("lat", "lon"), "idx")
    s = x.groupBy("route_id").agg(
        F.count("*").alias("points"), (F.max("cum_m") / 1000).alias("km"), end(F.min_by).alias("s"), end(F.max_by).alias("f"), F.count("ele").alias("with_ele"),
        climb(F.col("step")).alias("raw_ascent"), climb(-F.col("step")).alias("raw_descent"),
    )
    s = s.join(geometry_hash(points).withColumnRenamed("hash", "sha256"), "route_id")
    return s.select("route_id", "points", "km", F.col("s.lat").alias("start_lat"), F.col("s.lon").alias("start_lon"), F.col("f.lat").alias("finish_lat"), F.col("f.lon").alias("finish_lon"), "with_ele", "raw_ascent", "raw_descent", "sha256")


def bounds(points: DataFrame, *levels: str) -> DataFrame:
    """Bounding boxes and their centres, on a Mercator map, of each of the levels and of all: one rollup."""
    box = points.rollup(*levels).agg(F.min("lat").alias("south"), F.max("lat").alias("north"), F.min("lon").alias("west"), F.max("lon").alias("east"))
    up = lambda c: F.asinh(F.tan(F.radians(c)))
    middle = F.degrees(F.atan(F.sinh((up("south") + up("north")) / 2)))
    return box.select("*", middle.alias("centre_lat"), ((F.col("west") + F.col("east")) / 2).alias("centre_lon"))


def terrain_on(points: DataFrame, stretches: dict[str, tuple[float, float]]) -> DataFrame:
    """(route_id, stretch, ascent, descent, lowest, highest, length_m, coverage) of stretches, from and to some metre.

    Both ends belong to a stretch, in either order; a stretch without points has no row. Elevations that are missing
    break the chain. With fewer than two known, or under 90 % of a stretch's points, all but the coverage is null. The
    length goes from the first to the last known point.
    """
    spans = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(float(min(s))).alias("a"), F.lit(float(max(s))).alias("b")) for name, s in stretches.items()))
    held = F.filter(spans, lambda s: F.col("cum_m").between(s["a"], s["b"]))
    x = g.measured(points).select("route_id", "idx", "ele", "cum_m", F.explode(F.transform(held, lambda s: s["name"])).alias("stretch"))
    step = F.col("ele") - F.lag("ele").over(Window.partitionBy("route_id", "stretch").orderBy("idx"))
    known, at = F.count("ele"), F.when(F.col("ele").isNotNull(), F.col("cum_m"))
    ok = (known >= 2) & (known >= 0.9 * F.count("*"))
    total = lambda c: F.when(ok, F.coalesce(F.sum(F.when(c > 0, c)), F.lit(0.0)))
    return x.withColumn("step", step).groupBy("route_id", "stretch").agg(
        total(F.col("step")).alias("ascent"), total(-F.col("step")).alias("descent"), F.when(ok, F.min("ele")).alias("lowest"), F.when(ok, F.max("ele")).alias("highest"),
        F.when(ok, F.max(at) - F.min(at)).alias("length_m"), (known / F.count("*")).alias("coverage"),
    )


def snapped(assigned: DataFrame, points: DataFrame, key: str) -> DataFrame:
    """Each anchor that a route is assigned, on the route's nearest point: (key, route_id, idx, km, offset_m, ok).

    ``assigned`` are (key, route_id, lat, lon, max_offset_m). Of equally near points the first counts; an anchor of a
    route without points, or farther off than its largest offset, is not ``ok``.
    """
    a = assigned.select(key, "route_id", F.col("lat").alias("alat"), F.col("lon").alias("alon"), "max_offset_m")
    offset = g.haversine(F.col("lat"), F.col("lon"), F.col("alat"), F.col("alon"))
    near = a.join(g.measured(points), "route_id").withColumn("offset_m", F.round(offset, 3)).groupBy(key, "route_id").agg(F.min(F.struct("offset_m", "idx", "cum_m")).alias("s"))
    x = a.join(near, [key, "route_id"], "left")
    return x.select(key, "route_id", "s.idx", (F.col("s.cum_m") / 1000).alias("km"), "s.offset_m", F.coalesce(F.col("s.offset_m") <= F.col("max_offset_m"), F.lit(False)).alias("ok"))


def required(anchors: DataFrame, key: str) -> DataFrame:
    """Rows of ``snapped`` without ``ok``; the job fails at the first anchor that is too far off."""
    text = F.concat_ws(" ", F.lit("anchor"), F.col(key).cast("string"), F.lit("of route"), F.col("route_id").cast("string"), F.lit("is too far off:"), F.coalesce(F.col("offset_m").cast("string"), F.lit("no point")))
    return anchors.withColumn("offset_m", F.when(F.col("ok"), F.col("offset_m")).otherwise(F.raise_error(text).cast("double"))).drop("ok")


def verified(points: DataFrame, manifest: DataFrame, within_km: float = 0.08) -> DataFrame:
    """Routes of a manifest, (route_id, expected_km, peers), held against their points and their peers' geometry.

    The length must be as expected, where the manifest expects one, and every peer's points must be the same. A route
    or a peer without points fails.
    """
    m = g.measured(points).groupBy("route_id").agg((F.max("cum_m") / 1000).alias("km")).join(geometry_hash(points), "route_id")
    peers = manifest.select("route_id", F.explode("peers").alias("peer")).join(m.select(F.col("route_id").alias("peer"), F.col("hash").alias("peer_hash")), "peer", "left")
    own = manifest.select("route_id", "expected_km").join(m, "route_id", "left")
    same = peers.join(own.select("route_id", "hash"), "route_id").groupBy("route_id").agg(F.count("*").alias("peers"), F.count_if(F.col("hash") == F.col("peer_hash")).alias("equal_peers"))
    x = own.join(same, "route_id", "left").fillna(0, ["peers", "equal_peers"])
    length = F.coalesce(F.col("expected_km").isNull() | (F.abs(F.col("km") - F.col("expected_km")) <= within_km), F.lit(False)) & F.col("km").isNotNull()
    return x.withColumn("length_ok", length).select("route_id", "km", "length_ok", "peers", "equal_peers", (F.col("length_ok") & (F.col("peers") == F.col("equal_peers"))).alias("verified"))


def elevation_evidence(points: DataFrame, manifest: DataFrame) -> DataFrame:
    """Each route's own ascent, descent and elevations beside what a manifest, (route_id, ascent, descent), reports.

    A difference needs both figures, and the descent's also a reported ascent; a route that the manifest lacks has none.
    """
    x = inventory(points).select("route_id", "points", F.col("raw_ascent").alias("own_up"), F.col("raw_descent").alias("own_down"))
    span = points.groupBy("route_id").agg(F.min("ele").alias("lowest"), F.max("ele").alias("highest"))
    x = x.join(span, "route_id").join(manifest.select("route_id", F.col("ascent").alias("said_up"), F.col("descent").alias("said_down")), "route_id", "left")
    up, down = F.col("own_up") - F.col("said_up"), F.col("own_down") - F.col("said_down")
    return x.select("route_id", "points", F.col("own_up").alias("ascent"), F.col("own_down").alias("descent"), "lowest", "highest", up.alias("ascent_delta"), F.when(up.isNotNull(), down).alias("descent_delta"))
