"""Geometry of routes as tables of points; every route stays spread over rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.sources.shared import stored

EARTH_M = 6371008.8
#: No two points are farther apart.
HALF_ROUND_M = 20_040_000.0
#: Metres of a degree of latitude, rounded down.
METRES_A_DEGREE = 111194.9
#: Side of the cells of the grid index, in degrees of latitude and longitude at these courses.
CELL_LAT, CELL_LON = 0.0025, 0.0045


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column, radius: float = EARTH_M) -> Column:
    """Great-circle metres."""
    s1, s2 = F.sin(F.radians(lat2 - lat1) / 2), F.sin(F.radians(lon2 - lon1) / 2)
    a = s1 * s1 + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s2 * s2
    # least() would turn a missing point into half the way around
    return 2 * radius * F.asin(F.sqrt(F.when(a > 1, 1.0).otherwise(a)))


def along() -> Window:
    return Window.partitionBy("route_id").orderBy("idx")


def measured(points: DataFrame, radius: float = EARTH_M) -> DataFrame:
    """Points with the metres since the one before (``leg``) and since the start (``cum_m``)."""
    w = along()
    leg = F.coalesce(haversine(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"), radius), F.lit(0.0))
    return points.withColumn("leg", leg).withColumn("cum_m", F.sum("leg").over(w))


def resampled(points: DataFrame, step: float) -> DataFrame:
    """(route_id, family, along_m, lat, lon): a point each ``step`` metres from the start, and the exact end."""
    w = along()
    ends = measured(points).select(
        "route_id", "family", "idx", F.lag("cum_m").over(w).alias("m0"), F.col("cum_m").alias("m1"), F.lag("lat").over(w).alias("lat0"), F.lag("lon").over(w).alias("lon0"), "lat", "lon",
        (F.lead("idx").over(w).isNull()).alias("last"),
    )
    first, upto = F.ceil(F.col("m0") / step), F.ceil(F.col("m1") / step) - 1  # the leg holds m0 <= at < m1
    inner = F.when((F.col("m1") > F.col("m0")) & (first <= upto), F.transform(F.sequence(first, upto), lambda k: k * F.lit(step))).otherwise(F.array().cast("array<double>"))
    at = F.explode(F.concat(inner, F.when(F.col("last"), F.array(F.col("m1"))).otherwise(F.array().cast("array<double>"))))
    part = (F.col("along_m") - F.col("m0")) / (F.col("m1") - F.col("m0"))
    mix = lambda c: F.when(F.col("along_m") == F.col("m1"), F.col(c)).otherwise(F.col(f"{c}0") + part * (F.col(c) - F.col(f"{c}0"))).alias(c)
    return ends.withColumn("along_m", at).select("route_id", "family", "along_m", mix("lat"), mix("lon"))


def densified(points: DataFrame, step: float) -> DataFrame:
    """(route_id, family, idx, part, lat, lon): each point of a route and, before it, its leg's parts of ``step`` metres at most."""
    w = along()
    legs = measured(points).withColumns({"lat0": F.lag("lat").over(w), "lon0": F.lag("lon").over(w)})
    n = F.when(F.col("lat0").isNull(), 1).otherwise(F.greatest(F.ceil(F.col("leg") / step), F.lit(1))).cast("int")
    parts = legs.withColumn("n", n).withColumn("part", F.explode(F.sequence(F.lit(1), "n")))
    at = lambda c: (F.when(F.col("part") == F.col("n"), F.col(c)).otherwise(F.col(f"{c}0") + F.col("part") / F.col("n") * (F.col(c) - F.col(f"{c}0")))).alias(c)
    return parts.select("route_id", "family", "idx", "part", at("lat"), at("lon"))


def cell_row(lat: Column, side: float) -> Column:
    """The row of cells, a little taller than ``side`` metres, that a latitude lies in."""
    return F.floor(lat / (1.01 * side / METRES_A_DEGREE))


def cell_column(lon: Column, row: Column, side: float) -> Column:
    """The column of a longitude: cells of a row are as wide as ``side`` at the farthest latitude of the rows beside it."""
    tall = 1.01 * side / METRES_A_DEGREE
    farthest = (F.greatest(F.abs(row - 1), F.abs(row + 2)) * tall).cast("double")
    wide = F.least(tall / F.greatest(F.cos(F.radians(F.least(farthest, F.lit(90.0)))), F.lit(1e-9)), F.lit(360.0))
    return F.floor(lon / wide)


def in_cells(points: DataFrame, side: float) -> DataFrame:
    """Points with their cell, ``cy`` and ``cx``."""
    return points.withColumn("cy", cell_row(F.col("lat"), side)).withColumn("cx", cell_column(F.col("lon"), F.col("cy"), side))


def around_cells(points: DataFrame, side: float) -> DataFrame:
    """Points in each of the nine cells from which a point within ``side`` metres may look at them."""
    around = F.sequence(F.lit(-1), F.lit(1))
    rows = points.withColumn("_dy", F.explode(around)).withColumn("cy", cell_row(F.col("lat"), side) + F.col("_dy"))
    return rows.withColumn("_dx", F.explode(around)).withColumn("cx", cell_column(F.col("lon"), F.col("cy"), side) + F.col("_dx")).drop("_dy", "_dx")


def nearest(left: DataFrame, right: DataFrame, keys: list[str], within: float) -> DataFrame:
    """Each left point with the metres to the nearest right point of the same keys, null beyond ``within``.

    Points meet by cells wider than ``within``: the right side stands in its own cell and the eight around it, so one
    equi-join finds every point near enough.
    """
    r = around_cells(right.select(*keys, "lat", "lon"), within).select(*keys, "cy", "cx", F.col("lat").alias("rlat"), F.col("lon").alias("rlon"))
    d = haversine(F.col("lat"), F.col("lon"), F.col("rlat"), F.col("rlon"))
    return in_cells(left, within).join(r, [*keys, "cy", "cx"], "left").groupBy(*left.columns).agg(F.min(F.when(d <= within, d)).alias("separation"))


def nearest_anywhere(left: DataFrame, right: DataFrame, keys: list[str], first: float) -> DataFrame:
    """Each left point with the metres to the nearest right point of the same keys, however far; null without one.

    The search goes by cells of doubling size, one equi-join for each: a point leaves as soon as its nearest is known to
    be nearer than a cell is wide, so wide cells are asked for few points. Courses must not cross the 180th meridian.
    """
    done, rest, within = [], left, first
    while True:
        found = stored(nearest(rest, right, keys, within))
        far = F.col("separation").isNull()
        if within > HALF_ROUND_M or found.where(far).isEmpty():
            return reduce(DataFrame.unionByName, [*done, found])
        done.append(found.where(~far))
        rest, within = found.where(far).drop("separation"), 2 * within


def divergence(series: DataFrame, keys: list[str], over: float, least: float) -> DataFrame:
    """Maximal runs of points farther than ``over`` metres that span ``least`` metres along: gaps and islands."""
    w = Window.partitionBy(*keys).orderBy("along_m")
    far = F.coalesce(F.col("separation") > over, F.lit(True))
    marked = series.withColumn("far", far).withColumn("new", (F.col("far") != F.coalesce(F.lag("far").over(w), ~F.col("far"))).cast("int"))
    runs = marked.withColumn("run", F.sum("new").over(w)).where("far").groupBy(*keys, "run").agg(F.min("along_m").alias("from_m"), F.max("along_m").alias("to_m"), F.count("*").alias("points"))
    return runs.where(F.col("to_m") - F.col("from_m") >= least).drop("run")
