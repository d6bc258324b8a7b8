"""Where somebody was at a time, from the observations that lie in a result's own row: no shuffle by result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import geo as g
from racelab.operators import ranks

#: A checkpoint counts as reached this many km before it.
SLACK_KM = 0.001


def row_anchors(observed: Column) -> Column:
    """The observations of a row that are later than all before them, as array<struct<t, km>>; unknown times are left out."""
    known = F.filter(observed, lambda x: x["seconds"].isNotNull())
    later = lambda a, x: x["seconds"] > F.coalesce(F.try_element_at(a, F.lit(-1))["t"], F.lit(-1.0))
    step = lambda x: F.struct(x["seconds"].cast("double").alias("t"), x["km"].cast("double").alias("km"))
    return F.aggregate(known, F.array().cast("array<struct<t:double,km:double>>"), lambda a, x: F.when(later(a, x), F.concat(a, F.array(step(x)))).otherwise(a))


def km_at(anchors: Column, t: Column) -> Column:
    """Kilometres at a time: linear between anchors, the last one's after it, null before the first."""
    k = F.size(F.filter(anchors, lambda x: x["t"] <= t))
    a, b = F.try_element_at(anchors, F.greatest(k, F.lit(1))), F.try_element_at(anchors, k + 1)
    between = a["km"] + (t - a["t"]) / (b["t"] - a["t"]) * (b["km"] - a["km"])
    return F.when(k >= 1, F.when(k == F.size(anchors), a["km"]).otherwise(between))


def positions(laid: DataFrame, times: tuple[float, ...]) -> DataFrame:
    """Rows of ``laid`` for each of the times from their first anchor on, with ``t`` and ``km``."""
    first = F.try_element_at("anchors", F.lit(1))["t"]
    asked = F.filter(F.array(*(F.lit(float(t)) for t in times)), lambda t: t >= first)
    x = laid.withColumn("anchors", row_anchors(F.col("observed"))).withColumn("t", F.explode(asked))
    return x.withColumn("km", km_at(F.col("anchors"), F.col("t"))).drop("anchors")


def seen_last(observed: Column, t: Column) -> Column:
    """The checkpoint of the latest observation up to a time, of equal times the later checkpoint; null for none."""
    seen = F.filter(observed, lambda x: x["seconds"] <= t)
    return F.array_max(F.transform(seen, lambda x: F.struct(x["seconds"].alias("s"), x["seq"].alias("n"), x["cp_key"].alias("key"))))["key"]


def leaderboard(laid: DataFrame, times: tuple[float, ...], within: int | None = None) -> DataFrame:
    """(race_key, t, rid, rank, behind_km, last_cp): the field of each race at each time, ranked by distance."""
    x = positions(laid, times).select("race_key", "t", "rid", "km", F.round("km", 6).alias("at"), seen_last(F.col("observed"), F.col("t")).alias("last_cp"))
    x = ranks.standings(x, ["race_key", "t"], "at", "rank", within)
    x = ranks.with_largest(x, ["race_key", "t"], "km", "first", within)
    return x.select("race_key", "t", "rid", "rank", (F.col("first") - F.col("km")).alias("behind_km"), "last_cp")


def reference_positions(lines: DataFrame, times: tuple[float, ...]) -> DataFrame:
    """(race_key, line, t, line_km): where reference lines, (race_key, line, seq, km, seconds), are at each time.

    A line has a row for each boundary, so it is gathered into one row.
    """
    o = F.array_sort(F.collect_list(F.struct("seq", "km", "seconds")))
    return positions(lines.groupBy("race_key", "line").agg(o.alias("observed")), times).select("race_key", "line", "t", F.col("km").alias("line_km"))


def now_state(laid: DataFrame, lines: DataFrame, times: tuple[float, ...], shown: tuple[str, ...]) -> DataFrame:
    """A result's state at each time: km done and left, the checkpoint reached, the segment it is on, that segment's
    pace, its places as last published, and km to each of the ``shown`` reference lines (ahead of it: positive).

    The segment is the first whose boundaries hold the distance; its pace is null where it wasn't timed. The last place
    and class are null before the first published one. A line that is not there gives null.
    """
    o, km, t = F.col("observed"), F.col("km"), F.col("t")
    reached = F.array_max(F.transform(F.filter(o, lambda x: x["km"] <= km + SLACK_KM), lambda x: F.struct(x["km"].alias("km"), x["seq"].alias("n"), x["cp_key"].alias("key"))))
    holds = lambda i: (km >= F.get(o, i)["km"] - SLACK_KM) & (km <= F.get(o, i + 1)["km"] + SLACK_KM)
    on = F.get(F.filter(F.sequence(F.lit(0), F.greatest(F.size(o) - 2, F.lit(0))), holds), F.lit(0))
    a, b = F.get(o, F.col("on")), F.get(o, F.col("on") + 1)
    took = b["seconds"] - a["seconds"]
    ranked = F.filter(o, lambda x: (x["seconds"] <= t) & x["place"].isNotNull())
    place = F.array_max(F.transform(ranked, lambda x: F.struct(x["seq"].alias("n"), x["place"].alias("place"))))["place"]
    x = positions(laid, times).withColumn("on", on).select(
        "race_key", "rid", "t", "km", (F.array_max(F.transform(o, lambda x: x["km"])) - km).alias("left_km"), reached["key"].alias("last_cp"),
        F.concat_ws(">", a["cp_key"], b["cp_key"]).alias("segment"), F.when(took > 0, took / (b["km"] - a["km"])).alias("pace"), place.alias("place"),
    )
    at = reference_positions(lines, times).groupBy("race_key", "t").agg(*(F.max(F.when(F.col("line") == n, F.col("line_km"))).alias(f"line_{n}") for n in shown))
    return x.join(at, ["race_key", "t"], "left").select(*x.columns, *((F.col(f"line_{n}") - km).alias(f"to_{n}") for n in shown))


def heights(points: DataFrame, at: tuple[float, ...]) -> DataFrame:
    """(route_id, at_m, ele, grade, chart_grade): elevation and grade in percent at distances that a route has.

    Elevation is interpolated between known points, and the first or last known one beyond them. ``grade`` is over 50 m
    to both sides within the route, null where that is a metre or less; ``chart_grade`` over 160 m to both sides within
    the route up to its last known elevation, 0 where nothing is left.
    """
    before = g.along().rowsBetween(Window.unboundedPreceding, -1)
    known = F.col("ele").isNotNull()
    last = lambda c: F.last(F.when(known, F.col(c)), ignorenulls=True).over(before)
    x = g.measured(points).select("route_id", "idx", "ele", "cum_m", last("cum_m").alias("m0"), last("ele").alias("e0"))
    x = x.withColumn("at_m", F.explode(F.array(*(F.lit(float(d)) for d in at))))

    def height(offset: float) -> Column:
        d = F.col("at_m") + offset
        claims = known & (d <= F.col("cum_m")) & (F.col("m0").isNull() | (d > F.col("m0")))
        here = F.when(F.col("m0").isNull(), F.col("ele")).otherwise(F.col("e0") + (d - F.col("m0")) / (F.col("cum_m") - F.col("m0")) * (F.col("ele") - F.col("e0")))
        return F.coalesce(F.max(F.when(claims, here)), F.max_by("ele", F.when(known, F.col("idx"))))

    offsets = {"h": 0.0, "a50": -50.0, "b50": 50.0, "a160": -160.0, "b160": 160.0}
    s = x.groupBy("route_id", "at_m").agg(F.max("cum_m").alias("full"), F.max(F.when(known, F.col("cum_m"))).alias("top"), *(height(o).alias(n) for n, o in offsets.items()))
    span = lambda w, end: F.least(F.col("at_m") + w, F.col(end)) - F.greatest(F.col("at_m") - w, F.lit(0.0))
    rise = lambda w: 100.0 * (F.col(f"b{w}") - F.col(f"a{w}"))
    near, wide = span(50.0, "full"), span(160.0, "top")
    chart = F.when(F.col("h").isNotNull(), F.when(wide > 0, rise(160) / wide).otherwise(0.0))
    return s.where("at_m <= full").select("route_id", "at_m", F.col("h").alias("ele"), F.when(near > 1, rise(50) / near).alias("grade"), chart.alias("chart_grade"))
