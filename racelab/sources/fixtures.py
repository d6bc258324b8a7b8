"""Race data derived from the given relational tables, so that every operator has real rows.

Orders become results of 35 races (7 years, 5 families), line items their checkpoint passages, events the points of
routes. ``CTE`` has the same definitions as DuckDB SQL; ``oracle`` puts those that a query names in front of it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from racelab.operators import ranks

NOMINAL_KM = 60.0
#: Checkpoints of every race: key, sequence, km, label.
CHECKPOINTS = (("start", 0, 0.0, "Start"), ("cp1", 1, 20.0, "20 km"), ("cp2", 2, 45.0, "45 km"), ("finish", 3, 60.0, "Finish"))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def results(spark: SparkSession, sf: str) -> DataFrame:
    return timed_results(spark, sf).drop("elapsed_1", "elapsed_2")


def timed_results(spark: SparkSession, sf: str) -> DataFrame:
    """Results with the seconds at both checkpoints: line items are summed up once for finish and passages."""
    line, took = F.col("l_linenumber"), F.col("l_quantity")
    leg = lambda c, name: (F.sum(F.when(c, took)) * 60).alias(name)
    legs = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg((F.sum(took) * 60).alias("fs"), leg(line <= 2, "s1"), leg((line > 2) & (line <= 4), "s2"))
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    status = (
        F.when(F.col("o_orderstatus").isin("F", "O") & F.col("fs").isNotNull(), "FINISHED")
        .when(F.col("o_orderstatus") == "P", F.element_at(F.array(*map(F.lit, ("DNF", "DNS", "DSQ", "DNF"))), (key % 4 + 1).cast("int")))
        .otherwise("UNKNOWN")
    )
    year, family = F.year("o_orderdate"), F.lower("c_mktsegment")
    joined = (
        table(spark, sf, "orders")
        .join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(legs, key == F.col("k"), "left")
    )
    seen = lambda seconds: F.when(F.col("status") != "DNS", seconds)
    return joined.select(
        key.alias("rid"), F.concat_ws("-", year, family).alias("race_key"), year.alias("year"), family.alias("race_family"),
        F.col("c_name").alias("name"), key.cast("string").alias("bib"), F.col("o_orderpriority").alias("class_name"), F.col("n_name").alias("club"),
        F.element_at(F.array(F.lit("F"), F.lit("M"), F.lit(None)), (cust % 3 + 1).cast("int")).alias("sex"),
        F.when(cust % 7 != 0, (15 + cust % 60).cast("int")).alias("age"),
        status.alias("status"), F.when(status == "FINISHED", F.col("fs")).alias("finish_seconds"), cust.alias("custkey"), "s1", "s2",
    ).withColumns({"elapsed_1": seen(F.col("s1")), "elapsed_2": seen(F.coalesce("s1", F.lit(0)) + F.col("s2"))}).drop("s1", "s2")


#: Places as published: by which value, among rows of the same race and which other column.
PLACES = {"overall_place": ("finish_seconds", None), "gender_place": ("finish_seconds", "sex"), "class_place": ("finish_seconds", "class_name"), "place_1": ("elapsed_1", None), "place_2": ("elapsed_2", None)}


def placed(rows: DataFrame, names: list[str], within: int | None) -> DataFrame:
    """``rows`` with places; a race has ``within`` rows at most, see ``ranks``. Without a value, or a sex, there is no place."""
    if ranks.fits(within):
        rows = rows.repartition("race_key")  # one shuffle for all
    for name in names:
        value, among = PLACES[name]
        known = F.col(value).isNotNull() & (F.col("sex").isNotNull() if among == "sex" else F.lit(True))
        keys = ["race_key", "_known", *([among] if among else [])]
        rows = ranks.numbered(rows.withColumn("_known", known), keys, [F.col(value), F.col("rid")], "_place", within)
        rows = rows.withColumn(name, F.when(F.col("_known"), F.col("_place"))).drop("_known", "_place")
    return rows


def passages(names: tuple[str, ...] = ("place_1", "place_2")) -> Column:
    """A row's published passages; their places where the row has them."""
    place = lambda i: F.col(f"place_{i}") if f"place_{i}" in names else F.lit(None)
    one = lambda i: F.struct(F.lit(f"cp{i}").alias("cp_key"), F.lit(i).alias("seq"), F.col(f"elapsed_{i}").alias("elapsed_seconds"), place(i).cast("int").alias("place_overall"))
    return F.filter(F.array(one(1), one(2)), lambda p: p["elapsed_seconds"].isNotNull())


def races(res: DataFrame) -> DataFrame:
    return res.select("race_key", "year", "race_family").distinct()


def race_keys(spark: SparkSession, sf: str) -> DataFrame:
    """The races that orders belong to, from the two narrow columns that say so."""
    joined = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    return joined.select(F.concat_ws("-", F.year("o_orderdate"), F.lower("c_mktsegment")).alias("race_key")).distinct()


def checkpoints(keys: DataFrame) -> DataFrame:
    """Each race's ordered checkpoints; all are boundaries."""
    rows = F.array(*(F.struct(F.lit(k).alias("cp_key"), F.lit(n).alias("seq"), F.lit(km).alias("km"), F.lit(label).alias("label")) for k, n, km, label in CHECKPOINTS))
    return keys.select("race_key", F.inline(rows))


def splits(rows: DataFrame) -> DataFrame:
    """Published passages: (race_key, rid, cp_key, seq, elapsed_seconds, place_overall)."""
    return rows.select("race_key", "rid", F.inline(passages()))


def courses(res: DataFrame) -> DataFrame:
    """(race_key, year, race_family, course_version, course_group): the group joins versions a and b."""
    letter = F.when(F.col("year") <= 1997, "a").when(F.col("year") <= 1999, "b").otherwise("c")
    return races(res).select(
        "*", F.concat_ws("-", "race_family", letter).alias("course_version"),
        F.when(F.col("year") <= 1999, F.concat("race_family", F.lit("-ab"))).alias("course_group"),
    )


def route_points(spark: SparkSession, sf: str) -> DataFrame:
    """Points of a route for each user, in order of events: (route_id, family, idx, lat, lon, ele)."""
    idx = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    pts = table(spark, sf, "events").select("user_id", "event_type", "value", idx.alias("idx"))
    return pts.select(
        F.col("user_id").alias("route_id"), (F.col("user_id") % 10).alias("family"), "idx",
        (55.5 + F.col("idx") * 0.0005 + (F.col("value") - 150) / 100000).alias("lat"),
        (14 + F.col("idx") * 0.0007 + (F.col("user_id") % 10) * 0.0002).alias("lon"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("ele"),
    )


def landmarks(spark: SparkSession, sf: str) -> DataFrame:
    """A landmark for each supplier, near the routes of a family: (landmark, title, family, lat, lon)."""
    key = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        key.alias("landmark"), F.col("s_name").alias("title"), (key % 10).alias("family"),
        (55.5 + (key % 90) * 0.0005 + (F.col("s_nationkey") - 12) / 5000).alias("lat"), (14 + (key % 90) * 0.0007 + (key % 10) * 0.0002).alias("lon"),
    )


CTE = {
    "f_segsum": "SELECT l_orderkey AS k, CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN 2 ELSE 3 END AS cp, sum(l_quantity) * 60 AS secs FROM lineitem GROUP BY 1, 2",
    "f_results": """SELECT o_orderkey AS rid, year(o_orderdate) || '-' || lower(c_mktsegment) AS race_key, CAST(year(o_orderdate) AS INTEGER) AS year, lower(c_mktsegment) AS race_family,
      c_name AS name, CAST(o_orderkey AS VARCHAR) AS bib, o_orderpriority AS class_name, n_name AS club, CASE o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS sex,
      CASE WHEN o_custkey % 7 <> 0 THEN CAST(15 + o_custkey % 60 AS INTEGER) END AS age, status, CASE WHEN status = 'FINISHED' THEN fs END AS finish_seconds, o_custkey AS custkey
    FROM (SELECT *, CASE WHEN o_orderstatus IN ('F', 'O') AND fs IS NOT NULL THEN 'FINISHED' WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 4 WHEN 1 THEN 'DNS' WHEN 2 THEN 'DSQ' ELSE 'DNF' END ELSE 'UNKNOWN' END AS status
      FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey LEFT JOIN (SELECT k, sum(secs) AS fs FROM f_segsum GROUP BY k) ON o_orderkey = k)""",
    "f_places": """SELECT *, CASE WHEN finish_seconds IS NOT NULL THEN row_number() OVER (PARTITION BY race_key, finish_seconds IS NULL ORDER BY finish_seconds, rid) END AS overall_place,
      CASE WHEN finish_seconds IS NOT NULL AND sex IS NOT NULL THEN row_number() OVER (PARTITION BY race_key, finish_seconds IS NULL, sex ORDER BY finish_seconds, rid) END AS gender_place,
      CASE WHEN finish_seconds IS NOT NULL THEN row_number() OVER (PARTITION BY race_key, finish_seconds IS NULL, class_name ORDER BY finish_seconds, rid) END AS class_place FROM f_results""",
    "f_races": "SELECT DISTINCT race_key, year, race_family FROM f_results",
    "f_checkpoints": "SELECT race_key, cp_key, seq, km, label FROM f_races, (VALUES ('start', 0, 0.0::DOUBLE, 'Start'), ('cp1', 1, 20.0, '20 km'), ('cp2', 2, 45.0, '45 km'), ('finish', 3, 60.0, 'Finish')) c(cp_key, seq, km, label)",
    "f_splits": """SELECT race_key, rid, 'cp' || cp AS cp_key, cp AS seq, elapsed_seconds, row_number() OVER (PARTITION BY race_key, cp ORDER BY elapsed_seconds, rid) AS place_overall
    FROM (SELECT k, cp, sum(secs) OVER (PARTITION BY k ORDER BY cp) AS elapsed_seconds FROM f_segsum) JOIN f_results ON k = rid WHERE cp IN (1, 2) AND status <> 'DNS'""",
    "f_courses": "SELECT race_key, year, race_family, race_family || '-' || CASE WHEN year <= 1997 THEN 'a' WHEN year <= 1999 THEN 'b' ELSE 'c' END AS course_version, CASE WHEN year <= 1999 THEN race_family || '-ab' END AS course_group FROM f_races",
    "f_route_points": """SELECT user_id AS route_id, user_id % 10 AS family, idx, 55.5::DOUBLE + idx * 0.0005::DOUBLE + (value - 150) / 100000 AS lat, 14 + idx * 0.0007::DOUBLE + (user_id % 10) * 0.0002::DOUBLE AS lon,
      CASE WHEN event_type <> 'error' THEN value END AS ele FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx FROM events)""",
    "f_landmarks": "SELECT s_suppkey AS landmark, s_name AS title, s_suppkey % 10 AS family, 55.5::DOUBLE + (s_suppkey % 90) * 0.0005::DOUBLE + (s_nationkey - 12) / 5000 AS lat, 14 + (s_suppkey % 90) * 0.0007::DOUBLE + (s_suppkey % 10) * 0.0002::DOUBLE AS lon FROM supplier",
    # observations of each result at each boundary: never interpolated
    "f_obs": """SELECT r.race_key, r.rid, r.status, r.sex, r.class_name, r.club, r.age, r.finish_seconds, c.cp_key, c.seq, c.km, CASE c.cp_key WHEN 'start' THEN CASE WHEN r.status NOT IN ('DNS', 'UNKNOWN') THEN 0.0::DOUBLE END
      WHEN 'finish' THEN CASE WHEN r.status = 'FINISHED' AND r.finish_seconds > 0 THEN r.finish_seconds END ELSE s.elapsed_seconds END AS seconds,
      CASE c.cp_key WHEN 'finish' THEN r.overall_place ELSE s.place_overall END AS place
    FROM f_places r JOIN f_checkpoints c ON r.race_key = c.race_key LEFT JOIN f_splits s ON s.rid = r.rid AND s.cp_key = c.cp_key""",
    "f_seg": """SELECT race_key, rid, status, sex, class_name, club, finish_seconds, seq AS seg_no, cp_key AS from_key, to_key, CASE WHEN to_s - seconds > 0 THEN to_s - seconds END AS seconds, to_km - km AS km,
      CASE WHEN to_s - seconds > 0 THEN (to_s - seconds) / (to_km - km) END AS pace, place - to_place AS gain, to_s AS elapsed, to_place
    FROM (SELECT *, lead(cp_key) OVER w AS to_key, lead(seconds) OVER w AS to_s, lead(km) OVER w AS to_km, lead(place) OVER w AS to_place FROM f_obs WINDOW w AS (PARTITION BY rid ORDER BY seq)) WHERE to_key IS NOT NULL""",
    "f_complete": """SELECT rid FROM f_obs o JOIN (SELECT race_key, count(*) AS n_cp FROM f_checkpoints GROUP BY race_key) n ON o.race_key = n.race_key
    WHERE status = 'FINISHED' AND finish_seconds > 0 GROUP BY rid HAVING count(seconds) = max(n_cp)""",
    "f_segc": "SELECT s.* FROM f_seg s SEMI JOIN f_complete c ON s.rid = c.rid",
}


def oracle(sql: str) -> str:
    """``sql`` with the definitions that it needs before it."""
    needed, queue = set(), [sql]
    while queue:
        text = queue.pop()
        found = {n for n in CTE if re.search(rf"\b{n}\b", text)} - needed
        needed |= found
        queue += [CTE[n] for n in found]
    head = ",\n".join(f"{n} AS ({q})" for n, q in CTE.items() if n in needed)
    body = re.sub(r"^\s*WITH\s+", "", sql)
    if body != sql:
        return f"WITH {head},\n{body}" if head else f"WITH {body}"
    return f"WITH {head}\n{sql}" if head else sql
