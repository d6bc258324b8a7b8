"""Joins, set operations, filters and text columns over the race data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.functions import text as tx
from racelab.operators import stats as st
from racelab.operators.observations import finished, laid_out, observations, starter
from racelab.plans.base import Book, Data
from racelab.plans.stats import FIN, START
from racelab.sources import fixtures as fx

book = Book()
query = book.query


@query("SELECT r.race_key, r.rid, s.cp_key, s.elapsed_seconds FROM f_results r JOIN f_splits s ON r.rid = s.rid")
def jn_inner_result_splits(d: Data) -> DataFrame:
    return d.results.join(d.splits.drop("race_key"), "rid").select("race_key", "rid", "cp_key", "elapsed_seconds")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def jn_left_orphan(d: Data) -> DataFrame:
    return d.table("orders").select("o_orderkey").join(d.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey", "left_anti")


@query("SELECT a.rid, a.seq AS seq, b.elapsed_seconds - a.elapsed_seconds AS gap FROM f_splits a JOIN f_splits b ON a.rid = b.rid AND b.seq = a.seq + 1")
def jn_self_adjacent(d: Data) -> DataFrame:
    """Neighbouring passages, without a self-join; a missing sequence number parts them."""
    w = Window.partitionBy("rid").orderBy("seq")
    x = d.splits.select("rid", F.lag("seq").over(w).alias("before"), "seq", (F.col("elapsed_seconds") - F.lag("elapsed_seconds").over(w)).alias("gap"))
    return x.where("seq = before + 1").select("rid", F.col("before").alias("seq"), "gap")


@query("SELECT rid, n_name AS nation, r_name AS region FROM f_results JOIN nation ON club = n_name JOIN region ON n_regionkey = r_regionkey")
def jn_dim_lookup(d: Data) -> DataFrame:
    """Lookups in configuration tables; Spark broadcasts them while they are small."""
    dim = d.table("nation").join(d.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_name", "r_name")
    return d.results.join(dim, F.col("club") == F.col("n_name"), "left").select("rid", F.col("n_name").alias("nation"), F.col("r_name").alias("region"))


@query("SELECT r.rid, o.o_totalprice AS raw_value FROM f_results r LEFT JOIN (SELECT *, year(o_orderdate) AS y FROM orders JOIN customer ON o_custkey = c_custkey) o ON o.y = r.year AND lower(o.c_mktsegment) = r.race_family AND o.o_orderkey = r.rid")
def jn_composite_key(d: Data) -> DataFrame:
    raw = d.table("orders").join(d.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    raw = raw.select(F.year("o_orderdate").alias("year"), F.lower("c_mktsegment").alias("race_family"), F.col("o_orderkey").alias("rid"), F.col("o_totalprice").alias("raw_value"))
    return d.results.select("year", "race_family", "rid").join(raw, ["year", "race_family", "rid"], "left").select("rid", "raw_value")


@query("SELECT s.rid, s.cp_key FROM f_splits s WHERE s.rid NOT IN (SELECT rid FROM f_results WHERE custkey % 100 = 0)")
def jn_anti_cascade(d: Data) -> DataFrame:
    """Children of removed parents go."""
    return d.splits.join(d.results.where("custkey % 100 = 0"), "rid", "left_anti").select("rid", "cp_key")


def leaders(d: Data, most: int = 5) -> DataFrame:
    """The timed results on the first places, with overall_place: Spark keeps each task's first rows only before it shuffles."""
    return st.top(d.timed.where("finish_seconds is not null"), most, ["race_key"], F.col("finish_seconds"), F.col("rid")).withColumnRenamed("rank", "overall_place")


def beside_winner(rows: DataFrame, at: str, values: dict[str, str]) -> DataFrame:
    """Rows of leaders, each beside the winner's of the same race and place of measurement ``at``.

    Column c of ``values`` becomes ``<name>b``, the winner's ``<name>a``; ``a`` and ``b`` are the results' rids.
    """
    w = Window.partitionBy("race_key", at)
    first = lambda c: F.max(F.when(F.col("overall_place") == 1, F.col(c))).over(w)
    x = rows.withColumns({"a": first("rid")} | {f"{name}a": first(c) for c, name in values.items()})
    return x.where("overall_place > 1").withColumnsRenamed({"rid": "b"} | {c: f"{name}b" for c, name in values.items()})


def laid_leaders(d: Data, places: bool = False) -> DataFrame:
    """The leaders' observations in their rows; with their places at checkpoints if asked for."""
    first = leaders(d)
    if places:
        first = first.join(fx.placed(d.timed.select("rid", "race_key", "sex", "elapsed_1", "elapsed_2"), ["place_1", "place_2"], d.most).select("rid", "place_1", "place_2"), "rid")
    return laid_out(first.withColumn("passages", fx.passages(tuple(first.columns))), d.checkpoints)


def checkpoint_pairs(d: Data, places: bool = False) -> DataFrame:
    """(race_key, a, b, cp_key, seq, sa, sb, pa, pb): both sides' observations at shared checkpoints."""
    known = observations(laid_leaders(d, places)).where("seconds is not null").select("race_key", "rid", "overall_place", "cp_key", "seq", "seconds", "place")
    return beside_winner(known, "cp_key", {"seconds": "s", "place": "p"}).where("sa is not null").drop("overall_place")


CP_PAIRS = """WITH few AS MATERIALIZED (SELECT race_key, rid, overall_place FROM f_places WHERE overall_place <= 5), o AS MATERIALIZED (SELECT o.rid, cp_key, seq, seconds, place FROM f_obs o SEMI JOIN few ON o.rid = few.rid WHERE seconds IS NOT NULL)
SELECT p.race_key, p.rid AS a, q.rid AS b, x.cp_key, x.seq, x.seconds AS sa, y.seconds AS sb, x.place AS pa, y.place AS pb FROM few p JOIN few q ON p.race_key = q.race_key AND p.overall_place = 1 AND q.overall_place > 1 JOIN o x ON x.rid = p.rid JOIN o y ON y.rid = q.rid AND y.cp_key = x.cp_key"""


@query(f"SELECT race_key, a, b, cp_key, sb - sa AS gap FROM ({CP_PAIRS})")
def jn_checkpoint_match(d: Data) -> DataFrame:
    return checkpoint_pairs(d).select("race_key", "a", "b", "cp_key", (F.col("sb") - F.col("sa")).alias("gap"))


@query("""WITH s AS (SELECT race_key, cp_key AS from_key, lead(cp_key) OVER (PARTITION BY race_key ORDER BY seq) AS to_key FROM f_checkpoints)
SELECT a.race_key, b.race_key AS other, a.from_key, a.to_key FROM s a JOIN s b ON a.from_key = b.from_key AND a.to_key = b.to_key JOIN f_races ra ON ra.race_key = a.race_key JOIN f_races rb ON rb.race_key = b.race_key AND ra.race_family = rb.race_family AND ra.year < rb.year""")
def jn_adjacent_boundary(d: Data) -> DataFrame:
    """Segments whose ends are neighbours in another edition's catalog too."""
    ahead = F.lead("cp_key").over(Window.partitionBy("race_key").orderBy("seq"))
    seg = d.checkpoints.select("race_key", F.col("cp_key").alias("from_key"), ahead.alias("to_key")).where("to_key is not null").join(d.races, "race_key")
    other = seg.select(F.col("race_key").alias("other"), "from_key", "to_key", "race_family", F.col("year").alias("y2"))
    return seg.join(other, ["race_family", "from_key", "to_key"]).where("year < y2").select("race_key", "other", "from_key", "to_key")


@query("SELECT race_key, c.rid FROM f_complete c JOIN f_results r ON r.rid = c.rid")
def jn_complete_cohort(d: Data) -> DataFrame:
    return d.results.join(d.complete, "rid", "left_semi").select("race_key", "rid")


@query("SELECT race_key, rid, arg_max(cp_key, elapsed_seconds) AS cp_key, max(elapsed_seconds) AS elapsed_seconds FROM f_splits WHERE elapsed_seconds <= 3600 GROUP BY 1, 2")
def jn_asof_passage(d: Data) -> DataFrame:
    """The latest passage at a time."""
    latest = d.splits.where("elapsed_seconds <= 3600").groupBy("race_key", "rid").agg(F.max(F.struct("elapsed_seconds", "cp_key")).alias("s"))
    return latest.select("race_key", "rid", "s.cp_key", "s.elapsed_seconds")


@query("""WITH k AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY seq) AS n FROM f_obs WHERE seconds IS NOT NULL), i AS (SELECT a.rid, a.cp_key AS from_key, b.cp_key AS to_key, a.seconds AS lo, b.seconds AS hi FROM k a JOIN k b ON a.rid = b.rid AND b.n = a.n + 1)
SELECT rid, t, from_key, to_key FROM i, (VALUES (1800.0::DOUBLE), (3600), (5400)) v(t) WHERE t > lo AND t <= hi""")
def jn_range_interval(d: Data) -> DataFrame:
    """The interval between two observations that holds a time: times are an array in each row, not a join."""
    w = Window.partitionBy("rid").orderBy("seq")
    known = d.obs.where("seconds is not null")
    spans = known.select("rid", F.lag("cp_key").over(w).alias("from_key"), F.col("cp_key").alias("to_key"), F.lag("seconds").over(w).alias("lo"), F.col("seconds").alias("hi"))
    grid = F.explode(F.filter(F.array(F.lit(1800.0), F.lit(3600.0), F.lit(5400.0)), lambda t: (t > F.col("lo")) & (t <= F.col("hi"))))
    return spans.where("lo is not null").select("rid", grid.alias("t"), "from_key", "to_key")


@query("SELECT a.race_key AS a, b.race_key AS b, a.race_family FROM f_races a JOIN f_races b ON a.race_family = b.race_family AND a.race_key < b.race_key")
def jn_pairs_same_family(d: Data) -> DataFrame:
    """Unordered pairs of a family's editions: as many as its years squared, not results."""
    r = d.races
    other = r.select("race_family", F.col("race_key").alias("b"))
    return r.select("race_family", F.col("race_key").alias("a")).join(other, "race_family").where("a < b").select("a", "b", "race_family")


@query("SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'missing' ELSE 'extra' END AS kind FROM (SELECT DISTINCT o_orderkey AS k FROM orders) a FULL JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_linenumber > 1) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL")
def jn_key_set_diff(d: Data) -> DataFrame:
    a = d.table("orders").select(F.col("o_orderkey").alias("k")).distinct()
    b = d.table("lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("k")).distinct()
    missing = a.join(b, "k", "left_anti").withColumn("kind", F.lit("missing"))
    return missing.unionByName(b.join(a, "k", "left_anti").withColumn("kind", F.lit("extra")))


_TWO = ("SELECT DISTINCT custkey FROM f_results WHERE year = 1996", "SELECT DISTINCT custkey FROM f_results WHERE year = 1997")


def _years(d: Data) -> tuple[DataFrame, DataFrame]:
    return tuple(d.results.where(F.col("year") == y).select("custkey") for y in (1996, 1997))


@query("SELECT rid, 'split' AS kind, elapsed_seconds AS seconds FROM f_splits UNION ALL SELECT rid, 'finish', finish_seconds FROM f_results")
def set_union_all(d: Data) -> DataFrame:
    a = d.splits.select("rid", F.lit("split").alias("kind"), F.col("elapsed_seconds").alias("seconds"))
    return a.unionByName(d.results.select("rid", F.lit("finish").alias("kind"), F.col("finish_seconds").alias("seconds")))


@query(" UNION ".join(_TWO))
def set_union_distinct(d: Data) -> DataFrame:
    a, b = _years(d)
    return a.union(b).distinct()


@query(" EXCEPT ".join(_TWO))
def set_except(d: Data) -> DataFrame:
    a, b = _years(d)
    return a.subtract(b)


@query(" INTERSECT ".join(_TWO))
def set_intersect(d: Data) -> DataFrame:
    a, b = _years(d)
    return a.intersect(b)


@query("SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2")
def set_distinct_order(d: Data) -> DataFrame:
    """The first of each kind, in order."""
    w = Window.partitionBy("user_id", "event_type").orderBy("event_id")
    return d.table("events").withColumn("n", F.row_number().over(w)).where("n = 1").select("user_id", "event_type", "event_id")


@query(f"SELECT rid FROM f_results WHERE {FIN}")
def prd_finished(d: Data) -> DataFrame:
    return d.results.where(finished()).select("rid")


@query(f"SELECT rid FROM f_results WHERE {START}")
def prd_starter(d: Data) -> DataFrame:
    return d.results.where(starter()).select("rid")


@query("SELECT race_key, rid FROM f_results WHERE sex = 'F' AND class_name = '1-URGENT' AND status = 'FINISHED' AND contains(lower(club), 'nation_1')")
def flt_rows(d: Data) -> DataFrame:
    return d.results.where((F.col("sex") == "F") & (F.col("class_name") == "1-URGENT") & (F.col("status") == "FINISHED") & F.lower("club").contains("nation_1")).select("race_key", "rid")


@query("SELECT race_key, rid FROM f_results WHERE contains(lower(concat_ws(' ', name, bib, club)), 'nation_7')")
def flt_search(d: Data) -> DataFrame:
    return d.results.where(F.lower(F.concat_ws(" ", "name", "bib", "club")).contains("nation_7")).select("race_key", "rid")


@query("SELECT year, race_family, rid, overall_place FROM f_places WHERE year IN (1996, 1998) AND race_family IN ('building', 'machinery')")
def flt_roster(d: Data) -> DataFrame:
    chosen = d.placed.where(F.col("year").isin(1996, 1998) & F.col("race_family").isin("building", "machinery"))
    return chosen.orderBy("year", "race_family", F.asc_nulls_last("overall_place"), "finish_seconds", "name").select("year", "race_family", "rid", "overall_place")


_HMS = "CAST(finish_seconds AS BIGINT) // 3600 || ':' || lpad(CAST(CAST(finish_seconds AS BIGINT) // 60 % 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(CAST(finish_seconds AS BIGINT) % 60 AS VARCHAR), 2, '0')"


@query(f"SELECT rid, {_HMS} AS shown FROM f_results WHERE finish_seconds IS NOT NULL")
def fn_format_time(d: Data) -> DataFrame:
    return d.results.where("finish_seconds is not null").select("rid", tx.format_time(F.col("finish_seconds")).alias("shown"))


@query("SELECT rid, CAST(finish_seconds AS BIGINT) AS seconds FROM f_results WHERE finish_seconds IS NOT NULL")
def fn_parse_seconds(d: Data) -> DataFrame:
    """Formatted times, with white space around them, parse back to themselves."""
    padded = F.concat(F.lit(" \t"), tx.format_time(F.col("finish_seconds")), F.lit("\u00a0"))
    return d.results.where("finish_seconds is not null").select("rid", tx.parse_seconds(padded).cast("long").alias("seconds"))


@query("SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS seconds FROM events")
def fn_clock_seconds(d: Data) -> DataFrame:
    return d.table("events").select("event_id", tx.clock_seconds(F.date_format("ts", "HH:mm:ss")).alias("seconds"))


@query("SELECT event_id, least(abs(s - 43200), abs(s + 86400 - 43200), abs(s - 43200 - 86400)) AS delta FROM (SELECT event_id, CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS INTEGER) AS s FROM events)")
def fn_clock_delta(d: Data) -> DataFrame:
    return d.table("events").select("event_id", tx.clock_delta(tx.clock_seconds(F.date_format("ts", "HH:mm:ss")), F.lit(43200)).alias("delta"))


@query("SELECT p_partkey, CAST(p_size AS DOUBLE) + 0.5::DOUBLE AS km FROM part")
def fn_parse_distance(d: Data) -> DataFrame:
    """Comma or point, ``km`` in either case, with or without white space before it."""
    forms = F.array(*map(F.lit, (",5 km", ".5km", ",5  KM", ".50\u00a0Km")))
    text = F.concat(F.lit("Varv "), F.col("p_size").cast("string"), F.get(forms, (F.col("p_partkey") % 4).cast("int")), F.lit(" av 99 km"))
    return d.table("part").select("p_partkey", tx.parse_distance(text).alias("km"))


@query("SELECT rid, overall_place AS place, CAST(n AS INTEGER) AS of FROM (SELECT *, count(overall_place) OVER (PARTITION BY race_key) AS n FROM f_places) WHERE overall_place IS NOT NULL")
def fn_parse_rank_of(d: Data) -> DataFrame:
    n = F.count("overall_place").over(Window.partitionBy("race_key"))
    text = d.placed.withColumn("t", F.concat_ws(" Av ", "overall_place", n)).where("overall_place is not null")
    return text.select("rid", tx.parse_rank_of(F.col("t")).alias("r")).select("rid", "r.place", F.col("r.count").alias("of"))


@query("SELECT rid, overall_place AS overall, gender_place AS gender, class_place AS class_ FROM f_places WHERE gender_place IS NOT NULL")
def fn_parse_rank_triple(d: Data) -> DataFrame:
    text = F.concat_ws(" / ", "overall_place", "gender_place", "class_place")
    return d.placed.where("gender_place is not null").select("rid", tx.parse_rank_triple(text).alias("r")).select("rid", "r.*")


@query("SELECT c_custkey, CAST(c_custkey AS INTEGER) AS place FROM customer")
def fn_parse_place(d: Data) -> DataFrame:
    return d.table("customer").select("c_custkey", tx.parse_place(F.split_part("c_name", F.lit("#"), F.lit(2))).alias("place"))


@query("SELECT rid, 'anon-' || substr(sha256('results|' || race_key || '|' || bib), 1, 20) AS opaque FROM f_results")
def fn_opaque_id(d: Data) -> DataFrame:
    return d.results.select("rid", tx.opaque_id("results", F.col("race_key"), F.col("bib")).alias("opaque"))


@query("SELECT rid, CASE WHEN custkey % 9 <> 0 THEN club END AS value FROM f_results")
def fn_list_value(d: Data) -> DataFrame:
    """The value under a header; an empty cell is null."""
    cell = F.when(F.col("custkey") % 9 == 0, "  ").otherwise(F.concat(F.lit(" "), "club", F.lit("\t")))
    return d.results.select("rid", tx.list_value(F.array(F.lit("Bib"), F.lit(" CLUB \t Name "), F.lit("Name")), F.array(F.col("bib"), cell, F.col("name")), "club name").alias("value"))


@query("SELECT rid, name, club FROM f_results")
def fn_pair_map(d: Data) -> DataFrame:
    """Label and value rows as a map, where a later pair replaces an earlier one."""
    pairs = F.array(*(F.struct(F.lit(k).alias("k"), F.col(c).alias("v")) for k, c in (("name", "bib"), ("club", "club"), ("name", "name"))))
    last = lambda k: F.element_at(F.filter(pairs, lambda p: p["k"] == k), -1)["v"]
    return d.results.select("rid", last("name").alias("name"), last("club").alias("club"))


@query("SELECT rid, sex, CASE WHEN age IS NOT NULL THEN (age // 5 * 5) || '-' || (age // 5 * 5 + 4) END AS age_category FROM f_results WHERE sex IS NOT NULL")
def fn_category_split(d: Data) -> DataFrame:
    low = F.expr("age div 5 * 5")
    text = F.concat("sex", F.coalesce(F.concat_ws("-", low, F.when(F.col("age").isNotNull(), low + 4)), F.lit("")))
    return d.results.where("sex is not null").select("rid", tx.category_split(text).alias("r")).select("rid", "r.sex", "r.age_category")


def raw_text(d: Data) -> Column:
    """A result's list row as one text: time, status, class and club."""
    return F.concat_ws(" ", tx.format_time(F.col("finish_seconds")), F.initcap("status"), "class_name", F.concat(F.lit("("), F.lower("status"), F.lit(")")), "club")


@query("SELECT rid, CASE WHEN status IN ('DNF', 'DNS', 'DSQ') THEN status END AS detected FROM f_results")
def fn_status_detect(d: Data) -> DataFrame:
    return d.results.select("rid", tx.status_detect(raw_text(d)).alias("detected"))


@query("SELECT lower(status) AS word, 2 * count(*) AS n FROM f_results WHERE status IN ('DNF', 'DNS', 'DSQ') GROUP BY 1")
def fn_status_words(d: Data) -> DataFrame:
    """How often each status word stands in raw texts, in either case."""
    return d.results.select(F.explode(tx.status_words(raw_text(d))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, family, CASE family WHEN 'duo60' THEN 60 WHEN 'trail22' THEN 22 WHEN 'trail14' THEN 14 WHEN 'trail5' THEN 5 END AS nominal, CASE WHEN p_size IN (5, 13, 14, 21, 22) THEN CAST(p_size AS INTEGER) WHEN family = 'duo60' THEN 60 END AS stated
FROM (SELECT *, CASE WHEN p_brand LIKE 'Brand#1%' THEN 'duo60' WHEN p_size IN (21, 22) THEN 'trail22' WHEN p_size IN (13, 14) THEN 'trail14' WHEN p_size = 5 THEN 'trail5' END AS family FROM part)""")
def fn_race_family(d: Data) -> DataFrame:
    """Labels of a part's type, brand and size as km: family by the first pattern that fits, its distance, the distance stated."""
    label = F.concat_ws("  ", F.lower("p_type"), F.replace("p_brand", F.lit("Brand#1"), F.lit("Duo #")), F.concat("p_size", F.lit(" KM")))
    family = tx.race_family(label)
    return d.table("part").select("p_partkey", family.alias("family"), tx.nominal_km(family).alias("nominal"), tx.historical_km(label).alias("stated"))


@query("SELECT rid, cp_key, CASE WHEN cp_key IN ('start', 'finish') THEN cp_key END AS landmark FROM f_obs")
def fn_semantic_landmark(d: Data) -> DataFrame:
    """What each observation's checkpoint stands for by its label."""
    labels = d.checkpoints.select("race_key", "cp_key", "label")
    return d.obs.join(labels, ["race_key", "cp_key"]).select("rid", "cp_key", tx.landmark(F.upper("label"), F.array("club")).alias("landmark"))


@query("SELECT c_custkey, regexp_replace(regexp_replace(c_name, '[A-Za-z]+', '<A>', 'g'), '[0-9]+', '<N>', 'g') || ' <A> <N>⁄<N>' AS shape FROM customer")
def fn_mask_shape(d: Data) -> DataFrame:
    """Shapes also of texts with composed letters, wide digits, fractions and other white space."""
    return d.table("customer").select("c_custkey", tx.mask_shape(F.concat(F.lit("\u00a0 "), "c_name", F.lit("  Ärê \t１½ "))).alias("shape"))


def cell_texts() -> list[Column]:
    """The forms that cells have in published tables, from a result's own values: nothing, labels, digits, numbers, times, distances, other texts."""
    bib, digit, cust = F.col("bib"), F.right("bib", F.lit(1)), F.col("custkey")
    return [
        F.lit(""), F.lit(" \u00a0"), F.lit(None).cast("string"), F.lit("Klass"), F.concat(F.lit(" mellantid "), digit), digit, F.concat(F.lit("1"), bib), F.concat(bib, F.lit(",5")),
        tx.format_time(cust % 86400), F.format_string("%d:%02d", cust % 60, F.col("rid") % 60), F.concat(100 + cust % 60, F.lit(":45")), F.concat(bib, F.lit(" KM")), F.concat(bib, F.lit(".5km")),
        F.concat(F.lit("Klass "), "club"), F.concat(F.lit("-"), bib),
    ]


@query("""SELECT rid, CASE WHEN finish_seconds IS NULL THEN '<EMPTY>' ELSE '<TIME>' END AS time_cell,
  CASE rid % 15 WHEN 3 THEN 'Klass' WHEN 4 THEN 'mellantid ' || right(bib, 1) WHEN 5 THEN right(bib, 1) WHEN 6 THEN '<NUMBER>' WHEN 7 THEN '<NUMBER>' WHEN 8 THEN '<TIME>' WHEN 9 THEN '<TIME>'
    WHEN 10 THEN '<TEXT>' WHEN 11 THEN '<DISTANCE>' WHEN 12 THEN '<DISTANCE>' WHEN 13 THEN '<TEXT>' WHEN 14 THEN '<TEXT>' ELSE '<EMPTY>' END AS cell,
  CASE WHEN length(bib) = 1 THEN bib ELSE '<NUMBER>' END AS bib_cell, CASE WHEN age IS NULL THEN '<EMPTY>' ELSE '<DISTANCE>' END AS km_cell,
  CASE WHEN rid % 2 = 0 THEN '<LINKED_TEXT>' ELSE '<TEXT>' END AS club_cell FROM f_results""")
def fn_safe_cell(d: Data) -> DataFrame:
    """Cells of every result: its time, number, kilometres and linked club, and one in each of the forms in turn."""
    texts = cell_texts()
    cell = F.get(F.array(*texts), (F.col("rid") % len(texts)).cast("int"))
    cells = {"time_cell": tx.safe_cell(tx.format_time(F.col("finish_seconds"))), "cell": tx.safe_cell(cell), "bib_cell": tx.safe_cell(F.concat("bib", F.lit(" "))), "km_cell": tx.safe_cell(F.concat("age", F.lit(" KM"))), "club_cell": tx.safe_cell(F.col("club"), F.col("rid") % 2 == 0)}
    return d.results.select("rid", *(c.alias(name) for name, c in cells.items()))


@query("SELECT rid, CASE WHEN custkey % 5 = 0 THEN 'person ' || bib ELSE name END AS shown FROM f_results")
def fn_presentation_name(d: Data) -> DataFrame:
    name = F.when(F.col("custkey") % 5 == 0, F.lit(" Undefined ")).otherwise(F.col("name"))
    return d.results.select("rid", tx.presentation_name(name, F.lit("person"), F.col("bib")).alias("shown"))


@query("SELECT rid, lower(trim(club)) AS group_key FROM f_results")
def fn_normalize_group(d: Data) -> DataFrame:
    from racelab.operators.stats import normalized

    return d.results.select("rid", normalized(F.concat(F.lit("  "), F.col("club"), F.lit(" "))).alias("group_key"))


@query("SELECT rid, CAST(floor(finish_seconds / 60 + 0.5::DOUBLE) AS BIGINT) // 60 || ':' || lpad(CAST(CAST(floor(finish_seconds / 60 + 0.5::DOUBLE) AS BIGINT) % 60 AS VARCHAR), 2, '0') || ' min/km' AS pace FROM f_results WHERE finish_seconds IS NOT NULL")
def fn_format_pace(d: Data) -> DataFrame:
    return d.results.where("finish_seconds is not null").select("rid", tx.format_pace(F.col("finish_seconds") / 60).alias("pace"))


@query("SELECT rid, CASE status WHEN 'FINISHED' THEN 'Fullföljt' WHEN 'DNF' THEN 'DNF' WHEN 'DNS' THEN 'Startade inte' WHEN 'DSQ' THEN 'Diskvalificerad' ELSE 'Okänd status' END AS label FROM f_results")
def fn_status_label(d: Data) -> DataFrame:
    return d.results.select("rid", tx.status_label(F.col("status")).alias("label"))


@query("SELECT event_id, CASE WHEN g <= -6 THEN 'steep down' WHEN g <= -2 THEN 'down' WHEN g < 1 THEN 'flat' WHEN g < 4 THEN 'up' WHEN g < 8 THEN 'climb' ELSE 'steep climb' END AS grade FROM (SELECT event_id, value - 12 AS g FROM events)")
def fn_grade_color(d: Data) -> DataFrame:
    return d.table("events").select("event_id", tx.grade_class(F.col("value") - 12).alias("grade"))


@query("SELECT c_custkey, lower(replace(c_name, '#', '-')) AS slug FROM customer")
def fn_slug(d: Data) -> DataFrame:
    return d.table("customer").select("c_custkey", tx.slug(F.col("c_name")).alias("slug"))


@query("SELECT c_custkey, lower(c_name) AS name FROM customer")
def fn_normalize_name(d: Data) -> DataFrame:
    return d.table("customer").select("c_custkey", tx.normalize_name(F.concat(F.lit("  "), F.col("c_name"))).alias("name"))


@query("SELECT c_custkey, sha256(lower(c_name)) AS fingerprint FROM customer")
def fn_name_fingerprint(d: Data) -> DataFrame:
    return d.table("customer").select("c_custkey", tx.name_fingerprint(F.col("c_name")).alias("fingerprint"))


QUERIES, ORACLE = book.queries, book.sql
