"""Comparability of editions, duels and history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators.observations import segments
from racelab.plans.base import Book, Data
from racelab.plans.joins import CP_PAIRS, beside_winner, checkpoint_pairs, laid_leaders
from racelab.plans.rankings import _SLOWER, slower
from racelab.plans.segments import _REF, _SEG_STATS, segment_stats, with_reference
from racelab.plans.stats import _EDITION, FIN, editions

book = Book()
query = book.query

_COMP = """SELECT a.race_key AS a, b.race_key AS b, a.race_family, a.year AS year_a, b.year AS year_b, a.race_key = b.race_key OR a.course_version = b.course_version OR coalesce(a.course_group = b.course_group, FALSE) AS comparable
FROM f_courses a JOIN f_courses b ON a.race_family = b.race_family"""


def comparable(courses: DataFrame) -> DataFrame:
    """Pairs of a family's editions and whether whole courses compare: as many as years squared."""
    b = courses.select("race_family", F.col("race_key").alias("b"), F.col("year").alias("year_b"), F.col("course_version").alias("v_b"), F.col("course_group").alias("g_b"))
    same = (F.col("race_key") == F.col("b")) | (F.col("course_version") == F.col("v_b")) | F.coalesce(F.col("course_group") == F.col("g_b"), F.lit(False))
    return courses.join(b, "race_family").select(F.col("race_key").alias("a"), "b", "race_family", F.col("year").alias("year_a"), "year_b", same.alias("comparable"))


@query(_COMP)
def cmp_comparable(d: Data) -> DataFrame:
    return comparable(d.courses)


@query(f"""WITH e AS ({_EDITION}), s AS (SELECT race_key, count(DISTINCT cp_key) AS n FROM f_splits GROUP BY 1)
SELECT c.a, c.b, comparable AS whole_course, coalesce(x.n, 0) >= 1 AND coalesce(y.n, 0) >= 1 AND comparable AS checkpoints, p.finished >= 5 AND q.finished >= 5 AS field, coalesce(x.n, 0) >= 2 AND coalesce(y.n, 0) >= 2 AS replay
FROM ({_COMP}) c JOIN e p ON p.race_key = c.a JOIN e q ON q.race_key = c.b LEFT JOIN s x ON x.race_key = c.a LEFT JOIN s y ON y.race_key = c.b""")
def cmp_edition_capabilities(d: Data) -> DataFrame:
    """What may be compared of two editions."""
    seen = d.splits.groupBy("race_key").agg(F.count_distinct("cp_key").alias("n"))
    e = editions(d.results).select("race_key", "finished").join(seen, "race_key", "left").select("race_key", "finished", F.coalesce("n", F.lit(0)).alias("n"))
    side = lambda x: e.select(F.col("race_key").alias(x), F.col("finished").alias(f"fin_{x}"), F.col("n").alias(f"n_{x}"))
    return comparable(d.courses).join(side("a"), "a").join(side("b"), "b").selectExpr(
        "a", "b", "comparable AS whole_course", "n_a >= 1 AND n_b >= 1 AND comparable AS checkpoints", "fin_a >= 5 AND fin_b >= 5 AS field", "n_a >= 2 AND n_b >= 2 AS replay"
    )


_GATES = """WITH few AS MATERIALIZED (SELECT race_key, rid, overall_place, status, finish_seconds FROM f_places WHERE overall_place <= 5), o AS MATERIALIZED (SELECT o.* FROM f_obs o SEMI JOIN few ON o.rid = few.rid),
s AS MATERIALIZED (SELECT g.rid, g.seg_no, g.pace FROM f_seg g SEMI JOIN few ON g.rid = few.rid WHERE g.seconds IS NOT NULL), f AS (SELECT race_key, seg_no FROM f_segc GROUP BY 1, 2 HAVING count(pace) >= 5),
p AS (SELECT x.race_key, x.rid AS a, y.rid AS b FROM few x JOIN few y ON x.race_key = y.race_key AND x.overall_place = 1 AND y.overall_place > 1),
c AS (SELECT p.race_key, p.a, p.b, count(x.seconds) >= 2 AND count(y.seconds) >= 2 AS anchored, count(*) FILTER (WHERE x.cp_key <> 'start' AND x.seconds IS NOT NULL AND y.seconds IS NOT NULL) AS common,
  count(*) FILTER (WHERE x.cp_key <> 'start' AND x.seconds IS NOT NULL AND y.seconds IS NOT NULL AND x.place IS NOT NULL AND y.place IS NOT NULL) AS placed, count(*) FILTER (WHERE x.cp_key NOT IN ('start', 'finish') AND x.seconds IS NOT NULL AND y.seconds IS NOT NULL) AS inner_common
  FROM p JOIN o x ON x.rid = p.a JOIN o y ON y.rid = p.b AND y.cp_key = x.cp_key GROUP BY 1, 2, 3),
g AS (SELECT p.a, p.b, count(*) AS segs, count(*) FILTER (WHERE f.seg_no IS NOT NULL) AS field FROM p JOIN s x ON x.rid = p.a JOIN s y ON y.rid = p.b AND x.seg_no = y.seg_no LEFT JOIN f ON f.race_key = p.race_key AND f.seg_no = x.seg_no GROUP BY 1, 2),
r AS (SELECT race_key, count(*) >= 5 AS can_segment, count(DISTINCT cp_key) >= 2 AND count(*) >= 5 AS can_replay FROM (SELECT race_key, rid, cp_key FROM f_splits) GROUP BY 1)
SELECT c.race_key, c.a, c.b, TRUE AS exact_two, TRUE AS finish_comparison, common > 0 AS checkpoint_gap, placed > 0 AS placement_journey, coalesce(can_segment AND segs > 0, FALSE) AS segment_comparison, coalesce(can_segment AND field > 0, FALSE) AS edition_field_normalization,
  year <= 1999 AS shared_course_context, anchored AND coalesce(can_replay, FALSE) AND year <= 1999 AS animated_two_result_comparison, anchored AND coalesce(can_replay, FALSE) AND year <= 1999 AS elevation_seek, TRUE AS shareable_comparison_state, FALSE AS cross_edition_comparison,
  inner_common <= 1 AS sparse_comparison_fallback, race_family = 'furniture' AS team_entity, anchored AND coalesce(can_replay, FALSE) AND year <= 1999 AS audio
FROM c JOIN f_races USING (race_key) LEFT JOIN g ON g.a = c.a AND g.b = c.b LEFT JOIN r ON r.race_key = c.race_key"""


def gates(pairs: DataFrame) -> DataFrame:
    """What may be shown of two results beside each other: fourteen gates.

    ``pairs`` have both sides' observations (``oa``, ``ob``: arrays by boundary) and status, the seg_nos with five
    paces in the field, and what the race is capable of: ``can_segment``, ``can_replay``, ``has_route``, ``is_team``.
    """
    both = F.arrays_zip("oa", "ob")
    known = lambda x, c: x["oa"][c].isNotNull() & x["ob"][c].isNotNull()
    common = F.filter(both, lambda x: (x["oa"]["cp_key"] != "start") & known(x, "seconds"))
    inner = F.filter(common, lambda x: x["oa"]["cp_key"] != "finish")
    took = lambda o, i: o[i + 1]["seconds"] - o[i]["seconds"]
    at = F.sequence(F.lit(0), F.size("oa") - 2)
    shared = F.filter(at, lambda i: F.coalesce((took(F.col("oa"), i) > 0) & (took(F.col("ob"), i) > 0), F.lit(False)))
    anchors = lambda o: F.size(F.filter(o, lambda x: x["seconds"].isNotNull())) >= 2
    moving = anchors("oa") & anchors("ob") & F.col("can_replay") & F.col("has_route")
    yes, no = F.lit(True), F.lit(False)
    return pairs.withColumns({"common": common, "inner": inner, "shared": F.transform(shared, lambda i: F.col("oa")[i]["seq"])}).select(
        "race_key", "a", "b", yes.alias("exact_two"), ((F.col("status_a") == "FINISHED") & (F.col("status_b") == "FINISHED")).alias("finish_comparison"), (F.size("common") > 0).alias("checkpoint_gap"),
        F.exists("common", lambda x: known(x, "place")).alias("placement_journey"), (F.col("can_segment") & (F.size("shared") > 0)).alias("segment_comparison"),
        (F.col("can_segment") & F.arrays_overlap("shared", F.coalesce("field", F.array().cast("array<int>")))).alias("edition_field_normalization"), F.col("has_route").alias("shared_course_context"),
        moving.alias("animated_two_result_comparison"), moving.alias("elevation_seek"), yes.alias("shareable_comparison_state"), no.alias("cross_edition_comparison"), (F.size("inner") <= 1).alias("sparse_comparison_fallback"),
        F.col("is_team").alias("team_entity"), moving.alias("audio"),
    )


@query(_GATES)
def cmp_capabilities(d: Data) -> DataFrame:
    """Fourteen gates for the winner of each race beside the next four."""
    first = laid_leaders(d, places=True)
    side = lambda x, c: first.where(c).select("race_key", *(["year", "race_family"] if x == "a" else []), F.col("rid").alias(x), F.col("status").alias(f"status_{x}"), F.col("observed").alias(f"o{x}"))
    pairs = side("a", "overall_place = 1").join(side("b", "overall_place > 1"), "race_key")
    n = F.count("*")
    capable = d.splits.groupBy("race_key").agg((n >= 5).alias("can_segment"), ((F.count_distinct("cp_key") >= 2) & (n >= 5)).alias("can_replay"))
    field = d.cohort_segments.groupBy("race_key", "seg_no").agg(F.count("pace").alias("n")).where("n >= 5").groupBy("race_key").agg(F.collect_list("seg_no").alias("field"))
    x = pairs.join(capable, "race_key", "left").join(field, "race_key", "left").fillna(False, ["can_segment", "can_replay"])
    return gates(x.withColumns({"has_route": F.col("year") <= 1999, "is_team": F.col("race_family") == "furniture"}))


@query(f"SELECT race_key, a, b, cp_key, seq, sb - sa AS gap FROM ({CP_PAIRS})")
def cmp_checkpoint_gap(d: Data) -> DataFrame:
    return checkpoint_pairs(d).select("race_key", "a", "b", "cp_key", "seq", (F.col("sb") - F.col("sa")).alias("gap"))


@query(f"""WITH g AS (SELECT race_key, a, b, seq, cp_key, sb - sa AS gap FROM ({CP_PAIRS})), z AS (SELECT *, sign(gap) <> lag(sign(gap)) OVER (PARTITION BY a, b ORDER BY seq) AS flip FROM g WHERE gap <> 0)
SELECT race_key, a, b, count(*) FILTER (WHERE flip) AS lead_changes, max(abs(gap)) AS widest, min(abs(gap)) AS nearest, count(*) FILTER (WHERE gap > 0) AS a_ahead, count(*) FILTER (WHERE gap < 0) AS b_ahead, arg_max(cp_key, seq) AS last_shared FROM z GROUP BY 1, 2, 3""")
def cmp_duel_summary(d: Data) -> DataFrame:
    """Lead changes and gaps of a pair over shared checkpoints; ties don't count."""
    gap = F.col("sb") - F.col("sa")
    g = checkpoint_pairs(d).withColumn("gap", gap).where("gap <> 0")
    flip = F.signum("gap") != F.lag(F.signum("gap")).over(Window.partitionBy("a", "b").orderBy("seq"))
    return g.withColumn("flip", flip).groupBy("race_key", "a", "b").agg(
        F.count_if("flip").alias("lead_changes"), F.max(F.abs("gap")).alias("widest"), F.min(F.abs("gap")).alias("nearest"),
        F.count_if(F.col("gap") > 0).alias("a_ahead"), F.count_if(F.col("gap") < 0).alias("b_ahead"), F.max_by("cp_key", "seq").alias("last_shared"),
    )


_PAIR = "SELECT a.race_key, a.rid AS a, b.rid AS b FROM f_places a JOIN f_places b ON a.race_key = b.race_key AND a.overall_place = 1 AND b.overall_place BETWEEN 2 AND 5"


@query(f"SELECT p.race_key, p.a, p.b, x.seg_no, y.seconds - x.seconds AS delta FROM ({_PAIR}) p JOIN f_seg x ON x.rid = p.a JOIN f_seg y ON y.rid = p.b AND x.seg_no = y.seg_no WHERE x.seconds IS NOT NULL AND y.seconds IS NOT NULL")
def cmp_segment_duel(d: Data) -> DataFrame:
    known = segments(laid_leaders(d)).where("seconds is not null").select("race_key", "rid", "overall_place", "seg_no", "seconds")
    x = beside_winner(known, "seg_no", {"seconds": "s"}).where("sa is not null")
    return x.select("race_key", "a", "b", "seg_no", (F.col("sb") - F.col("sa")).alias("delta"))


@query(f"SELECT s.race_key, s.rid, s.seg_no, 100.0::DOUBLE * (1 - pace / ref) AS faster_pct, 100.0::DOUBLE * (ref / pace - 1) AS index_pct FROM f_seg s JOIN ({_REF}) r ON r.race_key = s.race_key AND r.seg_no = s.seg_no WHERE {FIN} AND pace IS NOT NULL AND ref IS NOT NULL")
def cmp_vs_field(d: Data) -> DataFrame:
    x = with_reference(d).where("pace is not null and ref is not null")
    return x.select("race_key", "rid", "seg_no", (100.0 * (1 - F.col("pace") / F.col("ref"))).alias("faster_pct"), (100.0 * (F.col("ref") / F.col("pace") - 1)).alias("index_pct"))


@query(f"SELECT race_key, a, b, cp_key, pa, pb FROM ({CP_PAIRS}) WHERE pa IS NOT NULL AND pb IS NOT NULL")
def cmp_placement_journey(d: Data) -> DataFrame:
    return checkpoint_pairs(d, places=True).where("pa is not null and pb is not null").select("race_key", "a", "b", "cp_key", "pa", "pb")


_WIN = "SELECT race_key, rid, finish_seconds FROM f_places WHERE overall_place = 1"


@query(f"SELECT c.a, c.b, CASE WHEN comparable THEN y.finish_seconds - x.finish_seconds END AS gap FROM ({_COMP}) c JOIN ({_WIN}) x ON x.race_key = c.a JOIN ({_WIN}) y ON y.race_key = c.b")
def cmp_finish_gap(d: Data) -> DataFrame:
    """Winners of two editions; a gap only where whole courses compare."""
    win = d.placed.where("overall_place = 1")
    side = lambda x: win.select(F.col("race_key").alias(x), F.col("finish_seconds").alias(f"t{x}"))
    return comparable(d.courses).join(side("a"), "a").join(side("b"), "b").select("a", "b", F.when(F.col("comparable"), F.col("tb") - F.col("ta")).alias("gap"))


_PERSON_RESULTS = f"SELECT r.custkey, r.race_key, r.rid, r.status, r.finish_seconds, 100.0::DOUBLE * s.slower / s.n AS percentile FROM f_results r LEFT JOIN ({_SLOWER}) s ON s.rid = r.rid"


@query(_PERSON_RESULTS)
def cmp_person_results(d: Data) -> DataFrame:
    """Every person's results across editions, side by side."""
    pct = slower(d.results, d.most).select("rid", (100.0 * F.col("slower") / F.col("n")).alias("percentile"))
    return d.results.join(pct, "rid", "left").select("custkey", "race_key", "rid", "status", "finish_seconds", "percentile")


@query(f"SELECT *, count(*) OVER (PARTITION BY custkey) AS results FROM ({_PERSON_RESULTS}) QUALIFY count(DISTINCT race_key) OVER (PARTITION BY custkey) >= 2")
def cmp_multi_result(d: Data) -> DataFrame:
    """The results of every person who has some in two editions or more, with their number."""
    w = Window.partitionBy("custkey")
    x = cmp_person_results(d).withColumns({"results": F.count("*").over(w), "first": F.min("race_key").over(w), "last": F.max("race_key").over(w)})
    return x.where("first <> last").drop("first", "last")


@query(f"""WITH e AS ({_EDITION}), y AS (SELECT race_family, unnest(range(min(year), max(year) + 2)) AS year FROM e GROUP BY 1)
SELECT y.race_family, CAST(y.year AS INTEGER) AS year, e.starters, e.finished FROM y LEFT JOIN e ON e.race_family = y.race_family AND e.year = y.year""")
def his_participation(d: Data) -> DataFrame:
    """Starters and finishers by year; years without an edition stay null."""
    e = editions(d.results).select("race_family", "year", "starters", "finished")
    years = e.groupBy("race_family").agg(F.explode(F.sequence(F.min("year"), F.max("year") + 1)).alias("year"))
    return years.join(e, ["race_family", "year"], "left")


_LATEST = "SELECT race_family, max(year) AS latest FROM f_races GROUP BY 1"


def with_latest(d: Data) -> DataFrame:
    """Editions with whether they compare with the family's latest."""
    last = d.races.groupBy("race_family").agg(F.max("year").alias("year_a"))
    ok = comparable(d.courses).join(last, ["race_family", "year_a"]).select(F.col("b").alias("race_key"), "comparable")
    return editions(d.results).join(ok, "race_key")


_WITH_LATEST = f"SELECT e.*, c.comparable FROM ({_EDITION}) e JOIN ({_COMP}) c ON c.b = e.race_key JOIN ({_LATEST}) l ON l.race_family = c.race_family AND l.latest = c.year_a"


@query(f"SELECT race_key, year, CASE WHEN comparable THEN median END AS median FROM ({_WITH_LATEST})")
def his_performance(d: Data) -> DataFrame:
    return with_latest(d).select("race_key", "year", F.when(F.col("comparable"), F.col("median")).alias("median"))


#: Segments of two editions are the same one only as long as their distances differ by this many km at most.
SEGMENT_TOLERANCE_KM = 0.15


def segment_trend(stats: DataFrame, pairs: DataFrame, tolerance: float = SEGMENT_TOLERANCE_KM) -> DataFrame:
    """(race_key, from_key, to_key, pace_median): each segment beside the reference edition's segment of the same ends.

    ``stats`` are (race_key, from_key, to_key, distance_km, pace_median); ``pairs`` (reference, race_key, comparable). The
    median is null unless the editions compare and both distances are known and within ``tolerance``.
    """
    ends = ["from_key", "to_key"]
    ref = stats.select(F.col("race_key").alias("reference"), *ends, F.col("distance_km").alias("ref_km"))
    x = stats.join(pairs.select("reference", "race_key", "comparable"), "race_key").join(ref, ["reference", *ends])
    same = F.col("comparable") & (F.abs(F.col("distance_km") - F.col("ref_km")) <= tolerance)
    return x.select("race_key", *ends, F.when(same, F.col("pace_median")).alias("pace_median"))


@query(f"""WITH s AS (SELECT race_key, from_key, to_key, pace_median, km + (CAST(left(race_key, 4) AS INTEGER) - 1995) * 0.04::DOUBLE AS distance_km FROM ({_SEG_STATS}) JOIN (SELECT DISTINCT race_key, seg_no, km FROM f_seg) USING (race_key, seg_no))
SELECT s.race_key, s.from_key, s.to_key, CASE WHEN c.comparable AND abs(s.distance_km - r.distance_km) <= 0.15::DOUBLE THEN s.pace_median END AS pace_median
FROM s JOIN ({_COMP}) c ON c.b = s.race_key JOIN ({_LATEST.replace("max(year)", "min(year)")}) l ON l.race_family = c.race_family AND l.latest = c.year_a JOIN s r ON r.race_key = c.a AND r.from_key = s.from_key AND r.to_key = s.to_key""", rounded="pace_median")
def his_segment_trend(d: Data) -> DataFrame:
    """Median paces beside the family's first edition; an edition's course is 40 m a segment longer than the year's before."""
    ends = d.cohort_segments.select("race_key", "seg_no", (F.col("km") + (F.substring("race_key", 1, 4).cast("int") - 1995) * 0.04).alias("distance_km")).distinct()
    stats = segment_stats(d.cohort_segments).join(ends, ["race_key", "seg_no"])
    first = d.races.groupBy("race_family").agg(F.min("year").alias("year_a"))
    pairs = comparable(d.courses).join(first, ["race_family", "year_a"]).select(F.col("a").alias("reference"), F.col("b").alias("race_key"), "comparable")
    return segment_trend(stats, pairs)


#: Shares of women count only where so many starters, and this share of them, have a published sex.
SEX_KNOWN, SEX_COVERAGE = 20, 0.8
_WOMEN = "starters > 0 AND starters_with_sex >= 20 AND starters_with_sex >= 0.8::DOUBLE * starters"


def fingerprint(entries: DataFrame, pairs: DataFrame) -> DataFrame:
    """An edition against the median of at least two earlier ones, 100 being that median.

    ``entries`` are rows of ``editions``, ``pairs`` have (a, b, comparable) of a family's editions. Median time and share
    of DNF need comparable courses with a median; starters and share of women do not. An index is null with fewer than
    two references, without a value of its own, or where the median reference is 0.
    """
    share = F.when(F.col("starters") > 0, F.col("dnf") / F.col("starters"))
    enough = (F.col("starters") > 0) & (F.col("starters_with_sex") >= SEX_KNOWN) & (F.col("starters_with_sex") >= SEX_COVERAGE * F.col("starters"))
    women = F.when(enough, F.col("starters_f") / F.col("starters_with_sex"))
    measures = {"median": F.col("median"), "dnf": share, "starters": F.when(F.col("starters") > 0, F.col("starters")), "women": women}
    e = entries.select("race_key", "year", *(v.cast("double").alias(f"own_{k}") for k, v in measures.items()))
    ref = e.select(F.col("race_key").alias("b"), F.col("year").alias("year_b"), *(F.col(f"own_{k}").alias(f"ref_{k}") for k in measures))
    x = e.join(pairs.select(F.col("a").alias("race_key"), "b", "comparable"), "race_key").join(ref, "b")
    earlier = F.col("year_b") < F.col("year")
    counts = {k: earlier & ((F.col("comparable") & F.col("ref_median").isNotNull()) if k in ("median", "dnf") else F.lit(True)) for k in measures}
    held = lambda k: F.when(counts[k], F.col(f"ref_{k}"))
    s = x.groupBy("race_key").agg(F.count_if(earlier).alias("earlier"), *(F.first(f"own_{k}").alias(f"own_{k}") for k in measures), *(F.count(held(k)).alias(f"n_{k}") for k in measures), *(F.percentile(held(k), F.lit(0.5)).alias(f"base_{k}") for k in measures))
    index = lambda k: F.when((F.col(f"n_{k}") >= 2) & (F.col(f"base_{k}") > 0), 100.0 * F.col(f"own_{k}") / F.col(f"base_{k}")).alias(f"{k}_index")
    return s.select("race_key", "earlier", *map(index, measures))


def _index_sql(own: str, ref: str, where: str) -> str:
    held = f"CASE WHEN b.year < a.year AND {where} THEN {ref} END"
    return f"CASE WHEN count({held}) >= 2 AND quantile_cont({held}, 0.5) > 0 THEN 100.0::DOUBLE * any_value({own}) / quantile_cont({held}, 0.5) END"


_SAME = "comparable AND b.median IS NOT NULL"


@query(f"""WITH e AS MATERIALIZED (SELECT *, CAST(CASE WHEN starters > 0 THEN dnf / starters END AS DOUBLE) AS dnf_share, CAST(CASE WHEN starters > 0 THEN starters END AS DOUBLE) AS field, CAST(CASE WHEN {_WOMEN} THEN starters_f / starters_with_sex END AS DOUBLE) AS women FROM ({_EDITION}))
SELECT a.race_key, count(*) FILTER (WHERE b.year < a.year) AS earlier, {_index_sql("a.median", "b.median", _SAME)} AS median_index, {_index_sql("a.dnf_share", "b.dnf_share", _SAME)} AS dnf_index, {_index_sql("a.field", "b.field", "TRUE")} AS starters_index, {_index_sql("a.women", "b.women", "TRUE")} AS women_index
FROM ({_COMP}) c JOIN e a ON a.race_key = c.a JOIN e b ON b.race_key = c.b GROUP BY 1""", rounded="median_index dnf_index starters_index women_index")
def his_fingerprint(d: Data) -> DataFrame:
    """Editions of a family beside each other: years squared, not results."""
    return fingerprint(editions(d.results), comparable(d.courses))


@query(f"SELECT race_family, arg_min(race_key, (best, race_key)) AS race_key, min(best) AS best FROM ({_WITH_LATEST}) WHERE comparable GROUP BY 1")
def his_record(d: Data) -> DataFrame:
    x = with_latest(d).where("comparable").groupBy("race_family").agg(F.min(F.struct("best", "race_key")).alias("s"))
    return x.select("race_family", "s.race_key", "s.best")


@query(f"SELECT race_key, year, 100.0::DOUBLE * starters_f / starters_with_sex AS women_share FROM ({_EDITION}) WHERE starters >= 20 AND starters_with_sex >= 0.6::DOUBLE * starters")
def his_sex_series(d: Data, coverage: float = 0.6) -> DataFrame:
    """Editions where enough starters have a published sex."""
    e = editions(d.results).where((F.col("starters") >= 20) & (F.col("starters_with_sex") >= coverage * F.col("starters")))
    return e.select("race_key", "year", (100.0 * F.col("starters_f") / F.col("starters_with_sex")).alias("women_share"))


QUERIES, ORACLE = book.queries, book.sql
