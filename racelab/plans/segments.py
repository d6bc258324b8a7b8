"""Observations, segments, pacing and drop-out over every race."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import stats as st
from racelab.operators.observations import at_least, finished, starter
from racelab.plans.base import Book, Data
from racelab.plans.stats import FIN, START
from racelab.sources.fixtures import NOMINAL_KM

book = Book()
query = book.query


@query("SELECT s.race_key, s.rid, s.cp_key, coalesce(c.seq, -1) AS catalog_seq, s.elapsed_seconds FROM f_splits s LEFT JOIN f_checkpoints c ON c.race_key = s.race_key AND c.cp_key = s.cp_key")
def obs_passages(d: Data) -> DataFrame:
    """Passages with their place in the catalog, -1 where it lacks the checkpoint."""
    catalog = d.checkpoints.select("race_key", "cp_key", F.col("seq").alias("catalog_seq"))
    return d.splits.join(catalog, ["race_key", "cp_key"], "left").select("race_key", "rid", "cp_key", F.coalesce("catalog_seq", F.lit(-1)).alias("catalog_seq"), "elapsed_seconds")


@query("SELECT race_key, rid, cp_key, seq, km, seconds, place FROM f_obs")
def obs_observation(d: Data) -> DataFrame:
    return d.obs.select("race_key", "rid", "cp_key", "seq", "km", "seconds", "place")


@query("SELECT race_key, rid, seg_no, from_key, to_key, seconds, km, pace, gain FROM f_seg")
def seg_segment(d: Data) -> DataFrame:
    return d.segments.select("race_key", "rid", "seg_no", "from_key", "to_key", "seconds", "km", "pace", "gain")


@query("SELECT a.race_key, a.rid, b.seconds - a.seconds AS seconds, (b.seconds - a.seconds) / (b.km - a.km) AS pace FROM f_obs a JOIN f_obs b ON a.rid = b.rid AND a.cp_key = 'cp1' AND b.cp_key = 'finish' WHERE b.seconds > a.seconds")
def seg_arbitrary(d: Data) -> DataFrame:
    """A segment between two chosen boundaries, here the first checkpoint and the finish."""
    at = lambda key, c: F.max(F.when(F.col("cp_key") == key, F.col(c)))
    wide = d.obs.where(F.col("cp_key").isin("cp1", "finish")).groupBy("race_key", "rid").agg(
        (at("finish", "seconds") - at("cp1", "seconds")).alias("seconds"), (at("finish", "km") - at("cp1", "km")).alias("km")
    )
    return wide.where("seconds > 0").select("race_key", "rid", "seconds", (F.col("seconds") / F.col("km")).alias("pace"))


_RET = f"100.0::DOUBLE * (finish_seconds / {NOMINAL_KM}::DOUBLE) / pace"
_SEG_STATS = f"""SELECT race_key, seg_no, from_key, to_key, count(*) AS cohort, count(pace) AS n, CASE WHEN count(pace) >= 5 THEN quantile_cont(pace, 0.5) END AS pace_median,
  CASE WHEN count(pace) >= 10 THEN quantile_cont(pace, 0.25) END AS pace_q25, CASE WHEN count(pace) >= 10 THEN quantile_cont(pace, 0.75) END AS pace_q75,
  CASE WHEN count(pace) >= 20 THEN quantile_cont(pace, 0.1) END AS pace_q10, CASE WHEN count(pace) >= 20 THEN quantile_cont(pace, 0.9) END AS pace_q90,
  CASE WHEN count(seconds) >= 5 THEN quantile_cont(seconds, 0.5) END AS seconds_median, CAST(quantile_cont(gain, 0.5) AS DOUBLE) AS gain_median,
  CASE WHEN count(pace) >= 5 THEN quantile_cont({_RET}, 0.5) END AS retention_median FROM f_segc GROUP BY ALL"""


def retention():
    """Pace over the whole course as a percentage of the segment's."""
    return 100.0 * (F.col("finish_seconds") / NOMINAL_KM) / F.col("pace")


def segment_stats(cohort: DataFrame, *series: str) -> DataFrame:
    """Figures of each segment on the complete cohort, by race and further series."""
    n, keys = F.count("pace"), ["race_key", *series, "seg_no", "from_key", "to_key"]
    steps = (("median", 0.5, 5), ("q25", 0.25, 10), ("q75", 0.75, 10), ("q10", 0.1, 20), ("q90", 0.9, 20))
    pace = F.percentile("pace", F.array(*(F.lit(q) for _, q, _ in steps)))  # all in one pass over the values
    x = cohort.groupBy(*keys).agg(
        F.count("*").alias("cohort"), n.alias("n"), pace.alias("pace"), at_least(5, st.quantile("seconds", 0.5), F.count("seconds")).alias("seconds_median"),
        st.quantile("gain", 0.5).alias("gain_median"), at_least(5, st.quantile(retention(), 0.5), n).alias("retention_median"),
    )
    return x.select(*keys, "cohort", "n", *(at_least(k, F.col("pace")[i]).alias(f"pace_{name}") for i, (name, _, k) in enumerate(steps)), "seconds_median", "gain_median", "retention_median")


@query(_SEG_STATS, rounded="pace_median pace_q25 pace_q75 pace_q10 pace_q90 seconds_median retention_median")
def seg_stats(d: Data) -> DataFrame:
    return segment_stats(d.cohort_segments)


@query(f"SELECT race_key, rid, seg_no, {_RET} AS retention FROM f_segc WHERE pace IS NOT NULL")
def seg_retention(d: Data) -> DataFrame:
    return d.cohort_segments.where("pace is not null").select("race_key", "rid", "seg_no", retention().alias("retention"))


@query(f"SELECT race_key, seg_no, n, seconds_median, pace_median FROM ({_SEG_STATS})")
def seg_history(d: Data) -> DataFrame:
    return segment_stats(d.cohort_segments).select("race_key", "seg_no", "n", "seconds_median", "pace_median")


_LAST = "SELECT r.race_key, r.rid, r.sex, r.class_name, arg_max(s.cp_key, s.seq) AS last_cp FROM f_results r LEFT JOIN f_splits s ON s.rid = r.rid WHERE status = 'DNF' GROUP BY ALL"


def last_passage(d: Data) -> DataFrame:
    """The last passage of each result that did not finish; null without any."""
    last = d.splits.groupBy("rid").agg(F.max_by("cp_key", "seq").alias("last_cp"))
    return d.results.where("status = 'DNF'").join(last, "rid", "left").select("race_key", "rid", "sex", "class_name", "last_cp")


@query(f"SELECT race_key, coalesce(last_cp, 'unlocated') AS last_cp, count(*) AS n FROM ({_LAST}) GROUP BY 1, 2")
def seg_dnf_location(d: Data) -> DataFrame:
    return last_passage(d).groupBy("race_key", F.coalesce("last_cp", F.lit("unlocated")).alias("last_cp")).agg(F.count("*").alias("n"))


@query(f"SELECT race_key, last_cp, count(*) FILTER (WHERE sex = 'F') AS f, count(*) FILTER (WHERE sex = 'M') AS m FROM ({_LAST}) WHERE last_cp IS NOT NULL GROUP BY 1, 2")
def seg_dnf_by_sex(d: Data) -> DataFrame:
    return last_passage(d).where("last_cp is not null").groupBy("race_key", "last_cp").agg(F.count_if(F.col("sex") == "F").alias("f"), F.count_if(F.col("sex") == "M").alias("m"))


@query(f"""WITH c AS (SELECT race_key, class_name, count(*) AS total, row_number() OVER (PARTITION BY race_key ORDER BY count(*) DESC, class_name) AS rn FROM f_results GROUP BY 1, 2 HAVING count(*) >= 3)
SELECT l.race_key, l.class_name, l.last_cp, count(*) AS n FROM ({_LAST}) l JOIN c ON c.race_key = l.race_key AND c.class_name = l.class_name AND rn <= 6 WHERE last_cp IS NOT NULL GROUP BY 1, 2, 3""")
def seg_dnf_funnel(d: Data) -> DataFrame:
    sizes = d.results.groupBy("race_key", "class_name").agg(F.count("*").alias("total")).where("total >= 3")
    six = st.top(sizes, 6, ["race_key"], F.desc("total"), F.col("class_name"))
    return last_passage(d).where("last_cp is not null").join(six, ["race_key", "class_name"], "left_semi").groupBy("race_key", "class_name", "last_cp").agg(F.count("*").alias("n"))


@query(f"""SELECT race_key, cp_key, seq, 100.0::DOUBLE * count(seconds) / count(*) AS observed_share, CASE WHEN count(seconds) >= 5 THEN quantile_cont(seconds, 0.5) END AS median_seconds,
  CASE WHEN count(place) >= 5 THEN CAST(quantile_cont(place, 0.5) AS DOUBLE) END AS median_place, count(seconds) FILTER (WHERE sex = 'F') AS f, count(seconds) FILTER (WHERE sex = 'M') AS m FROM f_obs WHERE {START} GROUP BY 1, 2, 3""")
def seg_field_flow(d: Data) -> DataFrame:
    of = lambda s: F.count(F.when(F.col("sex") == s, F.col("seconds")))
    return d.obs.where(starter()).groupBy("race_key", "cp_key", "seq").agg(
        (100.0 * F.count("seconds") / F.count("*")).alias("observed_share"), at_least(5, st.quantile("seconds", 0.5), F.count("seconds")).alias("median_seconds"),
        at_least(5, st.quantile("place", 0.5), F.count("place")).alias("median_place"), of("F").alias("f"), of("M").alias("m"),
    )


@query("SELECT race_key, sex, cp_key, quantile_cont(seconds, 0.1) AS p10, quantile_cont(seconds, 0.5) AS median, quantile_cont(seconds, 0.9) AS p90, quantile_cont(seconds, 0.9) - quantile_cont(seconds, 0.1) AS spread FROM f_obs WHERE sex IS NOT NULL AND seconds IS NOT NULL AND cp_key <> 'start' GROUP BY 1, 2, 3 HAVING count(*) >= 20", rounded="p10 median p90 spread")
def seg_field_spread(d: Data) -> DataFrame:
    known = d.obs.where("sex is not null and seconds is not null and cp_key <> 'start'")
    q = F.percentile("seconds", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    s = known.groupBy("race_key", "sex", "cp_key").agg(F.count("*").alias("n"), q.alias("q")).where("n >= 20")
    return s.selectExpr("race_key", "sex", "cp_key", "q[0] AS p10", "q[1] AS median", "q[2] AS p90", "q[2] - q[0] AS spread")


@query(f"""WITH g AS (SELECT race_key, club, row_number() OVER (PARTITION BY race_key ORDER BY count(*) DESC, club) AS rn FROM f_results WHERE {FIN} GROUP BY 1, 2 HAVING count(*) >= 5)
SELECT s.race_key, s.club, seg_no, count(*) AS n, coalesce(CASE WHEN count(pace) >= 5 THEN quantile_cont(pace, 0.5) END, CASE WHEN count(seconds) >= 5 THEN quantile_cont(seconds, 0.5) END) AS value
FROM f_segc s JOIN g ON g.race_key = s.race_key AND g.club = s.club AND rn <= 4 GROUP BY 1, 2, 3""")
def seg_group_compare(d: Data) -> DataFrame:
    """The four clubs with most finishers: median pace of each segment, else median time."""
    sizes = d.results.where(finished()).groupBy("race_key", "club").agg(F.count("*").alias("c")).where("c >= 5")
    four = st.top(sizes, 4, ["race_key"], F.desc("c"), F.col("club"))
    s = segment_stats(d.cohort_segments.join(four, ["race_key", "club"], "left_semi"), "club")
    return s.select("race_key", "club", "seg_no", F.col("cohort").alias("n"), F.coalesce("pace_median", "seconds_median").alias("value"))


@query("SELECT race_key, sex, seg_no, count(pace) AS n, CASE WHEN count(pace) >= 5 THEN quantile_cont(pace, 0.5) END AS pace_median FROM f_segc WHERE sex IS NOT NULL GROUP BY 1, 2, 3")
def seg_character(d: Data) -> DataFrame:
    return segment_stats(d.cohort_segments.where("sex is not null"), "sex").select("race_key", "sex", "seg_no", "n", "pace_median")


@query(f"""WITH s AS ({_SEG_STATS}), w AS (SELECT race_key, max(pace_median) FILTER (WHERE seg_no = 0) AS first_pace, max(pace_median) FILTER (WHERE seg_no = 2) AS last_pace FROM s GROUP BY 1)
SELECT race_key, 100.0::DOUBLE * (last_pace / first_pace - 1) AS change_pct FROM w""")
def seg_pace_shift(d: Data) -> DataFrame:
    """How the median pace changes from the first segment to the last."""
    of = lambda n: F.max(F.when(F.col("seg_no") == n, F.col("pace_median")))
    return segment_stats(d.cohort_segments).groupBy("race_key").agg((100.0 * (of(2) / of(0) - 1)).alias("change_pct"))


@query(f"""SELECT race_key, club, seg_no, count(*) AS n, CASE WHEN count(pace) >= 5 THEN quantile_cont(pace, 0.5) END AS pace_median, CASE WHEN count(pace) >= 5 THEN quantile_cont({_RET}, 0.5) END AS retention_median
FROM f_segc WHERE club IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_4') GROUP BY 1, 2, 3""")
def seg_club_arena(d: Data) -> DataFrame:
    """Up to four chosen clubs side by side."""
    chosen = d.cohort_segments.where(F.col("club").isin("NATION_1", "NATION_2", "NATION_3", "NATION_4"))
    s = segment_stats(chosen, "club")
    return s.select("race_key", "club", "seg_no", F.col("cohort").alias("n"), "pace_median", "retention_median")


@query(f"""WITH c AS (SELECT race_key, class_name, quantile_cont(finish_seconds, 0.5) FILTER (WHERE {FIN}) AS median, count(*) FILTER (WHERE {FIN}) AS n, 1.0::DOUBLE * count(*) FILTER (WHERE {FIN}) / nullif(count(*) FILTER (WHERE {START}), 0) AS rate FROM f_results GROUP BY 1, 2)
SELECT race_key, 'lowest median' AS insight, arg_min(class_name, (median, class_name)) AS class_name FROM c WHERE n >= 5 GROUP BY 1
UNION ALL SELECT race_key, 'best finish rate', arg_min(class_name, (-rate, class_name)) FROM c WHERE n >= 5 GROUP BY 1""")
def seg_class_insights(d: Data) -> DataFrame:
    c = d.results.groupBy("race_key", "class_name").agg(*st.summary()).where("finished >= 5").withColumn("rate", F.col("finished") / F.col("starters"))
    picks = c.groupBy("race_key").agg(F.min_by("class_name", F.struct("median", "class_name")).alias("lowest median"), F.min_by("class_name", F.struct(-F.col("rate"), "class_name")).alias("best finish rate"))
    return picks.unpivot("race_key", ["lowest median", "best finish rate"], "insight", "class_name")


@query("""WITH s AS (SELECT race_key, seg_no, sex, quantile_cont(pace, 0.5) AS p, quantile_cont(pace, 0.75) - quantile_cont(pace, 0.25) AS iqr FROM f_segc WHERE sex IS NOT NULL GROUP BY 1, 2, 3 HAVING count(pace) >= 5)
SELECT f.race_key, arg_max(f.seg_no, (abs(f.p - m.p), f.seg_no)) AS widest_seg, max(abs(f.p - m.p)) AS widest_gap, max(abs(f.iqr - m.iqr)) AS widest_iqr_gap FROM s f JOIN s m ON f.race_key = m.race_key AND f.seg_no = m.seg_no AND f.sex = 'F' AND m.sex = 'M' GROUP BY 1""", rounded="widest_gap widest_iqr_gap")
def seg_sex_insights(d: Data) -> DataFrame:
    known = d.cohort_segments.where("sex is not null")
    s = known.groupBy("race_key", "seg_no", "sex").agg(F.count("pace").alias("n"), st.quantile("pace", 0.5).alias("p"), (st.quantile("pace", 0.75) - st.quantile("pace", 0.25)).alias("iqr")).where("n >= 5")
    of = lambda c, x: F.max(F.when(F.col("sex") == x, F.col(c)))
    wide = s.groupBy("race_key", "seg_no").agg(F.abs(of("p", "F") - of("p", "M")).alias("gap"), F.abs(of("iqr", "F") - of("iqr", "M")).alias("iqr_gap")).where("gap is not null")
    return wide.groupBy("race_key").agg(F.max_by("seg_no", F.struct("gap", "seg_no")).alias("widest_seg"), F.max("gap").alias("widest_gap"), F.max("iqr_gap").alias("widest_iqr_gap"))


@query(f"""WITH s AS ({_SEG_STATS}), r AS (SELECT race_key, quantile_cont(finish_seconds / {NOMINAL_KM}::DOUBLE, 0.5) AS whole FROM f_results JOIN f_complete USING (rid) GROUP BY 1)
SELECT s.race_key, seg_no, 100.0::DOUBLE * pace_median / whole AS pace_index, pace_q75 - pace_q25 AS iqr FROM s JOIN r ON r.race_key = s.race_key""")
def seg_course_difficulty(d: Data) -> DataFrame:
    """Each segment's median pace against the whole race's."""
    whole = d.results.join(d.complete, "rid", "left_semi").groupBy("race_key").agg(st.quantile(F.col("finish_seconds") / NOMINAL_KM, 0.5).alias("whole"))
    s = segment_stats(d.cohort_segments).join(whole, "race_key")
    return s.select("race_key", "seg_no", (100.0 * F.col("pace_median") / F.col("whole")).alias("pace_index"), (F.col("pace_q75") - F.col("pace_q25")).alias("iqr"))


_REF = "SELECT race_key, seg_no, CASE WHEN count(pace) >= 5 THEN quantile_cont(pace, 0.5) END AS ref, CASE WHEN count(seconds) >= 5 THEN quantile_cont(seconds, 0.5) END AS ref_s FROM f_segc GROUP BY 1, 2"


def with_reference(d: Data) -> DataFrame:
    """Finishers' segments beside the field's medians. The medians are a few rows for each race."""
    ref = segment_stats(d.cohort_segments).select("race_key", "seg_no", F.col("pace_median").alias("ref"), F.col("seconds_median").alias("ref_s"))
    return d.segments.where(finished()).join(ref, ["race_key", "seg_no"])


@query(f"""SELECT s.race_key, s.rid, arg_max(s.seg_no, (100.0::DOUBLE * ref / pace, s.seg_no)) AS strongest, max(100.0::DOUBLE * ref / pace) AS strongest_index, arg_min(s.seg_no, (100.0::DOUBLE * ref / pace, s.seg_no)) AS weakest, min(100.0::DOUBLE * ref / pace) AS weakest_index, count(*) AS covered
FROM f_seg s JOIN ({_REF}) r ON r.race_key = s.race_key AND r.seg_no = s.seg_no WHERE {FIN} AND pace IS NOT NULL AND ref IS NOT NULL GROUP BY 1, 2""")
def seg_performance_index(d: Data) -> DataFrame:
    x = with_reference(d).where("pace is not null and ref is not null").withColumn("index", 100.0 * F.col("ref") / F.col("pace"))
    key = F.struct("index", "seg_no")
    return x.groupBy("race_key", "rid").agg(
        F.max_by("seg_no", key).alias("strongest"), F.max("index").alias("strongest_index"), F.min_by("seg_no", key).alias("weakest"), F.min("index").alias("weakest_index"), F.count("*").alias("covered")
    )


@query(f"""SELECT s.race_key, s.rid, arg_min(s.seg_no, (seconds - ref_s, s.seg_no)) AS best_seg, min(seconds - ref_s) AS best_delta, arg_max(s.seg_no, (seconds - ref_s, s.seg_no)) AS toughest_seg, max(seconds - ref_s) AS toughest_delta
FROM f_seg s JOIN ({_REF}) r ON r.race_key = s.race_key AND r.seg_no = s.seg_no WHERE {FIN} AND seconds IS NOT NULL AND ref_s IS NOT NULL GROUP BY 1, 2""")
def seg_delta_field(d: Data) -> DataFrame:
    x = with_reference(d).where("seconds is not null and ref_s is not null").withColumn("delta", F.col("seconds") - F.col("ref_s"))
    key = F.struct("delta", "seg_no")
    return x.groupBy("race_key", "rid").agg(F.min_by("seg_no", key).alias("best_seg"), F.min("delta").alias("best_delta"), F.max_by("seg_no", key).alias("toughest_seg"), F.max("delta").alias("toughest_delta"))


@query("SELECT race_key, rid, seg_no, to_key, elapsed, seconds, pace, to_place, gain FROM f_seg WHERE elapsed IS NOT NULL")
def seg_profile_journey(d: Data) -> DataFrame:
    return d.segments.where("elapsed is not null").select("race_key", "rid", "seg_no", "to_key", "elapsed", "seconds", "pace", "to_place", "gain")


@query("""WITH w AS (SELECT race_key, seg_no, km, CASE WHEN count(*) >= 5 THEN quantile_cont(seconds / finish_seconds, 0.5) ELSE any_value(km) / 60.0::DOUBLE END AS w FROM f_segc GROUP BY race_key, seg_no, km),
n AS (SELECT *, 36000.0::DOUBLE * w / sum(w) OVER (PARTITION BY race_key) AS target FROM w) SELECT race_key, seg_no, target, sum(target) OVER (PARTITION BY race_key ORDER BY seg_no) AS cumulative FROM n""", rounded="target cumulative")
def seg_goal_plan(d: Data) -> DataFrame:
    """A target of ten hours dealt out over the segments as the cohort's median shares, else by distance."""
    share = st.quantile(F.col("seconds") / F.col("finish_seconds"), 0.5)
    w = d.cohort_segments.groupBy("race_key", "seg_no", "km").agg(F.when(F.count("*") >= 5, share).otherwise(F.first("km") / NOMINAL_KM).alias("w"))
    race = Window.partitionBy("race_key")
    return w.withColumn("target", 36000.0 * F.col("w") / F.sum("w").over(race)).select("race_key", "seg_no", "target", F.sum("target").over(race.orderBy("seg_no")).alias("cumulative"))


@query(f"""SELECT race_key, target, faster AS faster_count, n - faster AS slower_count, least(n, faster + 1) AS place, CASE WHEN n >= 5 THEN 100.0::DOUBLE * faster / n END AS faster_share_pct
FROM (SELECT race_key, t AS target, count(*) AS n, count(*) FILTER (WHERE finish_seconds < t) AS faster FROM f_results, (VALUES (3000.0::DOUBLE), (6000), (9000)) v(t) WHERE {FIN} GROUP BY 1, 2)""")
def seg_target_sim(d: Data) -> DataFrame:
    """Where target times would stand; all targets in one pass."""
    done = d.results.where(finished()).groupBy("race_key").agg(F.count("*").alias("n"), *(F.count_if(F.col("finish_seconds") < t).alias(str(t)) for t in (3000, 6000, 9000)))
    long = done.unpivot(["race_key", "n"], ["3000", "6000", "9000"], "target", "faster_count")
    return long.select(
        "race_key", F.col("target").cast("double").alias("target"), "faster_count", (F.col("n") - F.col("faster_count")).alias("slower_count"),
        F.least("n", F.col("faster_count") + 1).alias("place"), at_least(5, 100.0 * F.col("faster_count") / F.col("n")).alias("faster_share_pct"),
    )


QUERIES, ORACLE = book.queries, book.sql
