"""Aggregations and distributions over every race."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import ranks
from racelab.operators import stats as st
from racelab.operators.observations import at_least, finished, starter
from racelab.plans.base import Book, Data
from racelab.sources.fixtures import NOMINAL_KM

book = Book()
query = book.query
_Q = "CAST(quantile_cont({0}, {1}) AS DOUBLE)"
FIN = "(status = 'FINISHED' AND finish_seconds > 0)"
START = "status IN ('FINISHED', 'DNF', 'DSQ')"
MED = f"CASE WHEN count(*) FILTER (WHERE {FIN}) >= 5 THEN quantile_cont(finish_seconds, 0.5) FILTER (WHERE {FIN}) END"
SUMMARY = f"count(*) AS total, count(*) FILTER (WHERE {START}) AS starters, count(*) FILTER (WHERE {FIN}) AS finished, count(*) FILTER (WHERE status = 'DNF') AS dnf, count(*) FILTER (WHERE status = 'UNKNOWN') AS unknown, {MED} AS median"


@query("SELECT race_key, quantile_cont(finish_seconds, 0.25) AS q25, quantile_cont(finish_seconds, 0.5) AS median, quantile_cont(finish_seconds, 0.95) AS q95 FROM f_results GROUP BY race_key", rounded="q25 median q95")
def agg_quantile(d: Data) -> DataFrame:
    return d.results.groupBy("race_key").agg(*(st.quantile("finish_seconds", q).alias(n) for q, n in ((0.25, "q25"), (0.5, "median"), (0.95, "q95"))))


@query("SELECT race_key, quantile_disc(finish_seconds, 0.5) AS p50, quantile_disc(finish_seconds, 0.95) AS p95 FROM f_results GROUP BY race_key")
def agg_quantile_nearest_rank(d: Data) -> DataFrame:
    return ranks.order_statistics(d.results, ["race_key"], "finish_seconds", {"p50": ranks.nearest_rank_at(0.5), "p95": ranks.nearest_rank_at(0.95)})


@query("""SELECT race_key, l[CAST(round_even((len(l) - 1) * 0.9::DOUBLE, 0) AS BIGINT) + 1] AS p90 FROM (
  SELECT race_key, list_sort(list(finish_seconds) FILTER (WHERE finish_seconds IS NOT NULL)) AS l FROM f_results GROUP BY race_key)""")
def agg_quantile_rounded_index(d: Data) -> DataFrame:
    return ranks.order_statistics(d.results, ["race_key"], "finish_seconds", {"p90": ranks.rounded_at(0.9)})


_DIST = """count(t) AS n, CASE WHEN count(t) >= 5 THEN quantile_cont(t, 0.5) END AS median, CASE WHEN count(t) >= 10 THEN quantile_cont(t, 0.25) END AS q25,
  CASE WHEN count(t) >= 10 THEN quantile_cont(t, 0.75) END AS q75, CASE WHEN count(t) >= 20 THEN quantile_cont(t, 0.1) END AS q10, CASE WHEN count(t) >= 20 THEN quantile_cont(t, 0.9) END AS q90"""


@query(f"SELECT race_key, sex, {_DIST} FROM (SELECT race_key, sex, CASE WHEN {FIN} THEN finish_seconds END AS t FROM f_results) GROUP BY race_key, sex", rounded="median q25 q75 q10 q90")
def agg_distribution(d: Data) -> DataFrame:
    return d.results.withColumn("t", st.finish_time()).groupBy("race_key", "sex").agg(*st.distribution("t"))


@query(f"""WITH x AS (SELECT race_key, count(t) AS n, unnest([10, 25, 50, 75, 90]) AS p, unnest([20, 10, 5, 10, 20]) AS k,
  unnest([quantile_cont(t, 0.1), quantile_cont(t, 0.25), quantile_cont(t, 0.5), quantile_cont(t, 0.75), quantile_cont(t, 0.9)]) AS v
  FROM (SELECT race_key, CASE WHEN {FIN} THEN finish_seconds END AS t FROM f_results) GROUP BY race_key)
SELECT race_key, p AS percentile, CASE WHEN n >= k THEN v END AS seconds FROM x""", rounded="seconds")
def agg_percentile_ladder(d: Data) -> DataFrame:
    wide = d.results.withColumn("t", st.finish_time()).groupBy("race_key").agg(*st.distribution("t"))
    return wide.selectExpr("race_key", "stack(5, 10, q10, 25, q25, 50, median, 75, q75, 90, q90) AS (percentile, seconds)")


_BINS = """WITH c AS (SELECT race_key{s}, CAST(floor({v} / {w}) * {w} AS BIGINT) AS bin, count(*) AS n FROM f_results WHERE {v} IS NOT NULL{where} GROUP BY ALL),
g AS (SELECT race_key, unnest(range(min(bin), max(bin) + 1, {w})) AS bin FROM c GROUP BY race_key){g2}
SELECT g.race_key, {cols}g.bin, coalesce(n, 0) AS n FROM {src} LEFT JOIN c ON c.race_key = g.race_key AND c.bin = g.bin{on}"""


@query(_BINS.format(s="", v="finish_seconds", w=900, where="", g2="", cols="", src="g", on=""))
def agg_bins(d: Data) -> DataFrame:
    return st.bins(d.results, "finish_seconds", 900, ["race_key"])


@query(_BINS.format(s=", class_name", v="finish_seconds", w=1800, where="", g2=", s AS (SELECT DISTINCT race_key, class_name FROM c)", cols="s.class_name, ", src="g JOIN s ON g.race_key = s.race_key", on=" AND c.class_name = s.class_name"))
def agg_bins_by_series(d: Data) -> DataFrame:
    return st.bins(d.results, "finish_seconds", 1800, ["race_key"], ["class_name"])


@query("""WITH c AS (SELECT race_key, CAST(floor(finish_seconds / 1800) * 1800 AS BIGINT) AS bin, count(*) AS total, count(*) FILTER (WHERE sex = 'F') AS f, count(*) FILTER (WHERE sex = 'M') AS m FROM f_results WHERE finish_seconds > 0 GROUP BY ALL),
g AS (SELECT race_key, unnest(range(min(bin), max(bin) + 1, 1800)) AS bin FROM c GROUP BY race_key)
SELECT g.race_key, g.bin, coalesce(total, 0) AS total, coalesce(f, 0) AS f, coalesce(m, 0) AS m FROM g LEFT JOIN c ON g.race_key = c.race_key AND g.bin = c.bin""")
def agg_bins_by_sex(d: Data) -> DataFrame:
    long = st.bins(d.results.where("finish_seconds > 0").withColumn("sex", F.coalesce("sex", F.lit("-"))), "finish_seconds", 1800, ["race_key"], ["sex"])
    of = lambda s: F.coalesce(F.sum(F.when(F.col("sex") == s, F.col("n"))), F.lit(0))
    return long.groupBy("race_key", "bin").agg(F.sum("n").alias("total"), of("F").alias("f"), of("M").alias("m"))


@query(_BINS.format(s="", v="age", w=5, where=" AND race_key IN (SELECT race_key FROM f_results GROUP BY 1 HAVING count(age) >= 5)", g2="", cols="", src="g", on=""))
def agg_age_bins(d: Data) -> DataFrame:
    enough = d.results.groupBy("race_key").agg(F.count("age").alias("c")).where("c >= 5")
    return st.bins(d.results.join(enough, "race_key", "left_semi"), "age", 5, ["race_key"])


@query(f"SELECT race_key, {SUMMARY} FROM f_results GROUP BY race_key")
def agg_summary(d: Data) -> DataFrame:
    return d.results.groupBy("race_key").agg(*st.summary())


@query(f"SELECT race_key, starters, finished, median, median / 60.0::DOUBLE AS median_pace, 100.0::DOUBLE * dnf / nullif(starters, 0) AS dnf_rate FROM (SELECT race_key, {SUMMARY} FROM f_results GROUP BY race_key)")
def agg_kpis(d: Data) -> DataFrame:
    s = d.results.groupBy("race_key").agg(*st.summary())
    return s.select("race_key", "starters", "finished", "median", (F.col("median") / NOMINAL_KM).alias("median_pace"), (100 * F.col("dnf") / F.nullif("starters", F.lit(0))).alias("dnf_rate"))


@query(f"""SELECT race_key, count(*) AS shown, 100.0::DOUBLE * count(*) FILTER (WHERE {FIN}) / nullif(count(*) FILTER (WHERE {START}), 0) AS finish_share, {MED} AS median,
  arg_min(name, (finish_seconds, rid)) FILTER (WHERE {FIN}) AS fastest, count(*) FILTER (WHERE status = 'DNF') AS dnf, count(*) FILTER (WHERE status = 'DNS') AS dns FROM f_results GROUP BY race_key""")
def agg_overview(d: Data) -> DataFrame:
    n = F.count_if(finished())
    return d.results.groupBy("race_key").agg(
        F.count("*").alias("shown"), (100 * n / F.nullif(F.count_if(starter()), F.lit(0))).alias("finish_share"),
        at_least(5, st.quantile(st.finish_time(), 0.5), n).alias("median"),
        F.min_by("name", F.when(finished(), F.struct("finish_seconds", "rid"))).alias("fastest"),
        F.count_if(F.col("status") == "DNF").alias("dnf"), F.count_if(F.col("status") == "DNS").alias("dns"),
    )


@query(f"""SELECT race_key, class_name, count(*) AS total, count(*) FILTER (WHERE {START}) AS starters, count(*) FILTER (WHERE {FIN}) AS finished,
  100.0::DOUBLE * count(*) FILTER (WHERE {FIN}) / nullif(count(*) FILTER (WHERE {START}), 0) AS rate, {MED} AS median, min(finish_seconds) FILTER (WHERE {FIN}) AS fastest
FROM f_results GROUP BY race_key, class_name HAVING count(*) >= 3""")
def agg_class_kpis(d: Data) -> DataFrame:
    s = d.results.groupBy("race_key", "class_name").agg(*st.summary(), F.min(st.finish_time()).alias("fastest"))
    return s.where("total >= 3").select("race_key", "class_name", "total", "starters", "finished", (100 * F.col("finished") / F.nullif("starters", F.lit(0))).alias("rate"), "median", "fastest")


@query(f"SELECT race_key, lower(regexp_replace(trim(club), '\\s+', ' ', 'g')) AS group_key, arg_min(club, rid) AS display, {SUMMARY} FROM f_results GROUP BY race_key, lower(regexp_replace(trim(club), '\\s+', ' ', 'g'))")
def agg_groups(d: Data) -> DataFrame:
    return st.groups(d.results, "club", ["race_key"])


@query(f"""WITH g AS (SELECT race_key, lower(trim(club)) AS group_key, {SUMMARY} FROM f_results GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY race_key ORDER BY total DESC, group_key) AS rn FROM g)
SELECT race_key, CASE WHEN rn <= 8 THEN group_key ELSE 'rest' END AS group_key, CAST(sum(total) AS BIGINT) AS total, CAST(sum(finished) AS BIGINT) AS finished,
  CASE WHEN max(rn) <= 8 THEN max(median) / 60.0::DOUBLE END AS median_pace FROM r GROUP BY race_key, CASE WHEN rn <= 8 THEN group_key ELSE 'rest' END""")
def agg_group_table(d: Data) -> DataFrame:
    """The eight largest groups of each race and the rest in one row."""
    w = Window.partitionBy("race_key").orderBy(F.desc("total"), "group_key")
    g = st.groups(d.results, "club", ["race_key"]).withColumn("rn", F.row_number().over(w))
    name = F.when(F.col("rn") <= 8, F.col("group_key")).otherwise("rest").alias("group_key")
    return g.groupBy("race_key", name).agg(
        F.sum("total").alias("total"), F.sum("finished").alias("finished"), F.when(F.max("rn") <= 8, F.max("median") / NOMINAL_KM).alias("median_pace")
    )


STATUSES = ("FINISHED", "DNF", "DNS", "DSQ", "UNKNOWN")


@query("""SELECT r.race_key, s.status, count(f.rid) AS n FROM f_races r CROSS JOIN (VALUES ('FINISHED'), ('DNF'), ('DNS'), ('DSQ'), ('UNKNOWN')) s(status)
LEFT JOIN f_results f ON f.race_key = r.race_key AND f.status = s.status GROUP BY 1, 2""")
def agg_status_counts(d: Data) -> DataFrame:
    """All five statuses for each race, with zeros."""
    counts = d.results.groupBy("race_key").agg(*(F.count_if(F.col("status") == s).alias(s) for s in STATUSES))
    return counts.unpivot("race_key", list(STATUSES), "status", "n")


@query("SELECT race_key, status, count(*) AS n FROM f_results GROUP BY 1, 2")
def agg_status_by_race(d: Data) -> DataFrame:
    return d.results.groupBy("race_key", "status").agg(F.count("*").alias("n"))


@query("SELECT race_key, cp_key, count(*) AS n FROM f_splits GROUP BY 1, 2")
def agg_split_coverage(d: Data) -> DataFrame:
    return d.splits.groupBy("race_key", "cp_key").agg(F.count("*").alias("n"))


_FIELDS = ("name", "bib", "sex", "age", "club", "class_name")


@query("SELECT race_key, " + ", ".join(f"count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '') AS n_{c}, round(100.0::DOUBLE * count(*) FILTER (WHERE trim(CAST({c} AS VARCHAR)) <> '') / count(*), 2) AS pct_{c}" for c in _FIELDS) + " FROM f_results GROUP BY race_key")
def agg_field_coverage(d: Data) -> DataFrame:
    cols = []
    for c in _FIELDS:
        n = F.count_if(F.trim(F.col(c).cast("string")) != "")
        cols += [n.alias(f"n_{c}"), F.round(100.0 * n / F.count("*"), 2).alias(f"pct_{c}")]
    return d.results.groupBy("race_key").agg(*cols)


@query("""SELECT race_key, cp_key, min(seq) AS first_seq, count(*) AS passages, count(*) FILTER (WHERE elapsed_seconds IS NULL) AS missing_elapsed, count(*) FILTER (WHERE place_overall IS NULL) AS missing_place FROM f_splits GROUP BY 1, 2""")
def agg_checkpoint_coverage(d: Data) -> DataFrame:
    return d.splits.groupBy("race_key", "cp_key").agg(
        F.min("seq").alias("first_seq"), F.count("*").alias("passages"),
        F.count_if(F.col("elapsed_seconds").isNull()).alias("missing_elapsed"), F.count_if(F.col("place_overall").isNull()).alias("missing_place"),
    )


@query("SELECT year, count(s) AS n, round(avg(s), 1) AS mean, min(s) AS least, max(s) AS most FROM (SELECT year, b.elapsed_seconds - a.elapsed_seconds AS s FROM f_splits a JOIN f_splits b ON a.rid = b.rid AND a.cp_key = 'cp1' AND b.cp_key = 'cp2' JOIN f_results r ON r.rid = a.rid) GROUP BY year")
def agg_service_window(d: Data) -> DataFrame:
    """A derived metric by year: the gap between two checkpoints."""
    wide = d.splits.groupBy("rid").agg(*(F.max(F.when(F.col("cp_key") == c, F.col("elapsed_seconds"))).alias(c) for c in ("cp1", "cp2")))
    gap = wide.where("cp1 is not null and cp2 is not null").join(d.results.select("rid", "year"), "rid").withColumn("s", F.col("cp2") - F.col("cp1"))
    return gap.groupBy("year").agg(F.count("s").alias("n"), F.round(F.avg("s"), 1).alias("mean"), F.min("s").alias("least"), F.max("s").alias("most"))


@query("""WITH s AS (SELECT race_key, cp_key, min(seq) AS first_seq, count(*) AS observed FROM f_splits GROUP BY 1, 2),
u AS (SELECT race_key, cp_key, first_seq, observed FROM s UNION ALL SELECT race_key, 'start', 0, 0 FROM f_races UNION ALL SELECT race_key, 'finish', 99, 0 FROM f_races)
SELECT u.race_key, u.cp_key, CAST(row_number() OVER (PARTITION BY u.race_key ORDER BY first_seq, u.cp_key) - 1 AS INTEGER) AS sequence_no, observed, c.km FROM u JOIN f_checkpoints c ON c.race_key = u.race_key AND c.cp_key = u.cp_key""")
def agg_checkpoint_catalog(d: Data) -> DataFrame:
    """Observed checkpoints in order of their first sequence, between a start and a finish of their own."""
    seen = d.splits.groupBy("race_key", "cp_key").agg(F.min("seq").alias("first_seq"), F.count("*").alias("observed"))
    ends = [d.races.select("race_key", F.lit(k).alias("cp_key"), F.lit(n).alias("first_seq"), F.lit(0).cast("long").alias("observed")) for k, n in (("start", 0), ("finish", 99))]
    w = Window.partitionBy("race_key").orderBy("first_seq", "cp_key")
    numbered = seen.unionByName(ends[0]).unionByName(ends[1]).withColumn("sequence_no", (F.row_number().over(w) - 1).cast("int"))
    return numbered.join(d.checkpoints.select("race_key", "cp_key", "km"), ["race_key", "cp_key"]).select("race_key", "cp_key", "sequence_no", "observed", "km")


_READY = """SELECT r.race_key, count(*) AS results, count(DISTINCT s.rid) AS with_splits, CAST(max(n_cp) AS BIGINT) AS checkpoints, count(r.sex) AS with_sex, count(r.age) AS with_age, count(r.finish_seconds) AS with_time
FROM f_results r LEFT JOIN (SELECT DISTINCT rid FROM f_splits) s ON s.rid = r.rid LEFT JOIN (SELECT race_key, count(DISTINCT cp_key) AS n_cp FROM f_splits GROUP BY 1) c ON c.race_key = r.race_key GROUP BY r.race_key"""


def readiness(d: Data) -> DataFrame:
    per = d.splits.groupBy("rid").agg(F.collect_set("cp_key").alias("cps"))
    joined = d.results.join(per, "rid", "left")
    return joined.groupBy("race_key").agg(
        F.count("*").alias("results"), F.count("cps").alias("with_splits"),
        F.size(F.array_distinct(F.flatten(F.collect_set("cps")))).cast("long").alias("checkpoints"),
        F.count("sex").alias("with_sex"), F.count("age").alias("with_age"), F.count("finish_seconds").alias("with_time"),
    )


_FLAGS = "*, with_time >= 5 AS distributions, checkpoints >= 1 AND with_splits >= 5 AS segments, with_sex >= 0.8::DOUBLE * results AS by_sex, with_age >= 0.5::DOUBLE * results AS by_age"


@query(f"SELECT {_FLAGS} FROM ({_READY})")
def agg_readiness(d: Data) -> DataFrame:
    return readiness(d).selectExpr("*", "with_time >= 5 AS distributions", "checkpoints >= 1 AND with_splits >= 5 AS segments", "with_sex >= 0.8D * results AS by_sex", "with_age >= 0.5D * results AS by_age")


@query(f"SELECT count(*) AS races, CAST(sum(results) AS BIGINT) AS results, CAST(sum(with_splits) AS BIGINT) AS with_splits, count(*) FILTER (WHERE segments) AS segment_races FROM (SELECT {_FLAGS} FROM ({_READY}))")
def agg_readiness_totals(d: Data) -> DataFrame:
    return agg_readiness(d).agg(F.count("*").alias("races"), F.sum("results").alias("results"), F.sum("with_splits").alias("with_splits"), F.count_if("segments").alias("segment_races"))


@query(f"SELECT race_key, distributions, segments, segments AND checkpoints >= 2 AS replay, by_sex, by_age, FALSE AS cross_year_identity FROM (SELECT {_FLAGS} FROM ({_READY}))")
def agg_capabilities(d: Data) -> DataFrame:
    """What may be shown of a race; identity across years is never claimed."""
    return agg_readiness(d).selectExpr("race_key", "distributions", "segments", "segments AND checkpoints >= 2 AS replay", "by_sex", "by_age", "FALSE AS cross_year_identity")


@query(f"""SELECT race_key, sex, count(*) FILTER (WHERE {START}) AS starters, count(*) FILTER (WHERE {FIN}) AS finishers, {MED} AS median,
  100.0::DOUBLE * count(*) FILTER (WHERE {FIN}) / nullif(count(*) FILTER (WHERE {START}), 0) AS rate FROM f_results WHERE sex IS NOT NULL GROUP BY 1, 2""")
def agg_gender_cards(d: Data) -> DataFrame:
    s = d.results.where("sex is not null").groupBy("race_key", "sex").agg(*st.summary())
    return s.select("race_key", "sex", "starters", F.col("finished").alias("finishers"), "median", (100 * F.col("finished") / F.nullif("starters", F.lit(0))).alias("rate"))


@query(f"""WITH t AS (SELECT race_key, quantile_cont(finish_seconds, 0.25) AS threshold FROM f_results WHERE {FIN} GROUP BY 1 HAVING count(*) >= 10)
SELECT r.race_key, sex, max(threshold) AS threshold, count(*) FILTER (WHERE finish_seconds <= threshold) AS within, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (WHERE finish_seconds <= threshold) / count(*) AS own_share
FROM f_results r JOIN t ON r.race_key = t.race_key WHERE {FIN} AND sex IS NOT NULL GROUP BY 1, 2""")
def agg_percentile_by_sex(d: Data) -> DataFrame:
    """How many of each sex are within the field's first quartile."""
    done = d.results.where(finished())
    limit = done.groupBy("race_key").agg(st.quantile("finish_seconds", 0.25).alias("threshold"), F.count("*").alias("c")).where("c >= 10").drop("c")
    within = F.count_if(F.col("finish_seconds") <= F.col("threshold"))
    return done.where("sex is not null").join(limit, "race_key").groupBy("race_key", "sex").agg(
        F.max("threshold").alias("threshold"), within.alias("within"), F.count("*").alias("n"), (100 * within / F.count("*")).alias("own_share")
    )


@query(f"""SELECT race_key, sex, unnest([10, 25, 50, 75, 90]) AS share, unnest([quantile_cont(finish_seconds, 0.1), quantile_cont(finish_seconds, 0.25), quantile_cont(finish_seconds, 0.5), quantile_cont(finish_seconds, 0.75), quantile_cont(finish_seconds, 0.9)]) AS seconds
FROM f_results WHERE {FIN} AND sex IS NOT NULL GROUP BY race_key, sex HAVING count(*) >= 5""", rounded="seconds")
def agg_finish_progression(d: Data) -> DataFrame:
    qs = (0.1, 0.25, 0.5, 0.75, 0.9)
    wide = d.results.where(finished() & F.col("sex").isNotNull()).groupBy("race_key", "sex").agg(F.percentile("finish_seconds", F.array(*map(F.lit, qs))).alias("q"), F.count("*").alias("n")).where("n >= 5")
    return wide.select("race_key", "sex", F.inline(F.arrays_zip(F.array(*(F.lit(round(100 * q)) for q in qs)).alias("share"), F.col("q").alias("seconds"))))


_AGE = "CASE WHEN age < 30 THEN '<30' WHEN age < 40 THEN '30-39' WHEN age < 50 THEN '40-49' WHEN age < 60 THEN '50-59' WHEN age >= 60 THEN '60+' END"


@query(f"SELECT race_key, age_group, count(*) AS n, 100.0::DOUBLE * count(*) FILTER (WHERE {FIN}) / nullif(count(*) FILTER (WHERE {START}), 0) AS finish_share, {MED} AS median FROM (SELECT *, {_AGE} AS age_group FROM f_results) WHERE age_group IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 5")
def agg_age_groups(d: Data) -> DataFrame:
    s = d.results.withColumn("age_group", st.age_group(F.col("age"))).where("age_group is not null").groupBy("race_key", "age_group").agg(*st.summary())
    return s.where("total >= 5").select("race_key", "age_group", F.col("total").alias("n"), (100 * F.col("finished") / F.nullif("starters", F.lit(0))).alias("finish_share"), "median")


@query(f"""WITH s AS (SELECT s.race_key, seg_no, {_AGE} AS age_group, s.pace, s.rid FROM f_segc s JOIN f_results r ON r.rid = s.rid),
k AS (SELECT *, row_number() OVER (PARTITION BY race_key, seg_no, age_group ORDER BY pace, rid) AS rn, count(*) OVER (PARTITION BY race_key, seg_no, age_group) AS n FROM s WHERE age_group IS NOT NULL AND pace IS NOT NULL)
SELECT race_key, seg_no, age_group, CASE WHEN max(n) >= 5 THEN quantile_cont(pace, 0.5) END AS median_pace, avg(pace) FILTER (WHERE rn <= ceil(0.1::DOUBLE * n)) AS fastest_tenth FROM k GROUP BY 1, 2, 3""")
def agg_age_heatmap(d: Data) -> DataFrame:
    keys = ["race_key", "seg_no", "age_group"]
    s = d.cohort_segments.withColumn("age_group", st.age_group(F.col("age"))).where("age_group is not null and pace is not null")
    w = Window.partitionBy(*keys)
    ranked = s.select(*keys, "pace", F.row_number().over(w.orderBy("pace", "rid")).alias("rn"), F.count("*").over(w).alias("n"))
    return ranked.groupBy(*keys).agg(at_least(5, st.quantile("pace", 0.5), F.max("n")).alias("median_pace"), F.avg(F.when(F.col("rn") <= F.ceil(0.1 * F.col("n")), F.col("pace"))).alias("fastest_tenth"))


_EDITION = f"""SELECT race_key, race_family, year, count(*) AS records, count(*) FILTER (WHERE {START}) AS starters, count(*) FILTER (WHERE {FIN}) AS finished, count(*) FILTER (WHERE status = 'DNF') AS dnf,
  count(*) FILTER (WHERE status = 'DNS') AS dns, count(*) FILTER (WHERE status = 'DSQ') AS dsq, count(*) FILTER (WHERE status = 'UNKNOWN') AS unknown, {MED} AS median, min(finish_seconds) FILTER (WHERE {FIN}) AS best,
  arg_min(name, (finish_seconds, rid)) FILTER (WHERE {FIN}) AS best_name, count(*) FILTER (WHERE {START} AND sex IS NOT NULL) AS starters_with_sex, count(*) FILTER (WHERE {START} AND sex = 'F') AS starters_f, count(*) FILTER (WHERE {START} AND sex = 'M') AS starters_m
FROM f_results GROUP BY 1, 2, 3"""


def editions(results: DataFrame) -> DataFrame:
    """One row for each race: counts, median and best finish."""
    at = lambda s: F.count_if(F.col("status") == s)
    n = F.count_if(finished())
    return results.groupBy("race_key", "race_family", "year").agg(
        F.count("*").alias("records"), F.count_if(starter()).alias("starters"), n.alias("finished"), at("DNF").alias("dnf"), at("DNS").alias("dns"), at("DSQ").alias("dsq"), at("UNKNOWN").alias("unknown"),
        at_least(5, st.quantile(st.finish_time(), 0.5), n).alias("median"), F.min(st.finish_time()).alias("best"),
        F.min_by("name", F.when(finished(), F.struct("finish_seconds", "rid"))).alias("best_name"), F.count_if(starter() & F.col("sex").isNotNull()).alias("starters_with_sex"),
        F.count_if(starter() & (F.col("sex") == "F")).alias("starters_f"), F.count_if(starter() & (F.col("sex") == "M")).alias("starters_m"),
    )


@query(_EDITION)
def agg_history_edition(d: Data) -> DataFrame:
    return editions(d.results)


@query("SELECT race_key, count(DISTINCT club) AS clubs, count(DISTINCT class_name) AS classes, count(DISTINCT custkey) AS people FROM f_results GROUP BY 1")
def agg_distinct_count(d: Data) -> DataFrame:
    return d.results.groupBy("race_key").agg(F.count_distinct("club").alias("clubs"), F.count_distinct("class_name").alias("classes"), F.count_distinct("custkey").alias("people"))


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def agg_dup_having(d: Data) -> DataFrame:
    return d.table("lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n")).where("n > 1")


QUERIES, ORACLE = book.queries, book.sql
