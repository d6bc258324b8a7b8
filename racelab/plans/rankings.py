"""Rankings, windows, sorts and limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import ranks
from racelab.operators import stats as st
from racelab.operators.observations import finished
from racelab.plans.base import Book, Data
from racelab.plans.segments import _REF, with_reference
from racelab.plans.stats import FIN
from racelab.sources.shared import stored

book = Book()
query = book.query


@query("""WITH r AS (SELECT race_key, seg_no, class_name, CASE WHEN count(seconds) >= 5 THEN quantile_cont(seconds, 0.5) END AS ref FROM f_segc GROUP BY 1, 2, 3)
SELECT s.race_key, s.seg_no, s.rid, seconds / ref AS relative, row_number() OVER (PARTITION BY s.race_key, s.seg_no ORDER BY seconds, s.rid) AS rank_time, row_number() OVER (PARTITION BY s.race_key, s.seg_no ORDER BY gain DESC NULLS LAST, s.rid) AS rank_gain
FROM f_segc s LEFT JOIN r ON r.race_key = s.race_key AND r.seg_no = s.seg_no AND r.class_name = s.class_name WHERE seconds IS NOT NULL""")
def rnk_segment(d: Data) -> DataFrame:
    """Ranks of each segment by time and by places gained, and the time against the own class's median."""
    keys = ["race_key", "seg_no"]
    known = d.cohort_segments.where("seconds is not null").select(*keys, "rid", "class_name", "seconds", "gain")
    known = known.repartition(*keys) if ranks.fits(d.most) else stored(known)  # one shuffle for all windows
    ref = known.where("class_name is not null").groupBy(*keys, "class_name").agg(at_least_five("seconds").alias("ref"))
    by_time = ranks.numbered(known, keys, [F.col("seconds"), F.col("rid")], "rank_time", d.most)
    both = ranks.numbered(by_time, keys, [F.desc_nulls_last("gain"), F.col("rid")], "rank_gain", d.most)
    return both.join(ref, [*keys, "class_name"], "left").select(*keys, "rid", (F.col("seconds") / F.col("ref")).alias("relative"), "rank_time", "rank_gain")


def at_least_five(value: str) -> Column:
    return F.when(F.count(value) >= 5, st.quantile(value, 0.5))


def _top_sql(source: str, keys: str, order: str, n: int, cols: str) -> str:
    return f"SELECT {keys}, rank, {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rank FROM ({source})) WHERE rank <= {n}"


@query(_top_sql("SELECT * FROM f_segc WHERE sex IS NOT NULL AND seconds IS NOT NULL", "race_key, seg_no, sex", "seconds, rid", 10, "rid, seconds"))
def rnk_segment_top_by_sex(d: Data) -> DataFrame:
    known = d.cohort_segments.where("sex is not null and seconds is not null")
    return st.top(known, 10, ["race_key", "seg_no", "sex"], F.col("seconds"), F.col("rid")).select("race_key", "seg_no", "sex", "rank", "rid", "seconds")


_ADV = f"SELECT race_key, rid, CAST(sum(gain) AS BIGINT) AS gained FROM f_seg WHERE {FIN} GROUP BY 1, 2"


def advances(d: Data) -> DataFrame:
    return d.segments.where(finished()).groupBy("race_key", "rid").agg(F.sum("gain").cast("long").alias("gained"))


@query(_top_sql(f"SELECT * FROM ({_ADV}) WHERE gained > 0", "race_key", "gained DESC, rid", 10, "rid, gained"))
def rnk_advancement(d: Data) -> DataFrame:
    return st.top(advances(d).where("gained > 0"), 10, ["race_key"], F.desc("gained"), F.col("rid")).select("race_key", "rank", "rid", "gained")


@query(_top_sql("SELECT * FROM f_seg WHERE seg_no = 2 AND gain > 0 AND sex IS NOT NULL", "race_key, sex", "gain DESC, rid", 5, "rid, gain"))
def rnk_strongest_finish(d: Data) -> DataFrame:
    last = d.segments.where("seg_no = 2 and gain > 0 and sex is not null")
    return st.top(last, 5, ["race_key", "sex"], F.desc("gain"), F.col("rid")).select("race_key", "sex", "rank", "rid", "gain")


_PACES = f"SELECT race_key, rid, sex, arg_max(pace, seg_no) AS last_pace, avg(pace) AS mean_pace, stddev_pop(pace) AS sd, count(pace) AS n, min(pace) AS best FROM f_seg WHERE {FIN} AND pace IS NOT NULL GROUP BY 1, 2, 3"


def paces(d: Data) -> DataFrame:
    known = d.segments.where(finished() & F.col("pace").isNotNull())
    return known.groupBy("race_key", "rid", "sex").agg(
        F.max_by("pace", "seg_no").alias("last_pace"), F.avg("pace").alias("mean_pace"), F.stddev_pop("pace").alias("sd"), F.count("pace").alias("n"), F.min("pace").alias("best")
    )


@query(_top_sql(f"SELECT *, round(100.0::DOUBLE * (1 - last_pace / mean_pace), 6) AS faster_pct FROM ({_PACES}) WHERE n >= 2 AND sex IS NOT NULL", "race_key, sex", "faster_pct DESC, rid", 5, "rid, faster_pct"))
def rnk_standout_finish(d: Data) -> DataFrame:
    x = paces(d).where("n >= 2 and sex is not null").withColumn("faster_pct", F.round(100.0 * (1 - F.col("last_pace") / F.col("mean_pace")), 6))
    return st.top(x, 5, ["race_key", "sex"], F.desc("faster_pct"), F.col("rid")).select("race_key", "sex", "rank", "rid", "faster_pct")


@query(_top_sql(f"SELECT race_key, rid, coalesce(gained, 0) AS gained FROM ({_ADV})", "race_key", "gained DESC, rid", 5, "rid, gained"))
def rnk_standout_advance(d: Data) -> DataFrame:
    """Finishers by total gain; one without any known gain counts as 0."""
    return st.top(advances(d).withColumn("gained", F.coalesce("gained", F.lit(0))), 5, ["race_key"], F.desc("gained"), F.col("rid")).select("race_key", "rank", "rid", "gained")


@query(_top_sql(f"SELECT *, round(100.0::DOUBLE * sd / mean_pace, 6) AS cv FROM ({_PACES}) WHERE n >= 2", "race_key", "cv, rid", 5, "rid, cv"))
def rnk_standout_even(d: Data) -> DataFrame:
    x = paces(d).where("n >= 2").withColumn("cv", F.round(100.0 * F.col("sd") / F.col("mean_pace"), 6))
    return st.top(x, 5, ["race_key"], F.col("cv"), F.col("rid")).select("race_key", "rank", "rid", "cv")


@query(_top_sql(f"SELECT s.race_key, s.seg_no, s.rid, pace / ref AS relative FROM f_seg s JOIN ({_REF}) r ON r.race_key = s.race_key AND r.seg_no = s.seg_no WHERE {FIN} AND pace IS NOT NULL AND ref IS NOT NULL", "race_key, seg_no", "relative, rid", 5, "rid, relative"))
def rnk_standout_relative(d: Data) -> DataFrame:
    x = with_reference(d).where("pace is not null and ref is not null").withColumn("relative", F.col("pace") / F.col("ref"))
    return st.top(x, 5, ["race_key", "seg_no"], F.col("relative"), F.col("rid")).select("race_key", "seg_no", "rank", "rid", "relative")


@query(_top_sql(_PACES, "race_key", "best, rid", 5, "rid, best"))
def rnk_standout_fastest(d: Data) -> DataFrame:
    return st.top(paces(d), 5, ["race_key"], F.col("best"), F.col("rid")).select("race_key", "rank", "rid", "best")


@query("""SELECT race_key, arg_min(cp_key, remaining) AS control, min(remaining) AS remaining_km FROM (SELECT race_key, cp_key, 60.0::DOUBLE - coalesce(CAST(nullif(regexp_extract(label, '([0-9]+(?:[.,][0-9]+)?) km', 1), '') AS DOUBLE), km) AS remaining
FROM f_checkpoints WHERE cp_key NOT IN ('start', 'finish')) WHERE remaining > 0 AND remaining <= 15 GROUP BY race_key""")
def rnk_sprint_control(d: Data) -> DataFrame:
    """The last timing control within 15 km of the finish; the label's km come before the catalog's."""
    from racelab.functions.text import parse_distance

    remaining = 60.0 - F.coalesce(parse_distance(F.col("label")), F.col("km"))
    near = d.checkpoints.where(~F.col("cp_key").isin("start", "finish")).withColumn("remaining", remaining).where("remaining > 0 and remaining <= 15")
    return near.groupBy("race_key").agg(F.min_by("cp_key", "remaining").alias("control"), F.min("remaining").alias("remaining_km"))


_CONTROL = """SELECT race_key, arg_min(cp_key, remaining) AS control FROM (SELECT race_key, cp_key, 60.0::DOUBLE - coalesce(CAST(nullif(regexp_extract(label, '([0-9]+(?:[.,][0-9]+)?) km', 1), '') AS DOUBLE), km) AS remaining
FROM f_checkpoints WHERE cp_key NOT IN ('start', 'finish')) WHERE remaining > 0 AND remaining <= 15 GROUP BY race_key"""


@query(_top_sql(f"SELECT r.race_key, r.sex, r.rid, finish_seconds - elapsed_seconds AS sprint FROM f_results r JOIN ({_CONTROL}) c ON c.race_key = r.race_key JOIN f_splits s ON s.rid = r.rid AND s.cp_key = c.control WHERE status = 'FINISHED' AND sex IS NOT NULL AND finish_seconds > elapsed_seconds", "race_key, sex", "sprint, rid", 5, "rid, sprint"))
def rnk_sprint(d: Data) -> DataFrame:
    """Fastest from each race's own last control."""
    control = rnk_sprint_control(d).select("race_key", F.col("control").alias("cp_key"))
    passed = d.splits.join(control, ["race_key", "cp_key"]).select("rid", "elapsed_seconds")
    x = d.results.where(finished() & F.col("sex").isNotNull()).join(passed, "rid").withColumn("sprint", F.col("finish_seconds") - F.col("elapsed_seconds")).where("sprint > 0")
    return st.top(x, 5, ["race_key", "sex"], F.col("sprint"), F.col("rid")).select("race_key", "sex", "rank", "rid", "sprint")


@query(_top_sql(f"SELECT * FROM f_results WHERE {FIN} AND sex IS NOT NULL AND club IN ('NATION_1', 'NATION_2')", "race_key, club, sex", "finish_seconds, rid", 5, "rid, finish_seconds"))
def rnk_club_finishers(d: Data) -> DataFrame:
    x = d.results.where(finished() & F.col("sex").isNotNull() & F.col("club").isin("NATION_1", "NATION_2"))
    return st.top(x, 5, ["race_key", "club", "sex"], F.col("finish_seconds"), F.col("rid")).select("race_key", "club", "sex", "rank", "rid", "finish_seconds")


def slower(results: DataFrame, within: int) -> DataFrame:
    """Finishers with n, the finishers of their race, and how many of those are slower; ties aren't."""
    return ranks.slower(results.where(finished()), ["race_key"], "finish_seconds", within)


_SLOWER = f"SELECT *, count(*) OVER (PARTITION BY race_key) AS n, count(*) OVER (PARTITION BY race_key) - count(*) OVER (PARTITION BY race_key ORDER BY finish_seconds) AS slower FROM f_results WHERE {FIN}"


@query(f"SELECT race_key, rid, 100.0::DOUBLE * slower / n AS percentile FROM ({_SLOWER})")
def rnk_field_percentile(d: Data) -> DataFrame:
    return slower(d.results, d.most).select("race_key", "rid", (100.0 * F.col("slower") / F.col("n")).alias("percentile"))


@query(f"SELECT race_key, rid, CASE WHEN n > 1 THEN 100.0::DOUBLE * slower / (n - 1) END AS percentile FROM ({_SLOWER})")
def rnk_profile_percentile(d: Data) -> DataFrame:
    return slower(d.results, d.most).select("race_key", "rid", F.when(F.col("n") > 1, 100.0 * F.col("slower") / (F.col("n") - 1)).alias("percentile"))


@query("SELECT race_key, rid, finish_seconds, overall_place FROM f_places WHERE finish_seconds > 0 AND overall_place > 0 AND race_key IN (SELECT race_key FROM f_places WHERE finish_seconds > 0 GROUP BY 1 HAVING count(*) >= 2)")
def rnk_finish_scatter(d: Data) -> DataFrame:
    x = d.placed.where("finish_seconds > 0 and overall_place > 0").withColumn("n", F.count("*").over(Window.partitionBy("race_key")))
    return x.where("n >= 2").select("race_key", "rid", "finish_seconds", "overall_place")


@query("SELECT race_key, rid, arg_max(cp_key, seq) AS cp_key, max(elapsed_seconds) AS elapsed_seconds FROM f_splits GROUP BY 1, 2")
def win_last_passage(d: Data) -> DataFrame:
    last = d.splits.groupBy("race_key", "rid").agg(F.max(F.struct("seq", "cp_key", "elapsed_seconds")).alias("s"))
    return last.select("race_key", "rid", "s.cp_key", "s.elapsed_seconds")


_RAW = "SELECT l_orderkey AS rid, l_linenumber AS seq, CAST(max(l_extendedprice) AS BIGINT) AS elapsed FROM lineitem GROUP BY 1, 2"


def raw_passages(d: Data) -> DataFrame:
    """Passages whose times often run backwards."""
    return d.table("lineitem").groupBy(F.col("l_orderkey").alias("rid"), F.col("l_linenumber").alias("seq")).agg(F.round(F.max("l_extendedprice")).cast("long").alias("elapsed"))


@query("""SELECT rid, seq, elapsed, prev FROM (SELECT *, last_value(elapsed IGNORE NULLS) OVER (PARTITION BY rid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
FROM (SELECT l_orderkey AS rid, l_linenumber AS seq, CAST(round(max(l_extendedprice)) AS BIGINT) AS elapsed FROM lineitem GROUP BY 1, 2)) WHERE elapsed < prev""")
def win_chronology(d: Data) -> DataFrame:
    """Passages earlier than the last known one before them."""
    w = Window.partitionBy("rid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return raw_passages(d).withColumn("prev", F.last("elapsed", ignorenulls=True).over(w)).where("elapsed < prev")


@query("SELECT r.race_key, r.rid, max(s.elapsed_seconds) AS last_split, any_value(finish_seconds) AS finish_seconds FROM f_results r JOIN f_splits s ON s.rid = r.rid WHERE finish_seconds IS NOT NULL GROUP BY 1, 2 HAVING max(s.elapsed_seconds) > any_value(finish_seconds) + 2 OR max(s.elapsed_seconds) = any_value(finish_seconds)")
def win_final_split_check(d: Data) -> DataFrame:
    """Results whose last passage is past the finish by over two seconds, or is the finish itself."""
    last = d.splits.groupBy("rid").agg(F.max_by("elapsed_seconds", "seq").alias("last_split"))
    x = d.results.where("finish_seconds is not null").join(last, "rid")
    return x.where("last_split > finish_seconds + 2 or last_split = finish_seconds").select("race_key", "rid", "last_split", "finish_seconds")


@query("""SELECT rid, seq, elapsed FROM (SELECT *, max(elapsed) OVER (PARTITION BY rid ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top
FROM (SELECT l_orderkey AS rid, l_linenumber AS seq, CAST(round(max(l_extendedprice)) AS BIGINT) AS elapsed FROM lineitem GROUP BY 1, 2)) WHERE elapsed > coalesce(top, -1)""")
def win_monotone_anchors(d: Data) -> DataFrame:
    """Anchors later than every one kept before: kept times only grow, so later than every one before."""
    w = Window.partitionBy("rid").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return raw_passages(d).withColumn("top", F.max("elapsed").over(w)).where(F.col("elapsed") > F.coalesce("top", F.lit(-1))).drop("top")


@query("""SELECT rid, unnest(kept).seq AS seq, unnest(kept).time AS time, unnest(kept).distance AS distance FROM (SELECT rid, list_reduce(list([{'seq': seq, 'time': time, 'distance': distance}] ORDER BY seq),
  lambda acc, x: CASE WHEN x[1].time > acc[-1].time AND x[1].distance > acc[-1].distance THEN list_concat(acc, x) ELSE acc END) AS kept
FROM (SELECT l_orderkey AS rid, l_linenumber AS seq, max(l_extendedprice) AS time, max(l_quantity) AS distance FROM lineitem GROUP BY 1, 2) GROUP BY 1)""")
def win_monotone_2d(d: Data) -> DataFrame:
    """Anchors later and further than the last kept one: a fold over each result's few anchors."""
    item = d.table("lineitem").groupBy(F.col("l_orderkey").alias("rid"), F.col("l_linenumber").alias("seq")).agg(F.max("l_extendedprice").alias("time"), F.max("l_quantity").alias("distance"))
    ordered = F.array_sort(F.collect_list(F.struct("seq", "time", "distance")))
    kept = F.aggregate(
        "a", F.slice("a", 1, 1),
        lambda acc, x: F.when((x["time"] > F.element_at(acc, -1)["time"]) & (x["distance"] > F.element_at(acc, -1)["distance"]), F.array_append(acc, x)).otherwise(acc),
    )
    return item.groupBy("rid").agg(ordered.alias("a")).select("rid", F.inline(kept))


@query("SELECT * FROM (SELECT race_key, rid, class_name, finish_seconds, row_number() OVER (ORDER BY finish_seconds DESC NULLS LAST, rid) AS n FROM f_results) WHERE n > 40 AND n <= 80")
def srt_results_table(d: Data) -> DataFrame:
    """The second page of 40 of a table sorted by any column, nulls last either way."""
    page = d.results.select("race_key", "rid", "class_name", "finish_seconds").orderBy(F.desc_nulls_last("finish_seconds"), "rid").offset(40).limit(40)
    return page.withColumn("n", 40 + F.row_number().over(Window.orderBy(F.desc_nulls_last("finish_seconds"), "rid")))


def search_order(text: str) -> list[Column]:
    """Prefix matches first, then an exact bib, then by name."""
    return [F.when(F.lower("name").startswith(text), 0).otherwise(1).asc(), F.when(F.col("bib") == text, 0).otherwise(1).asc(), F.col("name").asc(), F.col("rid").asc()]


@query("SELECT rid, name, bib FROM f_results WHERE contains(lower(concat_ws(' ', name, bib, club)), '12') ORDER BY CASE WHEN starts_with(lower(name), '12') THEN 0 ELSE 1 END, CASE WHEN bib = '12' THEN 0 ELSE 1 END, name, rid LIMIT 8")
def srt_autocomplete(d: Data) -> DataFrame:
    found = d.results.where(F.lower(F.concat_ws(" ", "name", "bib", "club")).contains("12"))
    return found.orderBy(*search_order("12")).limit(8).select("rid", "name", "bib")


@query("SELECT rid, name, year, overall_place FROM f_places WHERE contains(lower(name), '00077') ORDER BY CASE WHEN starts_with(lower(name), '00077') THEN 0 ELSE 1 END, year DESC, coalesce(overall_place, 99999), name, rid LIMIT 16")
def srt_cross_year_search(d: Data) -> DataFrame:
    found = d.placed.where(F.lower("name").contains("00077"))
    order = [F.when(F.lower("name").startswith("00077"), 0).otherwise(1), F.desc("year"), F.coalesce("overall_place", F.lit(99999)), "name", "rid"]
    return found.orderBy(*order).limit(16).select("rid", "name", "year", "overall_place")


@query("SELECT race_key, lower(trim(class_name)) AS key, arg_min(class_name, rid) AS shown FROM f_results WHERE trim(class_name) <> '' GROUP BY 1, 2")
def srt_facet_values(d: Data) -> DataFrame:
    return d.results.where(F.trim("class_name") != "").groupBy("race_key", F.lower(F.trim("class_name")).alias("key")).agg(F.min_by("class_name", "rid").alias("shown"))


@query("SELECT r.race_key, r.status, o.i AS position FROM (SELECT DISTINCT race_key, status FROM f_results) r JOIN (VALUES ('FINISHED', 1), ('DNF', 2), ('DNS', 3), ('DSQ', 4), ('UNKNOWN', 5)) o(s, i) ON o.s = r.status")
def srt_facet_status(d: Data) -> DataFrame:
    order = F.array(*map(F.lit, ("FINISHED", "DNF", "DNS", "DSQ", "UNKNOWN")))
    return d.results.select("race_key", "status").distinct().withColumn("position", F.array_position(order, F.col("status")).cast("int"))


@query("SELECT race_family, year, FALSE AS cancelled FROM f_races UNION ALL SELECT DISTINCT race_family, 2099, TRUE FROM f_races")
def srt_edition_years(d: Data) -> DataFrame:
    """Editions of a family with cancelled years, newest first."""
    gone = d.races.select("race_family", F.lit(2099).alias("year"), F.lit(True).alias("cancelled")).distinct()
    return d.races.select("race_family", "year", F.lit(False).alias("cancelled")).unionByName(gone).orderBy("race_family", F.desc("year"))


@query("SELECT club, row_number() OVER (ORDER BY CAST(nullif(regexp_extract(club, '([0-9]+)', 1), '') AS INTEGER), club) AS n FROM (SELECT DISTINCT club FROM f_results)")
def srt_locale_numeric(d: Data) -> DataFrame:
    """Clubs in an order that knows numbers."""
    number = F.expr("try_cast(regexp_extract(club, '([0-9]+)', 1) AS int)")
    return d.results.select("club").distinct().withColumn("n", F.row_number().over(Window.orderBy(number, "club")))


@query("SELECT race_key, rid, row_number() OVER (PARTITION BY race_key ORDER BY coalesce(overall_place, 999999), name, rid) AS n FROM f_places")
def srt_export_order(d: Data) -> DataFrame:
    rows = d.placed.select("race_key", "rid", "name", F.coalesce("overall_place", F.lit(999999)).alias("place"))
    return ranks.numbered(rows, ["race_key"], [F.col("place"), F.col("name"), F.col("rid")], "n", d.most).select("race_key", "rid", "n")


@query("SELECT race_key, count(*) AS records FROM f_results GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10")
def srt_topn_profiles(d: Data) -> DataFrame:
    return d.results.groupBy("race_key").agg(F.count("*").alias("records")).orderBy(F.desc("records"), "race_key").limit(10)


QUERIES, ORACLE = book.queries, book.sql
