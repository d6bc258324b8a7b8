"""Evidence scores, audits, privacy and catalogs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.functions import text as tx
from racelab.operators import catalog
from racelab.operators import privacy as pv
from racelab.operators import profiles
from racelab.plans.base import Book, Data
from racelab.plans.stats import _FLAGS, _READY, agg_readiness

book = Book()
query = book.query

# evidence --------------------------------------------------------------------------------------------------------

_EVI = """WITH w AS (SELECT doc_id % 50 AS segment, source, max((n_chars % 100) / 100.0::DOUBLE) AS w FROM documents GROUP BY 1, 2), n AS (SELECT segment, 1 - product(1 - w) AS any_of FROM w GROUP BY 1),
p AS (SELECT d.doc_id % 50 AS segment, least(0.9::DOUBLE, count(*) FILTER (WHERE toxic = 1) / 100.0::DOUBLE) AS penalty FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1)
SELECT n.segment, round(any_of * (1 - coalesce(penalty, 0)), 4) AS score FROM n LEFT JOIN p ON n.segment = p.segment"""


def segment_scores(evidence: DataFrame, penalties: DataFrame) -> DataFrame:
    """The largest weight of each independent group, any of them, less the penalty."""
    best = evidence.groupBy("segment", "independence_group").agg(F.max("weight").alias("w"))
    score = best.groupBy("segment").agg((1 - F.product(1 - F.col("w"))).alias("any_of"))
    return score.join(penalties, "segment", "left").select("segment", F.round(F.col("any_of") * (1 - F.coalesce("penalty", F.lit(0.0))), 4).alias("score"))


def evidence(d: Data) -> DataFrame:
    docs = d.table("documents")
    weights = docs.select((F.col("doc_id") % 50).alias("segment"), F.col("source").alias("independence_group"), (F.col("n_chars") % 100 / 100.0).alias("weight"))
    toxic = docs.select("doc_id").join(d.table("labels"), "doc_id").groupBy((F.col("doc_id") % 50).alias("segment")).agg(F.least(F.lit(0.9), F.count_if(F.col("toxic") == 1) / 100.0).alias("penalty"))
    return segment_scores(weights, toxic)


@query(_EVI)
def evi_segment_score(d: Data) -> DataFrame:
    return evidence(d)


@query(f"SELECT segment % 5 AS route, min(score) AS floor, round(avg(score), 6) AS mean FROM ({_EVI}) GROUP BY 1")
def evi_route_floor_mean(d: Data) -> DataFrame:
    return evidence(d).groupBy((F.col("segment") % 5).alias("route")).agg(F.min("score").alias("floor"), F.round(F.avg("score"), 6).alias("mean"))


_CAND = """SELECT p_brand AS grp, p_partkey AS candidate, round(CASE WHEN p_type = 'ECONOMY' THEN 0.25::DOUBLE ELSE 1 END * (3 * least(1.0::DOUBLE, p_size / 50.0::DOUBLE) + CASE WHEN p_size % 4 <> 0 THEN 2 * least(1.0::DOUBLE, p_retailprice / 2000) ELSE 0 END) / (3 + CASE WHEN p_size % 4 <> 0 THEN 2 ELSE 0 END), 6) AS score,
  p_type <> 'ECONOMY' AS eligible, CASE WHEN p_size % 4 = 0 THEN 'price' END AS missing FROM part"""


def candidates(d: Data) -> DataFrame:
    """The weighted mean of the checks that are there; a contradiction quarters it and makes it ineligible."""
    checks = {"size": (3.0, F.col("p_size") / 50.0), "price": (2.0, F.when(F.col("p_size") % 4 != 0, F.col("p_retailprice") / 2000))}
    clamped = {k: (w, F.when(v.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))) for k, (w, v) in checks.items()}
    weight = sum((F.when(v.isNotNull(), w).otherwise(0.0) for w, v in clamped.values()), F.lit(0.0))
    total = sum((F.coalesce(w * v, F.lit(0.0)) for w, v in clamped.values()), F.lit(0.0))
    bad = F.col("p_type") == "ECONOMY"
    missing = F.nullif(F.concat_ws(",", *(F.when(v.isNull(), k) for k, (_, v) in clamped.items())), F.lit(""))
    return d.table("part").select(F.col("p_brand").alias("grp"), F.col("p_partkey").alias("candidate"), F.round(F.when(bad, 0.25).otherwise(1.0) * total / weight, 6).alias("score"), (~bad).alias("eligible"), missing.alias("missing"))


@query(f"SELECT *, row_number() OVER (PARTITION BY grp ORDER BY eligible DESC, score DESC, candidate) AS rank FROM ({_CAND})")
def evi_rank_candidates(d: Data) -> DataFrame:
    return candidates(d).withColumn("rank", F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("eligible"), F.desc("score"), "candidate")))


@query(f"""WITH r AS (SELECT *, row_number() OVER w AS rn, lead(score) OVER w AS second, count(*) OVER (PARTITION BY grp) AS n FROM ({_CAND}) WHERE eligible WINDOW w AS (PARTITION BY grp ORDER BY score DESC, candidate))
SELECT g.grp, CASE WHEN r.grp IS NULL THEN 'unresolved' WHEN n = 1 OR score - second >= 0.15::DOUBLE THEN 'resolved' ELSE 'preferred_but_unresolved' END AS verdict, r.candidate FROM (SELECT DISTINCT p_brand AS grp FROM part) g LEFT JOIN r ON r.grp = g.grp AND rn = 1""")
def evi_resolve_ambiguity(d: Data) -> DataFrame:
    """Contradicted candidates drop out; the best one wins by a margin of 0.15 or alone."""
    w = Window.partitionBy("grp").orderBy(F.desc("score"), "candidate")
    best = candidates(d).where("eligible").select("grp", "candidate", "score", F.row_number().over(w).alias("rn"), F.lead("score").over(w).alias("second")).where("rn = 1")
    verdict = F.when(F.col("score").isNull(), "unresolved").when(F.col("second").isNull() | (F.col("score") - F.col("second") >= 0.15), "resolved").otherwise("preferred_but_unresolved")
    return d.table("part").select(F.col("p_brand").alias("grp")).distinct().join(best, "grp", "left").select("grp", verdict.alias("verdict"), "candidate")


@query("SELECT route_id, problem FROM (SELECT route_id, unnest(list_filter([CASE WHEN count(ele) < count(*) THEN 'elevation gap' END, CASE WHEN count(*) < 55 THEN 'few points' END, CASE WHEN route_id % 7 = 0 AND count(ele) < count(*) THEN 'canonical without evidence' END], lambda x: x IS NOT NULL)) AS problem FROM f_route_points GROUP BY route_id)")
def evi_validate_route(d: Data) -> DataFrame:
    s = d.points.groupBy("route_id").agg(F.count("*").alias("n"), F.count("ele").alias("e"))
    gap = F.col("e") < F.col("n")
    rules = F.array_compact(F.array(F.when(gap, "elevation gap"), F.when(F.col("n") < 55, "few points"), F.when((F.col("route_id") % 7 == 0) & gap, "canonical without evidence")))
    return s.select("route_id", F.explode(rules).alias("problem"))


_WIDE = "SELECT r.year, a.elapsed_seconds AS c1, b.elapsed_seconds AS c2, a.place_overall AS p1, b.place_overall AS p2 FROM f_results r JOIN f_splits a ON a.rid = r.rid AND a.cp_key = 'cp1' JOIN f_splits b ON b.rid = r.rid AND b.cp_key = 'cp2'"


@query(f"SELECT year, count(*) AS n, min(c2 - c1) AS least, quantile_cont(c2 - c1, 0.5) AS median, quantile_cont(c2 - c1, 0.9) AS p90, max(c2 - c1) AS most, 100.0::DOUBLE * count(*) FILTER (WHERE p1 = p2) / count(*) AS same_rank, max(c2 - c1) <= 120 AS double_timing FROM ({_WIDE}) GROUP BY 1")
def evi_double_timing(d: Data) -> DataFrame:
    """Whether two mats time the same moment: the gap between them by year."""
    of = lambda cp, c: F.max(F.when(F.col("cp_key") == cp, F.col(c)))
    wide = d.splits.groupBy("rid").agg(of("cp1", "elapsed_seconds").alias("c1"), of("cp2", "elapsed_seconds").alias("c2"), of("cp1", "place_overall").alias("p1"), of("cp2", "place_overall").alias("p2"))
    x = wide.where("c1 is not null and c2 is not null").join(d.results.select("rid", "year"), "rid").withColumn("gap", F.col("c2") - F.col("c1"))
    return x.groupBy("year").agg(
        F.count("*").alias("n"), F.min("gap").alias("least"), F.percentile("gap", F.lit(0.5)).alias("median"), F.percentile("gap", F.lit(0.9)).alias("p90"), F.max("gap").alias("most"),
        (100.0 * F.count_if(F.col("p1") == F.col("p2")) / F.count("*")).alias("same_rank"), (F.max("gap") <= 120).alias("double_timing"),
    )


_TEAM = """SELECT r.race_family, r.rid, r.finish_seconds, count(s.rid) AS n, max(s.elapsed_seconds) AS last, bool_and(coalesce(s.elapsed_seconds > s.prev, TRUE)) AS in_order, sum(l.secs) FILTER (WHERE l.cp = 3) AS final_leg FROM f_results r
  LEFT JOIN (SELECT *, lag(elapsed_seconds) OVER (PARTITION BY rid ORDER BY seq) AS prev FROM f_splits) s ON s.rid = r.rid LEFT JOIN (SELECT l_orderkey AS k, 3 AS cp, sum(l_quantity) * 60 + sum(l_tax) * 20 AS secs FROM lineitem WHERE l_linenumber > 4 GROUP BY 1) l ON l.k = r.rid AND s.seq = 1 WHERE finish_seconds IS NOT NULL GROUP BY 1, 2, 3"""


@query(f"""SELECT race_family, teams, exchanged, within_2s, in_order, within_2s >= 0.99::DOUBLE * exchanged AS order_proven FROM (SELECT race_family, count(*) AS teams, count(*) FILTER (WHERE n = 2) AS exchanged,
  count(*) FILTER (WHERE n = 2 AND abs(last + coalesce(final_leg, 0) - finish_seconds) <= 2) AS within_2s, count(*) FILTER (WHERE n = 2 AND in_order) AS in_order FROM ({_TEAM}) GROUP BY ROLLUP (race_family))""")
def evi_relay_legs(d: Data) -> DataFrame:
    """How often the last exchange that was timed, and the leg after it, make the team's own finish time; by family and in total.

    Exchanges are published passages, the last leg is what its member's own clock showed, the finish is the team's.
    """
    w = Window.partitionBy("rid").orderBy("seq")
    passed = d.splits.withColumn("prev", F.lag("elapsed_seconds").over(w)).groupBy("rid").agg(
        F.count("*").alias("n"), F.max("elapsed_seconds").alias("last"), F.bool_and(F.coalesce(F.col("elapsed_seconds") > F.col("prev"), F.lit(True))).alias("in_order")
    )
    # a member's own clock drifts by what the line items' tax says
    own = d.table("lineitem").where("l_linenumber > 4").groupBy(F.col("l_orderkey").alias("rid"))
    final = own.agg((F.sum("l_quantity") * 60 + F.sum("l_tax") * 20).alias("final_leg"))
    x = d.results.where("finish_seconds is not null").join(passed, "rid", "left").join(final, "rid", "left")
    two = F.col("n") == 2
    sums = F.abs(F.col("last") + F.coalesce("final_leg", F.lit(0.0)) - F.col("finish_seconds")) <= 2
    totals = x.rollup("race_family").agg(F.count("*").alias("teams"), F.count_if(two).alias("exchanged"), F.count_if(two & sums).alias("within_2s"), F.count_if(two & F.col("in_order")).alias("in_order"))
    return totals.withColumn("order_proven", F.col("within_2s") >= 0.99 * F.col("exchanged"))


@query("""SELECT race_family, kind, value, count(*) AS n FROM (SELECT race_family, unnest(list_concat([{'kind': 'outcome', 'value': 'total'}, {'kind': 'outcome', 'value': CASE custkey % 3 WHEN 0 THEN 'DNF' WHEN 1 THEN 'conflicting_explicit_status' ELSE 'no_explicit_status' END}],
  CASE WHEN custkey % 3 = 1 THEN [{'kind': 'combination', 'value': 'DNF+DNS'}, {'kind': 'surface', 'value': 'list:DNS'}] ELSE [] END, CASE WHEN custkey % 3 <= 1 THEN [{'kind': 'surface', 'value': 'detail:DNF'}] ELSE [] END,
  CASE WHEN custkey % 9 = 0 THEN [{'kind': 'surface', 'value': 'list:DNF'}, {'kind': 'surface', 'value': 'same_status_on_both_surfaces'}] ELSE [] END), recursive := true) FROM f_results WHERE status = 'UNKNOWN') GROUP BY ALL""")
def evi_status_profile(d: Data) -> DataFrame:
    """Unknown results by family and what their page and their list row say: two thirds of the pages speak of a stop."""
    detail = F.when(F.col("custkey") % 3 <= 1, F.concat("club", F.lit(" bröt loppet")))
    listed = F.when(F.col("custkey") % 3 == 1, "Ej start").when(F.col("custkey") % 9 == 0, "dnf").otherwise(F.col("name"))
    return profiles.status_profile(d.results.where("status = 'UNKNOWN'"), ["race_family"], detail, listed)


# audits ----------------------------------------------------------------------------------------------------------


def checks(rows: DataFrame, **conditions: Column) -> DataFrame:
    """(name, value): how many rows break each rule, in one pass."""
    return rows.agg(*(F.count_if(c).alias(n) for n, c in conditions.items())).unpivot([], list(conditions), "name", "value")


def _checks_sql(source: str, **conditions: str) -> str:
    return " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) FILTER (WHERE {c}) AS value FROM {source}" for n, c in conditions.items())


@query(_checks_sql("f_results", blank_name="trim(name) = '' OR name IS NULL", blank_bib="trim(bib) = '' OR bib IS NULL") + " UNION ALL SELECT 'repeated_line', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)")
def aud_keys(d: Data) -> DataFrame:
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    twice = d.table("lineitem").groupBy("l_orderkey", "l_linenumber").count().where("count > 1").agg(F.lit("repeated_line").alias("name"), F.count("*").alias("value"))
    return checks(d.results, blank_name=blank("name"), blank_bib=blank("bib")).unionByName(twice)


_TIMES = dict(finished_without_time="status = 'FINISHED' AND finish_seconds IS NULL", other_with_time="status <> 'FINISHED' AND finish_seconds IS NOT NULL", not_positive="finish_seconds <= 0", very_long="finish_seconds > 20000")


_VERDICT = _checks_sql("f_results", **_TIMES)


@query(f"SELECT CASE WHEN sum(CASE WHEN name <> 'very_long' THEN value ELSE 0 END) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict, count(*) FILTER (WHERE value > 0) AS broken FROM ({_VERDICT})")
def aud_verdict(d: Data) -> DataFrame:
    """PASS unless a rule that stops the build is broken; the others inform."""
    hard = F.col("name") != "very_long"
    return checks(d.results, **{n: F.expr(c) for n, c in _TIMES.items()}).agg(F.when(F.bool_and(~hard | (F.col("value") == 0)), "PASS").otherwise("FAIL").alias("verdict"), F.count_if(F.col("value") > 0).alias("broken"))


@query("SELECT 'splits_without_result' AS name, count(*) AS value FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) UNION ALL SELECT 'results_without_splits', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def aud_orphans(d: Data) -> DataFrame:
    o, li = d.table("orders").select(F.col("o_orderkey").alias("k")), d.table("lineitem").select(F.col("l_orderkey").alias("k"))
    n = lambda a, b, name: a.join(b, "k", "left_anti").agg(F.lit(name).alias("name"), F.count("*").alias("value"))
    return n(li, o, "splits_without_result").unionByName(n(o, li, "results_without_splits"))


@query("SELECT e.race_family, e.year, f.race_key IS NOT NULL AS found FROM (SELECT DISTINCT a.race_family, b.year FROM f_races a, (SELECT CAST(unnest(range(1994, 2003)) AS INTEGER) AS year) b) e LEFT JOIN f_races f ON f.race_family = e.race_family AND f.year = e.year")
def aud_coverage(d: Data) -> DataFrame:
    """Expected editions and whether they are there."""
    expected = d.races.select("race_family").distinct().select("race_family", F.explode(F.sequence(F.lit(1994), F.lit(2002))).alias("year"))
    return expected.join(d.races, ["race_family", "year"], "left").select("race_family", "year", F.col("race_key").isNotNull().alias("found"))


#: Bytes that a race's records may take.
BUNDLE_BYTES = 20_000


@query(f"""SELECT race_key, count(*) AS records, CAST(sum(length(encode('{{"rid":' || rid || ',"name":"' || name || '","status":"' || status || '"' || CASE WHEN finish_seconds IS NULL THEN '' ELSE ',"finish_seconds":' || finish_seconds END || '}}')) + 1) AS BIGINT) AS bytes,
  sum(length(encode('{{"rid":' || rid || ',"name":"' || name || '","status":"' || status || '"' || CASE WHEN finish_seconds IS NULL THEN '' ELSE ',"finish_seconds":' || finish_seconds END || '}}')) + 1) <= {BUNDLE_BYTES} AS within_budget FROM f_results GROUP BY 1""".replace("length(encode(", "octet_length(encode("))
def aud_delivery_budget(d: Data) -> DataFrame:
    """The bytes of each race's records, one JSON line each, against a limit: summed, not gathered."""
    line = F.to_json(F.struct("rid", "name", "status", "finish_seconds"))
    x = d.results.groupBy("race_key").agg(F.count("*").alias("records"), F.sum(F.octet_length(line) + 1).alias("bytes"))
    return x.withColumn("within_budget", F.col("bytes") <= BUNDLE_BYTES)


@query("SELECT year, race_family, count(*) AS discovered, count(finish_seconds) AS normalized, count(*) <> count(finish_seconds) AS differs FROM f_results GROUP BY 1, 2")
def aud_import_counts(d: Data) -> DataFrame:
    n = F.count("finish_seconds")
    return d.results.groupBy("year", "race_family").agg(F.count("*").alias("discovered"), n.alias("normalized"), (F.count("*") != n).alias("differs"))


# privacy ---------------------------------------------------------------------------------------------------------

_BAND = r"(\d{1,2})\s*[-–]\s*(\d{1,2})"


def confirmed_minor(age: Column, *bands: Column, year: Column | None = None, birth_year: Column | None = None) -> Column:
    """An age under 18, or a birth year that says so, or a bounded age band whose upper end is under 18."""
    out = age.between(0, 17)
    if year is not None and birth_year is not None:
        out = F.coalesce(out, F.lit(False)) | F.coalesce(year - birth_year < 18, F.lit(False))
    for band in bands:
        out = F.coalesce(out, F.lit(False)) | F.coalesce(F.regexp_extract(band, _BAND, 2).try_cast("int") < 18, F.lit(False))
    return F.coalesce(out, F.lit(False))


_MINOR = "coalesce(age BETWEEN 0 AND 17, FALSE) OR custkey % 11 = 0"


def with_band(d: Data) -> DataFrame:
    return d.results.withColumn("band", F.when(F.col("custkey") % 11 == 0, "F12-13").otherwise("M17+"))


@query(f"SELECT rid, {_MINOR} AS minor FROM f_results")
def prv_confirmed_minor(d: Data) -> DataFrame:
    return with_band(d).select("rid", confirmed_minor(F.col("age"), F.col("band")).alias("minor"))


@query("SELECT rid, CASE WHEN age IS NOT NULL THEN age BETWEEN 0 AND 17 ELSE custkey % 11 = 0 END AS minor FROM f_results")
def prv_confirmed_minor_strict(d: Data) -> DataFrame:
    """The variant in which a present age overrides the bands."""
    return with_band(d).select("rid", F.when(F.col("age").isNotNull(), F.col("age").between(0, 17)).otherwise(confirmed_minor(F.col("age"), F.col("band"))).alias("minor"))


def removed_cascade(results: DataFrame, children: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """Results without those that go, and children without theirs."""
    return results.where(~gone), children.join(results.where(gone).select("rid"), "rid", "left_anti")


@query(f"SELECT 'results' AS kind, count(*) AS n FROM f_results WHERE NOT ({_MINOR}) UNION ALL SELECT 'splits', count(*) FROM f_splits s WHERE s.rid NOT IN (SELECT rid FROM f_results WHERE {_MINOR})")
def prv_remove_cascade(d: Data) -> DataFrame:
    left, kept = removed_cascade(with_band(d), d.splits, confirmed_minor(F.col("age"), F.col("band")))
    n = lambda df, kind: df.agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
    return n(left, "results").unionByName(n(kept, "splits"))


_REG = "SELECT sha256(lower(trim(c_name))) AS fp, CASE (c_custkey // 100) % 3 WHEN 0 THEN 'remove' WHEN 1 THEN 'temporary' ELSE 'restrict' END AS action FROM customer WHERE c_custkey % 100 = 0"


def registry(d: Data) -> DataFrame:
    k = F.expr("(c_custkey div 100) % 3")
    return d.table("customer").where("c_custkey % 100 = 0").select(F.sha2(F.lower(F.trim("c_name")), 256).alias("fp"), F.when(k == 0, "remove").when(k == 1, "temporary").otherwise("restrict").alias("action"))


_PERSON = "lower('Customer ' || substr(c_name, 10))"
#: Each seventh customer; nations and balances decide on actions, scopes, ends, reviews and, of some entries, faults.
_ENTRIES = f"""SELECT CASE WHEN c_nationkey = 3 THEN upper(sha256({_PERSON})) ELSE sha256({_PERSON}) END AS fingerprint, CASE WHEN c_nationkey = 7 THEN 'hide' WHEN c_nationkey % 3 = 0 THEN 'remove_result' WHEN c_nationkey % 3 = 1 THEN 'temporary_restriction' ELSE 'restrict_identifiers' END AS action,
  CASE WHEN c_nationkey % 4 = 0 THEN 'roster' ELSE '*' END AS scope, c_acctbal < 2000 AS ended, c_nationkey % 5 = 0 AS review, '1-URGENT' AS approved, CASE WHEN c_nationkey = 9 THEN c_name END AS name, c_nationkey FROM customer WHERE c_custkey % 7 = 0"""


def person(name: Column) -> Column:
    return F.concat(F.lit("Customer "), F.substr(name, F.lit(10)))


def raw_registry(d: Data) -> DataFrame:
    """A registry as it comes in, with faults."""
    n = F.col("c_nationkey")
    print_ = F.sha2(F.lower(person(F.col("c_name"))), 256)
    return d.table("customer").where("c_custkey % 7 = 0").select(
        F.when(n == 3, F.upper(print_)).otherwise(print_).alias("fingerprint"),
        F.when(n == 7, "hide").when(n % 3 == 0, "remove_result").when(n % 3 == 1, "temporary_restriction").otherwise("restrict_identifiers").alias("action"),
        F.array(F.when(n % 4 == 0, "roster").otherwise("*")).alias("scopes"),
        F.when(F.col("c_acctbal") < 2000, F.lit("2001-01-01")).otherwise("2999-01-01").cast("timestamp").alias("expires"), (n % 5 == 0).alias("review"),
        F.array(F.struct(F.lit("*").alias("scope"), F.create_map(F.lit("class_name"), F.lit("1-URGENT")).alias("identifiers"))).alias("approved"),
        F.when(n == 9, F.col("c_name")).alias("name"),
    )


def sound_registry(d: Data) -> DataFrame:
    """The entries that break no rule."""
    return raw_registry(d).where(~(pv.RULES["bad_action"]() | pv.RULES["bad_fingerprint"]() | F.col("name").isNotNull())).drop("name")


_SOUND = f"SELECT * FROM ({_ENTRIES}) WHERE c_nationkey NOT IN (3, 7, 9)"
_RECORDS = "SELECT rid, class_name, unnest(CASE rid % 3 WHEN 0 THEN ['Customer ' || substr(name, 10)] WHEN 1 THEN ['Customer ' || substr(name, 10), substr(name, 10) || ' Customer'] ELSE [substr(name, 10) || ' Customer', 'Customer ' || substr(name, 10)] END) AS form FROM f_results"


@query(f"""WITH h AS (SELECT rid, class_name, g.* FROM ({_RECORDS}) r JOIN ({_SOUND}) g ON g.fingerprint = sha256(lower(form)) WHERE scope = '*' AND NOT (action = 'temporary_restriction' AND ended))
SELECT rid, arg_min(action, CASE action WHEN 'remove_result' THEN 1 WHEN 'temporary_restriction' THEN 2 ELSE 3 END) AS action, bool_or(review AND class_name <> approved) AS review FROM h GROUP BY 1""")
def prv_match(d: Data) -> DataFrame:
    """Results that the registry knows, by a full name or by first and last name in either order, and who needs a review."""
    parts = F.substr("name", F.lit(10))
    given = lambda n, v: F.when(F.col("rid") % 3 == n, v)
    records = d.results.select(
        "rid", "class_name", given(0, person(F.col("name"))).alias("name"),
        F.coalesce(given(1, F.lit("Customer")), given(2, parts)).alias("first_name"), F.coalesce(given(1, parts), given(2, F.lit("Customer"))).alias("last_name"),
    )
    names = pv.candidate_names(["name"], ["first_name"], ["last_name"])
    return pv.matches(records, "rid", names, sound_registry(d), "results", F.lit("2026-01-01").cast("timestamp"), ["class_name"], abort=False)


@query(f"SELECT count(*) AS entries, count(*) FILTER (WHERE action = 'hide') AS bad_action, count(*) FILTER (WHERE NOT regexp_full_match(fingerprint, '[0-9a-f]{{64}}')) AS bad_fingerprint, count(*) FILTER (WHERE name IS NOT NULL) AS plaintext FROM ({_ENTRIES})")
def prv_registry_rules(d: Data) -> DataFrame:
    """A registry's breaches by rule; ``checked_registry`` refuses one that has any."""
    return pv.registry_breaches(raw_registry(d))


@query(f"SELECT r.rid, CASE WHEN g.fp IS NOT NULL THEN 'Protected participant' ELSE name END AS name, CASE WHEN g.fp IS NULL THEN bib END AS bib FROM f_results r LEFT JOIN ({_REG}) g ON g.fp = sha256(lower(trim(r.name)))")
def prv_mask_identity(d: Data) -> DataFrame:
    hit = F.col("action").isNotNull()
    x = d.results.withColumn("fp", tx.name_fingerprint(F.col("name"))).join(registry(d), "fp", "left")
    return x.select("rid", F.when(hit, "Protected participant").otherwise(F.col("name")).alias("name"), F.when(~hit, F.col("bib")).alias("bib"))


_BLOCKED = f"SELECT fingerprint FROM ({_SOUND})"
_FULL = "'Customer ' || substr(name, 10)"


@query(f"""WITH r AS (SELECT rid, {_FULL} AS full, sha256(lower({_FULL})) IN ({_BLOCKED}) AS blocked, age FROM f_results), l AS (SELECT rid, blocked, age, unnest([1, 2, 3]) AS i FROM r)
SELECT rid, path, breach FROM (SELECT rid, '$.name' AS path, CASE WHEN rid % 9 = 1 THEN 'masked_row' WHEN blocked AND rid % 2 = 0 THEN 'registered' END AS breach FROM r
  UNION ALL SELECT rid, '$.team.members[1].runner.text', 'registered' FROM r WHERE blocked AND rid % 4 = 1 UNION ALL SELECT rid, '$.notes[0][0]', 'registered' FROM r WHERE blocked AND rid % 5 = 0
  UNION ALL SELECT rid, '$.minor', 'minor' FROM f_results WHERE {_MINOR}) WHERE breach IS NOT NULL""")
def prv_audit_public(d: Data) -> DataFrame:
    """What published documents must not hold, wherever in them it stands: registered names, masked persons, minors."""
    full, n = person(F.col("name")), F.col("rid")
    hidden = lambda hit, other: F.when(hit, F.concat(F.lit("  "), F.upper(full), F.lit(" "))).otherwise(other)
    name = F.when(n % 9 == 1, pv.SHOWN).otherwise(hidden(n % 2 == 0, F.lit("someone")))
    runner = lambda text: F.struct(F.struct(text.alias("text"), n.alias("rid")).alias("runner"))
    team = F.struct(F.array(runner(F.lit("first")), runner(hidden(n % 4 == 1, F.lit("second")))).alias("members"), "club")
    notes = F.array(F.array(hidden(n % 5 == 0, F.lit(""))), F.array(F.lit("x"), F.lit(None)))
    documents = d.results.select("rid", F.to_json(F.struct(name.alias("name"), team.alias("team"), notes.alias("notes"), "finish_seconds")).alias("doc"))
    minors = with_band(d).where(confirmed_minor(F.col("age"), F.col("band"))).select("rid", F.lit("$.minor").alias("path"), F.lit("minor").alias("breach"))
    return pv.audited(documents, "rid", "doc", sound_registry(d)).unionByName(minors)


# catalogs --------------------------------------------------------------------------------------------------------


_CLASS_LABEL = "CASE WHEN p_retailprice < 920 THEN 'Duo ' ELSE '' END || split_part(p_type, ' ', 1) || '  ' || p_size || ' KM'"


@query(f"""SELECT label, family, CASE family WHEN 'duo60' THEN 60 WHEN 'trail22' THEN 22 WHEN 'trail14' THEN 14 WHEN 'trail5' THEN 5 END AS nominal_km, CASE WHEN n_size IN (5, 13, 14, 21, 22) THEN n_size WHEN family = 'duo60' THEN 60 END AS historical_km, n FROM (SELECT label, n_size, n,
  CASE WHEN starts_with(label, 'Duo') THEN 'duo60' WHEN n_size IN (21, 22) THEN 'trail22' WHEN n_size IN (13, 14) THEN 'trail14' WHEN n_size = 5 THEN 'trail5' END AS family FROM (SELECT {_CLASS_LABEL} AS label, CAST(p_size AS INTEGER) AS n_size, count(*) AS n FROM part GROUP BY 1, 2))""")
def cat_classes(d: Data) -> DataFrame:
    """The labels of classes, by kind and size of parts, with their families; those without one are the unmapped list."""
    label = F.concat(F.when(F.col("p_retailprice") < 920, "Duo ").otherwise(""), F.split_part("p_type", F.lit(" "), F.lit(1)), F.lit("  "), F.col("p_size").cast("string"), F.lit(" KM"))
    return catalog.classes(d.table("part").groupBy(label.alias("label")).agg(F.count("*").alias("n"))).select("label", "family", "nominal_km", "historical_km", "n")


#: The family of races that runs as a relay, and the one whose route it runs.
RELAY, ROUTE = "furniture", "building"
_ROUTE_FAMILY = f"CASE WHEN race_family = '{RELAY}' THEN '{ROUTE}' ELSE race_family END"


def editions_of(d: Data) -> DataFrame:
    """(year, family, route_family) of all editions."""
    f = F.col("race_family")
    return d.races.select("year", f.alias("family"), F.when(f == RELAY, ROUTE).otherwise(f).alias("route_family"))


def observed_classes(d: Data) -> DataFrame:
    """Editions whose class the provider lists: all but machinery in even years."""
    x = editions_of(d).where("not (family = 'machinery' and year % 2 = 0)")
    return x.select("year", "family", F.concat(F.col("year").cast("string"), F.lit("-"), F.length("family").cast("string")).alias("distance_id"), F.initcap("family").alias("label"))


def coverage_of(d: Data) -> DataFrame:
    """Coverage of all editions: their families' classes, the passages of a sampled result, tracking pages and archived routes."""
    passed = d.splits.groupBy("rid").agg(F.array_sort(F.collect_set("cp_key")).alias("labels"))
    sampled = d.results.where("custkey % 3 > 0").groupBy("year", F.col("race_family").alias("family")).agg(F.min("rid").alias("rid")).where("year % 6 <> 0")
    inventories = sampled.join(passed, "rid", "left").select("year", "family", F.when(F.col("rid") % 2 == 0, F.col("rid")).alias("sample"), F.col("labels").isNotNull().alias("has_table"), "labels")
    ids = F.array(*(F.concat(F.col("year").cast("string"), F.lit(f"-{n}")) for n in (8, 9)))
    tracking = d.races.select("year").distinct().where("year >= 1995").select("year", (F.col("year") % 2 == 1).alias("view"), ids.alias("distance_ids"))
    trace = F.concat(F.col("family"), F.lit("-"), (F.col("year") % 3).cast("string"))
    sources = editions_of(d).where("family = route_family and year < 1998").select(
        "year", "family", F.explode(F.array(*(F.struct(F.when(F.lit(i == 0), trace).alias("trace_id"), F.when(F.lit(i == 1) & (F.col("year") > 1993), F.lit("a.gpx")).alias("gpx"), F.when(F.lit(i == 2) & (F.col("year") % 2 == 0), F.lit("m.pdf")).alias("map")) for i in range(3)))).alias("s")
    ).select("year", "family", "s.*")
    return catalog.source_coverage(editions_of(d), observed_classes(d), inventories, tracking, sources, relay=RELAY)


_COVERAGE = f"""WITH e AS (SELECT year, race_family AS family, {_ROUTE_FAMILY} AS route_family FROM f_races), c AS (SELECT year, family, year || '-' || length(family) AS distance_id, upper(left(family, 1)) || substr(family, 2) AS label FROM e WHERE NOT (family = 'machinery' AND year % 2 = 0)),
s AS (SELECT year, race_family AS family, min(rid) AS rid FROM f_results WHERE custkey % 3 > 0 AND year % 6 <> 0 GROUP BY 1, 2), p AS (SELECT rid, list_sort(list(DISTINCT cp_key)) AS labels FROM f_splits GROUP BY 1), i AS (SELECT s.*, labels FROM s LEFT JOIN p ON p.rid = s.rid)
SELECT e.*, c.label IS NOT NULL AS class_observed, distance_id, label, CASE WHEN i.rid % 2 = 0 THEN 'participant_detail_observed' WHEN e.family = '{RELAY}' THEN 'team_or_relay_adapter_needed' ELSE 'not_observed' END AS detail_status, CASE WHEN i.rid % 2 = 0 THEN i.rid END AS sample,
  CASE WHEN i.rid IS NULL THEN 'not_inventoried' WHEN labels IS NULL THEN 'no_split_table_in_sample' ELSE 'split_table_observed' END AS split_status, coalesce(labels, []) AS split_labels, CAST(coalesce(len(labels), 0) AS INTEGER) AS split_count,
  e.year >= 1995 AND e.year % 2 = 1 AS tracking_view, e.year >= 1995 AND coalesce(length(label) IN (8, 9), FALSE) AS tracking_match, CASE WHEN e.year < 1998 THEN 1 ELSE 0 END AS route_references, CASE WHEN e.year < 1998 THEN [route_family || '-' || (e.year % 3)] ELSE [] END AS trace_ids,
  CASE WHEN e.year BETWEEN 1994 AND 1997 THEN 1 ELSE 0 END AS gpx_files, CASE WHEN e.year < 1998 AND e.year % 2 = 0 THEN 1 ELSE 0 END AS map_files,
  CASE WHEN e.year BETWEEN 1994 AND 1997 THEN CASE WHEN e.family = '{RELAY}' THEN 'via_route_family' ELSE 'archived' END WHEN e.year < 1998 THEN CASE WHEN e.family = '{RELAY}' THEN 'route_family_reference_only' ELSE 'reference_only' END ELSE 'missing' END AS geometry_status
FROM e LEFT JOIN c USING (year, family) LEFT JOIN i USING (year, family)"""


@query(_COVERAGE)
def cat_source_coverage(d: Data) -> DataFrame:
    return coverage_of(d)


@query(f"""SELECT f.year, f.race_family AS family, {_ROUTE_FAMILY} AS route_family, 'c' || (f.year % 3) AS catalog_version, v.distance_id, v.label, CASE WHEN f.year <= 1999 THEN course_version END AS course_version, CASE WHEN f.year <= 1999 THEN 'verified' ELSE 'not_assigned' END AS version_status,
  v.split_status, v.split_labels, v.detail_status, v.geometry_status, v.tracking_match, CASE WHEN f.year % 2 = 0 THEN sha256({_ROUTE_FAMILY} || f.year) END AS geometry_hash, CASE WHEN f.year % 2 = 0 THEN 60.0::DOUBLE END AS geometry_km, r.distributions, r.segments, r.by_sex, r.by_age
FROM f_courses f JOIN ({_COVERAGE}) v ON v.year = f.year AND v.family = f.race_family LEFT JOIN (SELECT {_FLAGS} FROM ({_READY})) r ON r.race_key = f.race_key""")
def cat_enriched(d: Data) -> DataFrame:
    """Each edition with its class, assigned course version, coverage, capabilities and geometry."""
    f = F.col("race_family")
    races = editions_of(d).withColumn("course_version", F.concat(F.lit("c"), (F.col("year") % 3).cast("string")))
    assigned = d.courses.where("year <= 1999").select("year", f.alias("family"), "course_version", F.lit("verified").alias("status"))
    ready = agg_readiness(d).join(d.races, "race_key").select("year", f.alias("family"), "distributions", "segments", "by_sex", "by_age")
    geometry = editions_of(d).where("family = route_family and year % 2 = 0").select("year", "route_family", F.sha2(F.concat("route_family", "year"), 256).alias("hash"), F.lit(60.0).alias("km"))
    return catalog.enriched(races, observed_classes(d), assigned, coverage_of(d), ready, geometry)


#: Rules by feature, the first that holds counts: condition, status, reason. Expressions of a class's row for both engines.
_PENDING = ("TRUE", "blocked_pending_source")
_NEEDS_CLASS = [("has_class", "source_ready", "'Result class observed.'"), (*_PENDING, "'No result class observed.'")]
_PROFILE = [("detail = 'participant'", "source_ready", "'Participant detail page observed.'"), ("detail = 'team'", "adapter_needed", "'Team result format needs a dedicated adapter.'"), (*_PENDING, "'Participant or team detail page not observed.'")]
_MOVING = [
    ("split_n >= 2 AND geometry", "source_ready", "'Published checkpoints and archived route geometry are both available.'"),
    (*_PENDING, "'Missing: ' || concat_ws(', ', CASE WHEN split_n = 0 THEN 'published splits' END, CASE WHEN split_n < 2 THEN 'at least two observed checkpoints' END, CASE WHEN NOT geometry THEN 'archived route geometry' END) || '.'"),
]
FEATURES = {
    "results_database": _NEEDS_CLASS, "finish_statistics": _NEEDS_CLASS, "cross_year_participation": _NEEDS_CLASS, "runner_profile": _PROFILE, "runner_or_team_profile": _PROFILE,
    "split_analysis": [("split_n > 0", "source_ready", "CAST(split_n AS STRING) || ' published checkpoint labels observed in the sampled result.'"), ("TRUE", "not_available_in_sample", "'No split table observed in the sampled result for this class.'")],
    "runner_replay": _MOVING, "map_duel": _MOVING, "course_difficulty_vs_pacing": _MOVING,
    "course_version_records": [
        ("NOT has_class", "blocked_pending_source", "'No result class observed.'"), ("version IS NULL", "blocked_pending_geometry", "'Course version is not yet assigned.'"), ("TRUE", "source_ready", "'Assigned to verified course version ' || version || '.'"),
    ],
}


def _feature(k: int) -> str:
    """The SQL that picks status (1) or reason (2) by feature."""
    rules = lambda rows: "CASE " + " ".join(f"WHEN {r[0]} THEN {r[k] if k == 2 else repr(r[k])}" for r in rows) + " END"
    return "CASE feature " + " ".join(f"WHEN '{name}' THEN {rules(rows)}" for name, rows in FEATURES.items()) + " END"


@query(f"""WITH c AS (SELECT r.race_key, r.year, r.race_family, r.club, r.class_name, min(r.rid) AS sample, bool_or(r.status IN ('FINISHED', 'DNF')) AS has_class FROM f_results r GROUP BY ALL),
x AS (SELECT c.*, CASE WHEN r.sex IS NULL AND r.custkey % 2 = 0 THEN 'team' WHEN r.status <> 'UNKNOWN' THEN 'participant' END AS detail, coalesce(s.n, 0) AS split_n, year <= 1999 AS geometry, CASE WHEN year <= 1997 THEN race_family || '-a' WHEN year <= 1999 THEN race_family || '-b' END AS version
  FROM c JOIN (SELECT rid, sex, status, custkey FROM f_results) r ON r.rid = sample LEFT JOIN (SELECT rid, count(*) AS n FROM f_splits GROUP BY 1) s ON s.rid = sample)
SELECT race_key, club, class_name, feature, {_feature(1)} AS status, {_feature(2)} AS reason FROM x, (SELECT unnest({list(FEATURES)}) AS feature)""")
def cat_feature_status(d: Data) -> DataFrame:
    """For each class of a race and each feature whether its sources are there, and why not; judged by the class's first result."""
    keys = ["race_key", "year", "race_family", "club", "class_name"]
    classes = d.results.groupBy(*keys).agg(F.min(F.struct("rid", "sex", "status", "custkey")).alias("s"), F.bool_or(F.col("status").isin("FINISHED", "DNF")).alias("has_class")).withColumn("rid", F.col("s.rid"))
    seen = d.splits.groupBy("rid").agg(F.count("*").alias("n"))
    version = F.when(F.col("year") <= 1997, F.concat("race_family", F.lit("-a"))).when(F.col("year") <= 1999, F.concat("race_family", F.lit("-b")))
    detail = F.when(F.col("s.sex").isNull() & (F.col("s.custkey") % 2 == 0), "team").when(F.col("s.status") != "UNKNOWN", "participant")
    x = classes.join(seen, "rid", "left").select(*keys, "has_class", detail.alias("detail"), F.coalesce("n", F.lit(0)).alias("split_n"), (F.col("year") <= 1999).alias("geometry"), version.alias("version"))
    x = x.withColumn("feature", F.explode(F.array(*map(F.lit, FEATURES))))
    return x.select("race_key", "club", "class_name", "feature", F.expr(_feature(1)).alias("status"), F.expr(_feature(2)).alias("reason"))


@query("SELECT r.race_key, r.class_name, count(DISTINCT s.cp_key) AS labels, min(s.rid) AS sample FROM f_results r LEFT JOIN f_splits s ON s.rid = r.rid GROUP BY 1, 2")
def cat_split_inventory(d: Data) -> DataFrame:
    x = d.results.join(d.splits.select("rid", "cp_key"), "rid", "left")
    return x.groupBy("race_key", "class_name").agg(F.count_distinct("cp_key").alias("labels"), F.min(F.when(F.col("cp_key").isNotNull(), F.col("rid"))).alias("sample"))


# curation --------------------------------------------------------------------------------------------------------


@query("SELECT rid, CASE WHEN custkey % 4 = 0 THEN 'raw-' || bib ELSE bib END AS bib, coalesce(club, '-') AS club FROM f_results")
def cur_field_recovery(d: Data) -> DataFrame:
    """Fields that are blank come from the raw row."""
    blank = F.when(F.col("custkey") % 4 != 0, F.col("bib"))
    return d.results.select("rid", F.coalesce(blank, F.concat(F.lit("raw-"), "bib")).alias("bib"), F.coalesce("club", F.lit("-")).alias("club"))


@query("SELECT rid, CASE WHEN status = 'UNKNOWN' AND custkey % 3 = 0 THEN 'DNF' ELSE status END AS status, CASE WHEN status = 'UNKNOWN' AND custkey % 3 = 0 THEN 'explicit text' END AS evidence FROM f_results")
def cur_status_promotion(d: Data) -> DataFrame:
    """UNKNOWN becomes a status only on explicit words."""
    found = tx.status_detect(F.when(F.col("custkey") % 3 == 0, "Did not finish").when(F.col("custkey") % 3 == 1, "DNF DNS"))
    up = (F.col("status") == "UNKNOWN") & found.isNotNull()
    return d.results.select("rid", F.when(up, found).otherwise(F.col("status")).alias("status"), F.when(up, "explicit text").alias("evidence"))


@query("SELECT rid, CASE WHEN class_name = '1-URGENT' THEN 'team:' || bib ELSE 'p:' || bib END AS entity, CASE WHEN class_name = '1-URGENT' THEN 'team' ELSE 'person' END AS entity_type FROM f_results")
def cur_entity_split(d: Data) -> DataFrame:
    team = F.col("class_name") == "1-URGENT"
    part = lambda cond, prefix, kind: d.results.where(cond).select("rid", F.concat(F.lit(prefix), "bib").alias("entity"), F.lit(kind).alias("entity_type"))
    return part(team, "team:", "team").unionByName(part(~team, "p:", "person"))


@query("SELECT l_orderkey AS team, l_linenumber AS member, CASE WHEN n = 2 THEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) END AS leg_no FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) JOIN (SELECT l_orderkey AS k, count(DISTINCT l_linenumber) AS n FROM lineitem GROUP BY 1) ON k = l_orderkey")
def cur_member_legs(d: Data) -> DataFrame:
    """Leg numbers only for teams of exactly two."""
    m = d.table("lineitem").select(F.col("l_orderkey").alias("team"), F.col("l_linenumber").alias("member")).distinct()
    w = Window.partitionBy("team")
    return m.select("team", "member", F.when(F.count("*").over(w) == 2, F.row_number().over(w.orderBy("member"))).alias("leg_no"))


@query("SELECT rid, cp_key, CASE WHEN class_name = '1-URGENT' THEN 'team' ELSE 'person' END AS source_kind, row_number() OVER (PARTITION BY rid ORDER BY s.seq) AS sequence_no FROM f_splits s JOIN f_results r USING (rid)")
def cur_split_union(d: Data) -> DataFrame:
    x = d.splits.drop("race_key").join(d.results.select("rid", "class_name"), "rid")
    team = F.col("class_name") == "1-URGENT"
    both = x.where(team).withColumn("source_kind", F.lit("team")).unionByName(x.where(~team).withColumn("source_kind", F.lit("person")))
    return both.select("rid", "cp_key", "source_kind", F.row_number().over(Window.partitionBy("rid").orderBy("seq")).alias("sequence_no"))


@query("SELECT l_orderkey AS rid, l_linenumber AS metric, arg_max(l_quantity, (l_shipdate, l_quantity)) AS value FROM lineitem GROUP BY 1, 2")
def cur_metric_upsert(d: Data) -> DataFrame:
    """Of repeated metrics the latest stays."""
    return d.table("lineitem").groupBy(F.col("l_orderkey").alias("rid"), F.col("l_linenumber").alias("metric")).agg(F.max_by("l_quantity", F.struct("l_shipdate", "l_quantity")).alias("value"))


@query("SELECT race_key, year, race_family, course_version FROM f_courses")
def cur_race_dim(d: Data) -> DataFrame:
    return d.races.join(d.courses.select("race_key", "course_version"), "race_key", "left").select("race_key", "year", "race_family", "course_version")


@query("SELECT race_key, CASE WHEN year % 2 = 0 THEN course_group ELSE course_version END AS course FROM f_courses")
def cur_course_overlay(d: Data) -> DataFrame:
    """An assignment overrides the stored version, also with null."""
    given = d.courses.where("year % 2 = 0").select("race_key", F.col("course_group").alias("assigned"), F.lit(True).alias("matched"))
    return d.courses.join(given, "race_key", "left").select("race_key", F.when(F.col("matched"), F.col("assigned")).otherwise(F.col("course_version")).alias("course"))


QUERIES, ORACLE = book.queries, book.sql
