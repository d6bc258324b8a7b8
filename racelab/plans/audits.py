"""Audits of records as they come in, of configuration, readiness and deliveries: rules that some rows do break."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators import audits as au
from racelab.operators.audits import Rule
from racelab.plans.base import Book, Data
from racelab.plans.evidence import _MINOR, confirmed_minor, with_band
from racelab.sources.shared import shared_folder

book = Book()
query = book.query

# records with faults that persons and ids decide on, in the same expressions for both engines ------------------------

_FAULTY = {
    "rid": "rid", "race_key": "race_key", "status": "CASE WHEN custkey % 97 = 0 THEN 'finished' ELSE status END", "sex": "CASE WHEN custkey % 89 = 0 THEN 'X' ELSE sex END",
    "age": "CASE WHEN custkey % 83 = 0 THEN 120 ELSE age END", "overall_place": "CASE WHEN custkey % 79 = 0 THEN -1 ELSE overall_place END", "name": "CASE WHEN custkey % 73 = 0 THEN NULL ELSE name END",
    "finish_seconds": "CASE WHEN custkey % 59 = 0 AND status = 'FINISHED' THEN NULL WHEN custkey % 53 = 0 AND status = 'DNF' THEN 5000 WHEN custkey % 47 = 0 AND status = 'FINISHED' THEN -finish_seconds ELSE finish_seconds END",
}
_FAULTY_PASSAGES = {
    "rid": "rid", "race_key": "race_key", "seq": "seq", "cp_key": "CASE WHEN rid % 67 = 0 AND seq = 1 THEN 'cpX' ELSE cp_key END",
    "elapsed": "CASE WHEN rid % 71 = 0 AND seq = 2 THEN elapsed_seconds + 90000 WHEN rid % 61 = 0 AND seq = 1 THEN elapsed_seconds + 50000 WHEN rid % 43 = 0 AND seq = 1 THEN -elapsed_seconds ELSE elapsed_seconds END",
}
_pick = lambda columns: ", ".join(f"{c} AS {name}" for name, c in columns.items())
_RECORDS = f"SELECT {_pick(_FAULTY)} FROM f_places"
_PASSAGES = f"""SELECT p.rid, p.race_key, p.cp_key, p.elapsed, r.status, r.finish_seconds, c.seq AS catalog_seq, lag(elapsed) OVER (PARTITION BY p.rid ORDER BY c.seq, p.seq) AS before
FROM (SELECT {_pick(_FAULTY_PASSAGES)} FROM f_splits) p JOIN ({_RECORDS}) r ON r.rid = p.rid LEFT JOIN f_checkpoints c ON c.race_key = p.race_key AND c.cp_key = p.cp_key"""


def faulty_records(d: Data) -> DataFrame:
    return d.placed.selectExpr(*(f"{c} AS {name}" for name, c in _FAULTY.items()))


def faulty_passages(d: Data) -> DataFrame:
    """Passages beside their result's status and finish, their place in the catalog and the passage before."""
    passed = d.splits.selectExpr(*(f"{c} AS {name}" for name, c in _FAULTY_PASSAGES.items()))
    catalog = d.checkpoints.select("race_key", "cp_key", F.col("seq").alias("catalog_seq"))
    x = passed.join(catalog, ["race_key", "cp_key"], "left").join(faulty_records(d).select("rid", "status", "finish_seconds"), "rid")
    w = Window.partitionBy("rid").orderBy(F.asc_nulls_last("catalog_seq"), "seq")
    return x.withColumn("before", F.lag("elapsed").over(w))


def _sql(source: str, rules: list[Rule]) -> str:
    one = "SELECT '{n}' AS name, {h} AS hard, count(*) FILTER (WHERE {b}) AS value, min(rid) FILTER (WHERE {b}) AS first, max(rid) FILTER (WHERE {b}) AS last FROM ({s})"
    return " UNION ALL ".join(one.format(n=r.name, h=r.hard, b=r.breach, s=source) for r in rules)


RESULT_CONTRACT = [
    Rule("required_missing", "name IS NULL OR race_key IS NULL"), Rule("bad_status", "status NOT IN ('FINISHED', 'DNF', 'DNS', 'DSQ', 'UNKNOWN')"), Rule("bad_sex", "sex NOT IN ('F', 'M')"),
    Rule("bad_age", "age < 1 OR age > 99"), Rule("bad_place", "overall_place <= 0"),
]
PASSAGE_CONTRACT = [Rule("past_finish", "status = 'FINISHED' AND elapsed > finish_seconds"), Rule("unknown_checkpoint", "catalog_seq IS NULL"), Rule("not_chronological", "elapsed < before")]
TIME_RULES = [
    Rule("finished_without_time", "status = 'FINISHED' AND finish_seconds IS NULL"), Rule("other_with_time", "status <> 'FINISHED' AND finish_seconds IS NOT NULL"), Rule("not_positive", "finish_seconds <= 0"),
    Rule("dnf_with_time", "status = 'DNF' AND finish_seconds IS NOT NULL", hard=False),
]
SPLIT_RULES = [Rule("negative_split", "elapsed < 0 OR elapsed - before < 0")]
_ordered = _PASSAGES.replace("ORDER BY c.seq, p.seq", "ORDER BY c.seq NULLS LAST, p.seq")


@query(f"{_sql(_RECORDS, RESULT_CONTRACT)} UNION ALL {_sql(_ordered, PASSAGE_CONTRACT)}")
def aud_contract(d: Data) -> DataFrame:
    """Eight rules of what is delivered: how many rows break each, and the smallest and largest of their ids."""
    return au.findings(faulty_records(d), RESULT_CONTRACT, "rid").unionByName(au.findings(faulty_passages(d), PASSAGE_CONTRACT, "rid"))


@query(f"{_sql(_RECORDS, TIME_RULES)} UNION ALL {_sql(_ordered, SPLIT_RULES)}")
def aud_times(d: Data) -> DataFrame:
    return au.findings(faulty_records(d), TIME_RULES, "rid").unionByName(au.findings(faulty_passages(d), SPLIT_RULES, "rid"))


@query(f"""WITH p AS (SELECT race_key, count(*) FILTER (WHERE elapsed > finish_seconds) AS past_finish, count(*) FILTER (WHERE elapsed <= 0) AS not_positive, count(*) FILTER (WHERE elapsed < before) AS backwards FROM ({_ordered}) GROUP BY 1),
m AS (SELECT race_key, count(*) AS checked, count(*) FILTER (WHERE abs(own - finish_seconds) > 2) AS final_mismatch FROM f_results JOIN (SELECT l_orderkey, sum(l_quantity) * 60 + sum(l_tax) * 20 AS own FROM lineitem GROUP BY 1) ON l_orderkey = rid WHERE finish_seconds IS NOT NULL GROUP BY 1)
SELECT race_key, past_finish, not_positive, backwards, checked, final_mismatch FROM p FULL JOIN m USING (race_key)""")
def aud_chronology(d: Data) -> DataFrame:
    """Passages after the finish, at or before zero, or before the passage before; and own clocks that miss the finish by over 2 s."""
    broken = lambda name, c: F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(name)
    passed = faulty_passages(d).groupBy("race_key").agg(broken("past_finish", "elapsed > finish_seconds"), broken("not_positive", "elapsed <= 0"), broken("backwards", "elapsed < before"))
    own = d.table("lineitem").groupBy(F.col("l_orderkey").alias("rid")).agg((F.sum("l_quantity") * 60 + F.sum("l_tax") * 20).alias("own"))
    final = d.results.where("finish_seconds is not null").join(own, "rid").groupBy("race_key").agg(F.count("*").alias("checked"), broken("final_mismatch", "abs(own - finish_seconds) > 2"))
    return passed.join(final, "race_key", "full")


@query("SELECT count(*) AS results FROM f_results")
def aud_curated_gate(d: Data) -> DataFrame:
    """The results as published: written with all hard rules counted in the same scan; one that is broken undoes the write."""
    folder = shared_folder(d.spark)
    au.publish(d.placed, folder, RESULT_CONTRACT + TIME_RULES[:3], "rid")
    return d.spark.read.schema(d.placed.schema).parquet(folder).agg(F.count("*").alias("results"))


# configuration, readiness, deliveries --------------------------------------------------------------------------------

_ASSIGNED = "SELECT s_suppkey AS id, s_nationkey + CASE WHEN s_suppkey % 50 = 0 THEN 100 ELSE 0 END AS version, 1992 + s_suppkey % 7 AS year, s_acctbal < 0 AS cancelled, CASE WHEN s_suppkey % 40 = 1 THEN 99 ELSE n_regionkey END AS grp FROM supplier JOIN nation ON n_nationkey = s_nationkey"


@query(f"""WITH a AS ({_ASSIGNED}), y AS (SELECT version, year, count(*) AS n, bool_or(cancelled) AND bool_or(NOT cancelled) AS twofold FROM a GROUP BY 1, 2)
SELECT 'unknown_version' AS name, count(*) AS value FROM a WHERE version NOT IN (SELECT n_nationkey FROM nation) UNION ALL SELECT 'group_differs', count(*) FROM a JOIN nation ON n_nationkey = version WHERE grp <> n_regionkey
UNION ALL SELECT 'repeated', count(*) FROM y WHERE n > 1 UNION ALL SELECT 'held_and_cancelled', count(*) FROM y WHERE twofold UNION ALL SELECT 'unassigned', count(*) FROM nation WHERE n_nationkey NOT IN (SELECT version FROM a WHERE NOT cancelled)""")
def aud_config_integrity(d: Data) -> DataFrame:
    """A table of editions against the versions it names: unknown ones, other groups, repeated or both held and cancelled editions, versions without any."""
    nation = d.table("nation").select(F.col("n_nationkey").alias("version"), F.col("n_regionkey").alias("region"))
    s, key = d.table("supplier").join(d.table("nation"), F.col("n_nationkey") == F.col("s_nationkey")), F.col("s_suppkey")
    version = F.col("s_nationkey") + F.when(key % 50 == 0, 100).otherwise(0)
    a = s.select(version.alias("version"), (1992 + key % 7).alias("year"), (F.col("s_acctbal") < 0).alias("cancelled"), F.when(key % 40 == 1, 99).otherwise(F.col("n_regionkey")).alias("grp"))
    years = a.groupBy("version", "year").agg(F.count("*").alias("n"), (F.bool_or("cancelled") & F.bool_or(~F.col("cancelled"))).alias("both"))
    n = lambda name, rows: rows.agg(F.lit(name).alias("name"), F.count("*").alias("value"))
    known = n("unknown_version", a.join(nation, "version", "left_anti")).unionByName(n("group_differs", a.join(nation, "version").where("grp <> region")))
    per_year = years.agg(F.count_if(F.col("n") > 1).alias("repeated"), F.count_if("both").alias("held_and_cancelled")).unpivot([], ["repeated", "held_and_cancelled"], "name", "value")
    return known.unionByName(per_year).unionByName(n("unassigned", nation.join(a.where(~F.col("cancelled")), "version", "left_anti")))


@query(f"""WITH e AS (SELECT r.race_key, r.club, r.finish_seconds > 0 AS fin, {_MINOR} AS minor, s.n FROM f_results r LEFT JOIN (SELECT rid, count(*) AS n FROM f_splits GROUP BY 1) s USING (rid)),
g AS (SELECT race_key, club, count(*) FILTER (WHERE fin) >= 10 AS cd, count(n) >= 8 AS cs, coalesce(max(n), 0) >= 2 AS rp, count(*) FILTER (WHERE fin AND NOT minor) >= 10 AS ed, count(n) FILTER (WHERE NOT minor) >= 8 AS es FROM e GROUP BY 1, 2)
SELECT race_key, count(*) AS groups, count(*) FILTER (WHERE cd = ed) AS distributions_agree, count(*) FILTER (WHERE cs = es) AS segments_agree, count(*) FILTER (WHERE NOT rp OR cs) AS replay_implied FROM g GROUP BY 1""")
def aud_readiness_agreement(d: Data) -> DataFrame:
    """What readiness claims of a race's clubs, by all results, against what is left to export without minors; and that replay implies segments."""
    per = d.splits.groupBy("rid").agg(F.count("*").alias("n"))
    e = with_band(d).withColumn("minor", confirmed_minor(F.col("age"), F.col("band"))).join(per, "rid", "left").withColumn("fin", F.coalesce(F.col("finish_seconds") > 0, F.lit(False)))
    stays = ~F.col("minor")
    g = e.groupBy("race_key", "club").agg(
        (F.count_if("fin") >= 10).alias("cd"), (F.count("n") >= 8).alias("cs"), (F.coalesce(F.max("n"), F.lit(0)) >= 2).alias("rp"),
        (F.count_if(F.col("fin") & stays) >= 10).alias("ed"), (F.count(F.when(stays, F.col("n"))) >= 8).alias("es"),
    )
    return g.groupBy("race_key").agg(
        F.count("*").alias("groups"), F.count_if(F.col("cd") == F.col("ed")).alias("distributions_agree"), F.count_if(F.col("cs") == F.col("es")).alias("segments_agree"), F.count_if(~F.col("rp") | F.col("cs")).alias("replay_implied"),
    )


@query("""WITH s AS (SELECT r.race_key, r.race_family, min(r.rid) AS a, min(r.rid) FILTER (WHERE c.rid IS NOT NULL) AS b, min(r.rid) FILTER (WHERE status = 'FINISHED') AS c FROM f_results r LEFT JOIN (SELECT rid FROM f_splits WHERE seq = 2) c ON c.rid = r.rid GROUP BY 1, 2)
SELECT race_family, count(*) AS races, 3 * count(*) AS documents, count(*) FILTER (WHERE a = b AND b = c) AS one_generation, CAST(sum(1 + CAST(b <> a AS INTEGER) + CAST(c <> a AND c <> b AS INTEGER)) AS BIGINT) AS generations FROM s GROUP BY 1""")
def aud_generation(d: Data) -> DataFrame:
    """Whether a race's documents (results, passages, finishers) carry the same payload hash, each stamped from its own rows."""
    second = d.splits.where("seq = 2").select("rid", F.lit(True).alias("passed"))
    rows = d.results.select("race_key", "race_family", "rid", "status").join(second, "rid", "left")
    stamp = lambda c: F.sha2(F.min(F.when(c, F.col("rid"))).cast("string"), 256)
    s = rows.groupBy("race_key", "race_family").agg(F.array(stamp(F.lit(True)), stamp(F.col("passed")), stamp(F.col("status") == "FINISHED")).alias("stamps"))
    n = F.size(F.array_distinct("stamps"))
    return s.groupBy("race_family").agg(F.count("*").alias("races"), (3 * F.count("*")).alias("documents"), F.count_if(n == 1).alias("one_generation"), F.sum(n).alias("generations"))


QUERIES, ORACLE = book.queries, book.sql
