"""Who must not be published: a registry of name fingerprints against records and against finished documents.

A registry entry has a fingerprint (sha256 of a normalized name), an action, the scopes it holds for (``*`` for all), the
time it ends, and whether new matches need a review, with the matches that were approved. The registry is joined by its
size: Spark broadcasts it while it is small, and beyond filters records by its own Bloom filter before it shuffles them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelab.functions import text as tx
from racelab.sources.shared import stored

#: Actions, the strongest first, and the name that masked persons are shown under.
ACTIONS = ("remove_result", "temporary_restriction", "restrict_identifiers")
SHOWN = "Protected participant"
REGISTRY = "fingerprint string, action string, scopes array<string>, expires timestamp, review boolean, approved array<struct<scope:string,identifiers:map<string,string>>>"

#: Rules of a registry: name, and the condition that breaks it.
RULES = {
    "bad_action": lambda: ~F.coalesce(F.col("action").isin(*ACTIONS), F.lit(False)),
    "bad_fingerprint": lambda: ~F.coalesce(F.col("fingerprint").rlike("^[0-9a-f]{64}$"), F.lit(False)),
    "plaintext": lambda: reduce(Column.__or__, [F.col(c).isNotNull() for c in ("name", "email", "birthdate")]),
}


def registry_breaches(entries: DataFrame) -> DataFrame:
    """How many entries there are and how many break each rule; columns of plaintext that are missing aren't broken."""
    missing = {c: F.lit(None).cast("string") for c in ("name", "email", "birthdate") if c not in entries.columns}
    return entries.withColumns(missing).agg(F.count("*").alias("entries"), *(F.count_if(rule()).alias(name) for name, rule in RULES.items()))


def checked_registry(entries: DataFrame | None, required: bool = True) -> DataFrame:
    """The entries, if the registry may be used; anything else raises, so nothing is published without it."""
    if entries is None:
        raise RuntimeError("the private registry is missing: publication stopped")
    found = registry_breaches(entries).first().asDict()
    if required and not found["entries"]:
        raise RuntimeError("the private registry is empty: publication stopped")
    broken = {name: n for name, n in found.items() if name in RULES and n}
    if broken:
        raise ValueError(f"the private registry breaks its rules: {broken}")
    return entries


def candidate_names(full: list[str], first: list[str], last: list[str]) -> Column:
    """All names that a record may be known by: full ones, and each first name with each last name in either order."""
    name = lambda *parts: F.when(reduce(Column.__and__, [F.coalesce(F.col(p) != "", F.lit(False)) for p in parts]), F.concat_ws(" ", *parts))
    return F.array_distinct(F.array_compact(F.array(*(name(c) for c in full), *(name(*pair) for f in first for x in last for pair in ((f, x), (x, f))))))


def _approved(identifiers: list[str], scope: str) -> Column:
    """Whether one of an entry's approved matches names this record: every identifier given, known and equal."""
    record = F.create_map(*(x for c in identifiers for x in (F.lit(c), F.col(c).cast("string")))) if identifiers else F.create_map().cast("map<string,string>")
    same = lambda k, v: F.coalesce((v != "") & (F.try_element_at(record, k) == v), F.lit(False))
    fits = lambda a: F.coalesce(a["scope"], F.lit("*")).isin("*", scope) & (F.size(a["identifiers"]) > 0) & (F.size(F.map_filter(a["identifiers"], same)) == F.size(a["identifiers"]))
    return F.coalesce(F.exists("approved", fits), F.lit(False))


def matches(records: DataFrame, key: str, names: Column, registry: DataFrame, scope: str, now: Column, identifiers: list[str], abort: bool = True) -> DataFrame:
    """(key, action, review) of the records that the registry knows by any of their names.

    Entries of other scopes and temporary ones that have ended don't count. The strongest action counts. A match that
    needs a review and isn't among its entry's approved ones stops the query or, without ``abort``, is marked.
    """
    active = registry.where(F.coalesce(F.arrays_overlap("scopes", F.array(F.lit("*"), F.lit(scope))), F.size("scopes") == 0, F.lit(True)))
    active = active.where((F.col("action") != "temporary_restriction") | F.col("expires").isNull() | (F.col("expires") > now))
    wanted = records.select(key, *[c for c in identifiers if c != key], F.explode(names).alias("_name")).withColumn("fingerprint", tx.name_fingerprint(F.col("_name")))
    hits = wanted.where(tx.normalize_name(F.col("_name")) != "").join(active, "fingerprint").withColumn("open", F.coalesce("review", F.lit(False)) & ~_approved(identifiers, scope))
    if abort:
        stop = F.raise_error(F.lit("a possible match of a protected identity needs a private review: publication stopped")).cast("boolean")
        hits = hits.withColumn("open", F.when(F.col("open"), stop).otherwise(False))
    strength = F.array_position(F.array(*map(F.lit, ACTIONS)), F.col("action"))
    return hits.groupBy(key).agg(F.min_by("action", strength).alias("action"), F.bool_or("open").alias("review"))


def string_leaves(documents: DataFrame, key: str, document: str) -> DataFrame:
    """(key, path, text): every text inside JSON documents of any shape and depth; a document that isn't JSON is a leaf itself.

    Documents are read as variants and opened level by level, so depth is bounded by the documents alone.
    """
    variant = F.try_parse_json(document)
    level = documents.where(F.col(document).isNotNull()).select(key, F.lit("$").alias("path"), F.col(document).alias("raw"), variant.alias("v"))
    found = [stored(level.where("v is null").select(key, "path", F.col("raw").alias("text")))]
    level = level.where("v is not null").drop("raw")
    tvf = documents.sparkSession.tvf
    while True:
        kind = F.schema_of_variant("v")
        found.append(stored(level.where(kind == "STRING").select(key, "path", F.variant_get("v", "$", "string").alias("text"))))
        inner = level.where(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        opened = inner.lateralJoin(tvf.variant_explode(F.col("v").outer()).toDF("_pos", "_key", "_value"))
        step = F.concat("path", F.coalesce(F.concat(F.lit("."), "_key"), F.concat(F.lit("["), F.col("_pos").cast("string"), F.lit("]"))))
        level = stored(opened.select(key, step.alias("path"), F.col("_value").alias("v")).where("v is not null"))
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)


def audited(documents: DataFrame, key: str, document: str, registry: DataFrame, shown: str = SHOWN) -> DataFrame:
    """(key, path, breach) of what published documents must not hold: a registered name anywhere, or a masked person's row."""
    leaves = string_leaves(documents, key, document).withColumn("name", tx.normalize_name(F.col("text")))
    masked = F.col("name") == tx.normalize_name(F.lit(shown))
    rows = leaves.where(masked & F.col("path").rlike(r"\.(name|name_as_published)$")).select(key, "path", F.lit("masked_row").alias("breach"))
    named = leaves.where(~masked & (F.col("name") != "")).withColumn("fingerprint", tx.name_fingerprint(F.col("text")))
    return named.join(registry.select("fingerprint"), "fingerprint", "left_semi").select(key, "path", F.lit("registered").alias("breach")).unionByName(rows)
