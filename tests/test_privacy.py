"""The registry's rules, matches by all name forms, and registered names planted at every depth of documents."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from racelab.operators import privacy as pv

print_of = lambda name: hashlib.sha256(name.lower().encode()).hexdigest()


def registry(spark, *entries):
    rows = [(print_of(n), a, s, e, r, [(sc, ids) for sc, ids in ok]) for n, a, s, e, r, ok in entries]
    made = spark.createDataFrame(rows, "fingerprint string, action string, scopes array<string>, expires string, review boolean, approved array<struct<scope:string,identifiers:map<string,string>>>")
    return made.withColumn("expires", F.col("expires").cast("timestamp"))


REMOVE, TEMPORARY, RESTRICT = pv.ACTIONS
NOW = "2026-06-01"


def found(spark, records, entries, scope="results", abort=True):
    rows = spark.createDataFrame(records, "rid int, bib string, name string, first string, last string")
    names = pv.candidate_names(["name"], ["first"], ["last"])
    return {r["rid"]: (r["action"], r["review"]) for r in pv.matches(rows, "rid", names, registry(spark, *entries), scope, F.lit(NOW).cast("timestamp"), ["bib"], abort).collect()}


RECORDS = [
    (1, "a", "Ada  LOVE", None, None), (2, "b", None, "Ada", "Love"), (3, "c", None, "Love", "Ada"), (4, "d", "Ada", None, "Love"), (5, "e", "Someone Else", "Ada", ""), (6, None, "", "Ada", "Love"), (7, "g", None, None, None),
]


def test_name_forms(spark):
    got = found(spark, RECORDS, [("ada love", REMOVE, ["*"], None, False, [])])
    assert got == {i: (REMOVE, False) for i in (1, 2, 3, 6)}


def test_scope_end_and_strength(spark):
    ada = lambda *more: ("ada love", *more)
    assert found(spark, RECORDS[:1], [ada(REMOVE, ["roster"], None, False, [])]) == {}
    assert found(spark, RECORDS[:1], [ada(REMOVE, ["roster", "results"], None, False, [])]) == {1: (REMOVE, False)}
    assert found(spark, RECORDS[:1], [ada(TEMPORARY, [], "2026-05-31", False, [])]) == {}
    assert found(spark, RECORDS[:1], [ada(TEMPORARY, None, "2026-06-02", False, []), ada(RESTRICT, ["*"], None, False, [])]) == {1: (TEMPORARY, False)}
    assert found(spark, RECORDS[:1], [ada(RESTRICT, ["*"], "2001-01-01", None, []), ada(REMOVE, ["*"], "2001-01-01", False, [])]) == {1: (REMOVE, False)}


def test_unapproved_match_stops(spark):
    entry = ("ada love", REMOVE, ["*"], None, True, [("results", {"bib": "a"}), ("roster", {"bib": "b"}), ("*", {})])
    assert found(spark, RECORDS[:1], [entry]) == {1: (REMOVE, False)}
    with pytest.raises(Exception, match="private review"):
        found(spark, RECORDS[:2], [entry])
    assert found(spark, RECORDS, [entry], abort=False) == {1: (REMOVE, False), 2: (REMOVE, True), 3: (REMOVE, True), 6: (REMOVE, True)}


def test_registry_fails_closed(spark):
    good = registry(spark, ("x y", REMOVE, ["*"], None, False, []))
    assert pv.checked_registry(good) is good
    for bad in (good.withColumn("action", F.lit("hide")), good.withColumn("action", F.lit(None).cast("string")), good.withColumn("fingerprint", F.upper("fingerprint")), good.withColumn("email", F.lit("a@b.c"))):
        with pytest.raises(ValueError, match="breaks its rules"):
            pv.checked_registry(bad)
    for none in (None, good.limit(0)):
        with pytest.raises(RuntimeError, match="publication stopped"):
            pv.checked_registry(none)


def test_leaves_at_every_depth(spark):
    deep = {"k": "leaf"}
    for i in range(12):
        deep = {"in": deep} if i % 2 else [i, None, True, deep, 1.5]
    docs = {1: json.dumps(deep), 2: '"bare"', 3: "not { json", 4: None, 5: "[]", 6: json.dumps({"a b": ["x", ["y", {}]], "n": 3}), 7: "5"}
    rows = spark.createDataFrame(list(docs.items()), "id int, doc string")
    got = {(r["id"], r["path"], r["text"]) for r in pv.string_leaves(rows, "id", "doc").collect()}
    path = "$" + "".join(".in" if i % 2 else "[3]" for i in reversed(range(12))) + ".k"
    assert got == {(1, path, "leaf"), (2, "$", "bare"), (3, "$", "not { json"), (6, "$.a b[0]", "x"), (6, "$.a b[1][0]", "y")}
    assert pv.string_leaves(rows.limit(0), "id", "doc").collect() == []


def test_audit_finds_planted_names_alone(spark):
    blocked = registry(spark, ("ada love", REMOVE, ["*"], None, False, []), (pv.SHOWN, REMOVE, ["*"], None, False, []))
    docs = [
        (1, {"rows": [{"team": {"members": [{"x": " ADA   love"}]}}, {"name": "Ada Lovelace"}]}), (2, {"name": pv.SHOWN.upper(), "note": pv.SHOWN}), (3, ["ada", "love", {"ada love": "key only"}]),
        (4, {"name_as_published": pv.SHOWN, "deep": {"name": "ada love"}}), (5, {}),
    ]
    rows = spark.createDataFrame([(i, json.dumps(d)) for i, d in docs], "id int, doc string")
    got = {tuple(r) for r in pv.audited(rows, "id", "doc", blocked).collect()}
    assert got == {(1, "$.rows[0].team.members[0].x", "registered"), (2, "$.name", "masked_row"), (4, "$.name_as_published", "masked_row"), (4, "$.deep.name", "registered")}
