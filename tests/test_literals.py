"""Single operators on literal cases."""

import pytest
from pyspark.sql import functions as F

from racelab.functions import text as tx
from racelab.functions.nested import masked
from racelab.operators import geo, stats
from racelab.operators.observations import at_least
from racelab.plans import compare, evidence
from racelab.sources.html import cells_of


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")


def values(frame, c):
    return [r[0] for r in frame.orderBy("i").select(c).collect()]


def test_quantile(spark):
    assert column(spark, [0.0, 10.0, 20.0, 30.0, None], "double").agg(stats.quantile("x", 0.25)).first()[0] == 7.5
    assert column(spark, [None, 10.0, 20.0], "double").agg(stats.quantile("x", 0.5)).first()[0] == 15
    assert column(spark, [], "double").agg(stats.quantile("x", 0.5)).first()[0] is None


def test_bins(spark):
    rows = column(spark, [None, 900, 1799, 1800], "int").withColumn("k", F.lit(1))
    assert [(r["bin"], r["n"]) for r in stats.bins(rows, "x", 900, ["k"]).orderBy("bin").collect()] == [(900, 2), (1800, 1)]
    with pytest.raises(ValueError):
        stats.bins(rows, "x", 0, ["k"])


@pytest.mark.parametrize("n", [0, 4, 5, 9, 10, 19, 20])
def test_thresholds(spark, n):
    r = column(spark, [float(i) for i in range(n)], "double").agg(*stats.distribution("x")).first()
    assert (r["median"] is not None, r["q25"] is not None, r["q10"] is not None) == (n >= 5, n >= 10, n >= 20)
    assert spark.range(n).agg(at_least(5, F.count("*"), F.count("*")).alias("x")).first()[0] == (n if n >= 5 else None)


def test_summary_counts_no_unknown_starters(spark):
    rows = [("FINISHED", 1000.0 + 10 * i) for i in range(5)] + [("DNS", None), ("UNKNOWN", None), ("DNF", None)]
    r = spark.createDataFrame(rows, "status string, finish_seconds double").agg(*stats.summary()).first()
    assert (r["total"], r["starters"], r["finished"], r["median"]) == (8, 6, 5, 1020)


def test_groups(spark):
    rows = spark.createDataFrame([(1, 1, " Test ", "DNF", None), (1, 2, "test", "DNF", None)], "k int, rid int, c string, status string, finish_seconds double")
    r = stats.groups(rows, "c", ["k"]).collect()
    assert len(r) == 1 and r[0]["display"] == " Test " and r[0]["median"] is None


def test_nearest_equals_brute_force(spark):
    import random

    rng = random.Random(4)
    pts = lambda: [(1, 55.5 + rng.random() / 50, 14 + rng.random() / 50) for _ in range(80)]
    a, b = pts(), pts()
    frame = lambda p: spark.createDataFrame(p, "k int, lat double, lon double")
    got = {(r["lat"], r["lon"]): r["separation"] for r in geo.nearest(frame(a), frame(b), ["k"], 250.0).collect()}
    cross = frame(a).crossJoin(frame(b).toDF("k2", "y", "x")).groupBy("lat", "lon").agg(F.min(geo.haversine(F.col("lat"), F.col("lon"), F.col("y"), F.col("x"))).alias("d"))
    for r in cross.collect():
        assert got[r["lat"], r["lon"]] == (pytest.approx(r["d"]) if r["d"] <= 250 else None)


def test_parse(spark):
    rows = column(spark, ["1:02:03", "59:59", "x", None, "1:2:3"])
    assert values(rows, tx.parse_seconds(F.col("x"))) == [3723, 3599, None, None, None]
    assert values(column(spark, ["UTGÅTT", "dns", "dnf dns", "ok", None, "Did not finish", "inte startat", "diskvalificerad", "starta om"]), tx.status_detect(F.col("x"))) == ["DNF", "DNS", None, None, None, "DNF", "DNS", "DSQ", None]
    assert values(column(spark, ["Mål 12,5 km", "x", "12  KM", "3.5Km", None]), tx.parse_distance(F.col("x"))) == [12.5, None, 12.0, 3.5, None]
    assert values(column(spark, [-3725.5, 59.5, None], "double"), tx.format_time(F.col("x"))) == ["-1:02:06", "0:01:00", None]
    assert values(column(spark, ["Åsa  Öberg!", None]), tx.slug(F.col("x"))) == ["asa-oberg", None]
    assert values(column(spark, [" ÅSA\tß "]), tx.normalize_name(F.col("x"))) == ["åsa ss"]
    assert values(column(spark, ["F40-44", "M", "Öppen"]), tx.category_split(F.col("x"))["age_category"]) == ["40-44", None, None]


def test_confirmed_minor(spark):
    bands = ["F0-11", "M12-13", "(F) 16-17", "16–17 kvinnor", "M18-19", "M17+", ""]
    rows = column(spark, bands)
    assert values(rows, evidence.confirmed_minor(F.lit(None).cast("int"), F.col("x"))) == [True] * 4 + [False] * 3
    assert values(column(spark, [17, 18], "int"), evidence.confirmed_minor(F.col("x"))) == [True, False]


def test_segment_score(spark):
    rows = [(1, "a", 0.78), (1, "a", 0.78), (2, "a", 0.78), (2, "b", 0.82)]
    none = spark.createDataFrame([], "segment int, penalty double")
    r = {x["segment"]: x["score"] for x in evidence.segment_scores(spark.createDataFrame(rows, "segment int, independence_group string, weight double"), none).collect()}
    assert r[1] == 0.78 and r[2] > 0.9


def test_comparable(spark):
    rows = [("f-1", 1, "f", "v1", "g"), ("f-2", 2, "f", "v2", "g"), ("f-3", 3, "f", "v3", None)]
    r = {(x["a"], x["b"]): x["comparable"] for x in compare.comparable(spark.createDataFrame(rows, "race_key string, year int, race_family string, course_version string, course_group string")).collect()}
    assert r["f-1", "f-2"] and not r["f-1", "f-3"] and r["f-3", "f-3"]


def test_html_cells():
    page = "<table class='splits-table'><tr><th>P</th></tr><tr><td>A <table><tr><td>in</td></tr></table></td><td><a href='/x'>B</a></td></tr></table>"
    cells = cells_of(page)
    assert [(c["table_no"], c["row_no"], c["cell_no"], c["text"]) for c in cells] == [(0, 0, 0, "P"), (0, 1, 0, "A"), (1, 0, 0, "in"), (0, 1, 1, "B")]
    assert cells[-1]["links"] == ["/x"] and cells_of(None) == []


def test_masked():
    assert masked({"name": "A", "list": [{"bib": "1", "x": 2}], "deep": {"name": "B"}}) == ({"name": "Protected participant", "list": [{"bib": None, "x": 2}], "deep": {"name": "Protected participant"}}, 3)


def test_list_entries():
    from racelab.sources.html import entries_of

    pattern = r"/results/([0-9]+)"
    page = """<a href="/results/9">elsewhere</a><table><tr><th>Bib</th><th> Full
      name</th></tr><tr><td>1</td><td><a href="/x">x</a><a href="/results/5">Ann &amp; Bo</a></td></tr><tr><th>Only</th></tr><tr><td><a href="/results/6">C</a></td></tr>
      <tr><td><a href="/results/7/edit">not this</a></td></tr></table><table><tr><td><a href="/results/8">no header here</a></td></tr></table>"""
    assert [(e["result_id"], e["headers"], e["row"]) for e in entries_of(page, pattern)] == [
        ("5", ["Bib", "Full name"], ["1", "xAnn & Bo"]), ("6", ["Only"], ["C"]), ("8", [], ["no header here"]),
    ]
    assert [(e["result_id"], e["row"]) for e in entries_of('<a href="/results/3">a</a> /results/4 /results/3', pattern)] == [("3", []), ("4", [])]
    assert entries_of(None, pattern) == entries_of("", pattern) == []


SAID = {
    "DNF": ("DNF", "UTGÅTT efter 20 km", "har Brutit loppet", "bröt vid 45 km", "retired", "Did not finish"),
    "DNS": ("DNS", "ej start", "Ej startat", "inte start", "Inte startat", "Did not START", "no start"),
    "DSQ": ("DSQ", "DQ", "diskvalificerad", "Diskval.", "disqualified"),
    None: ("startade", "utgåttan", "DNFX", "DNF eller DNS", "", "diskret", None),
}


def test_status_texts(spark):
    cases = [(text, status) for status, texts in SAID.items() for text in texts]
    assert values(column(spark, [t for t, _ in cases]), tx.status_detect(F.col("x"))) == [s for _, s in cases]


def test_status_words(spark):
    texts = [f"undnf dnfs ({word.capitalize()}), disqualx" for word in tx.COUNTED_WORDS]
    assert values(column(spark, texts), tx.status_words(F.col("x"))) == [[word] for word in tx.COUNTED_WORDS]


LABELS = (
    ("ULTRA", "ultra60", 60, None), ("Lopp  60 km", "ultra60", 60, 60), ("Duo 60k", "duo60", 60, 60), ("DUO", "duo60", 60, 60), ("Relay 22 km", "duo60", 60, 22),
    ("Trail 22KM", "trail22", 22, 22), ("21 k herrar", "trail22", 22, 21), ("13km", "trail14", 14, 13), ("Trail 14 km", "trail14", 14, 14), ("5 km knatte", "trail5", 5, 5),
    ("15 km", None, None, None), ("60kmx", None, None, None), ("160 km", None, None, None), (None, None, None, None),
)


def test_classes(spark):
    from pyspark.errors import PySparkException

    from racelab.operators import catalog

    found = catalog.classes(spark.createDataFrame([(row[0],) for row in LABELS], "label string"))
    assert {tuple(r) for r in found.collect()} == set(LABELS)
    assert catalog.mapped(found.where("family is not null")).count() == 10
    with pytest.raises(PySparkException, match="unmapped class: 15 km"):
        catalog.mapped(found.where("label = '15 km'")).collect()


WAYPOINTS = (
    ("Bengtemölla", (), "bengtemolla"), ("VANTALÄNGAN", ("drink",), "vantalangan"), ("Vid Stenshuvud", (), "stenshuvud"), ("Start/mål", (), "start"), ("restart", (), None),
    ("Målgång", (), "finish"), ("Finish line", (), "finish"), (None, ("Depart",), "start"), ("x", ("photo", "Arrivee"), "finish"), ("Departure", (), None), (None, None, None),
)


def test_landmarks(spark):
    rows = spark.createDataFrame([(i, t, None if k is None else list(k)) for i, (t, k, _) in enumerate(WAYPOINTS)], "i int, title string, types array<string>")
    assert values(rows, tx.landmark(F.col("title"), F.col("types"))) == [w for _, _, w in WAYPOINTS]


CELLS = (
    ("", "<EMPTY>"), (" \u00a0", "<EMPTY>"), (None, "<EMPTY>"), ("Klass", "Klass"), (" mellantid 3", "mellantid 3"), ("7", "7"), ("12", "<NUMBER>"), ("12,5", "<NUMBER>"), ("1:02:03", "<TIME>"),
    ("59:10", "<TIME>"), ("123:45", "<TEXT>"), ("10 KM", "<DISTANCE>"), ("9.5km", "<DISTANCE>"), ("Klass A", "<TEXT>"), ("-3", "<TEXT>"),
)


def test_cells(spark):
    assert values(column(spark, [c for c, _ in CELLS]), tx.safe_cell(F.col("x"))) == [shown for _, shown in CELLS]


def test_source_coverage(spark):
    from racelab.operators import catalog

    frame = lambda rows, schema: spark.createDataFrame(rows, schema)
    expected = frame([(2020, "duo60", "ultra60"), (2020, "ultra60", "ultra60"), (2021, "duo60", "ultra60"), (2022, "trail", "trail")], "year int, family string, route_family string")
    observed = frame([(2020, "ultra60", "7", "Ultra")], "year int, family string, distance_id string, label string")
    inventories = frame([(2020, "ultra60", 5, True, ["", "20 km", "Totalt"]), (2020, "duo60", None, False, None)], "year int, family string, sample int, has_table boolean, labels array<string>")
    tracking = frame([(2020, True, ["7"])], "year int, view boolean, distance_ids array<string>")
    sources = frame([(2020, "ultra60", None, "a.gpx", None), (2020, "ultra60", "t1", None, None), (2021, "ultra60", "t2", None, "m.pdf")], "year int, family string, trace_id string, gpx string, map string")
    args = (expected, observed, inventories, tracking, sources)
    got = {(r["year"], r["family"]): r for r in catalog.source_coverage(*args).collect()}
    assert len(got) == 4
    r = got[2020, "ultra60"]
    assert (r["detail_status"], r["split_status"], r["split_labels"], r["tracking_match"], r["trace_ids"], r["geometry_status"]) == (catalog.SEEN, catalog.SPLITS, ["20 km"], True, ["t1"], "archived")
    r = got[2020, "duo60"]
    assert (r["class_observed"], r["detail_status"], r["split_status"], r["tracking_view"], r["tracking_match"], r["geometry_status"]) == (False, catalog.ADAPTER, catalog.NO_SPLITS, True, False, "via_route_family")
    assert (got[2021, "duo60"]["geometry_status"], got[2021, "duo60"]["map_files"], got[2021, "duo60"]["split_status"]) == ("route_family_reference_only", 1, catalog.NOT_INVENTORIED)
    assert (got[2022, "trail"]["geometry_status"], got[2022, "trail"]["split_count"], got[2022, "trail"]["detail_status"]) == ("missing", 0, catalog.UNSEEN)
    races = expected.withColumn("course_version", F.lit("old"))
    assigned = frame([(2020, "ultra60", "v1", "verified")], "year int, family string, course_version string, status string")
    ready = frame([(2020, "ultra60", True)], "year int, family string, replay boolean")
    geometry = frame([(2020, "ultra60", "h", 60.0)], "year int, route_family string, hash string, km double")
    rows = {(r["year"], r["family"]): r for r in catalog.enriched(races, observed, assigned, catalog.source_coverage(*args), ready, geometry).collect()}
    assert (rows[2020, "duo60"]["geometry_hash"], rows[2020, "duo60"]["version_status"], rows[2020, "duo60"]["catalog_version"], rows[2020, "duo60"]["replay"]) == ("h", "not_assigned", "old", None)
    assert (rows[2020, "ultra60"]["course_version"], rows[2020, "ultra60"]["replay"]) == ("v1", True) and len(rows) == 4
