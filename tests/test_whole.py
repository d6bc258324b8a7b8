"""Whole results: nothing left out by ids, windows or radii."""

from pyspark.sql import functions as F

from racelab import registry
from racelab.sources import files

SF = "/root/testdata/sf0.001"


def test_results_of_every_person(spark):
    rows = registry.queries()["cmp_person_results"](spark, SF)
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assert rows.count() == orders.count()
    assert rows.select("custkey").distinct().count() == orders.select(F.col("o_custkey")).distinct().count()


def test_cells_of_every_form(spark):
    """Every result shows its cells, and all kinds of cells occur, known labels and single digits as well."""
    rows = registry.queries()["fn_safe_cell"](spark, SF).collect()
    assert len({r["rid"] for r in rows}) == len(rows) == spark.read.parquet(f"{SF}/orders.parquet").count()
    shown = {r["cell"] for r in rows}
    kinds = {"<EMPTY>", "<NUMBER>", "<TIME>", "<DISTANCE>", "<TEXT>"}
    assert all(x == "Klass" or x.removeprefix("mellantid ") in list("0123456789") for x in shown - kinds)
    assert kinds <= shown and "Klass" in shown and any(x.isdigit() for x in shown) and any(x.startswith("mellantid ") for x in shown)
    assert {r["club_cell"] for r in rows} == {"<LINKED_TEXT>", "<TEXT>"}


def test_manifest_of_large_sections(spark, monkeypatch):
    """A section is one file in the manifest, also with more records than a part of a bundle holds."""
    want = {(r["race_key"], r["section"]): (r["records"], r["bytes"], r["sha256"]) for r in registry.queries()["snk_manifest"](spark, SF).collect()}
    monkeypatch.setattr(files.write_bundles, "__defaults__", ("race_key", 7))
    rows = registry.queries()["snk_manifest"](spark, SF).collect()
    assert {(r["race_key"], r["section"]): (r["records"], r["bytes"], r["sha256"]) for r in rows} == want
    assert {r["files"] for r in rows if r["section"]} == {1} and max(r["records"] for r in rows if r["section"]) > 7
