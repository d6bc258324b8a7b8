"""Passage tables and checkpoint configurations on literal cases."""

from racelab.operators import normalize as nm


def test_passages(spark):
    row = lambda *cells: "<tr>" + "".join(f"<td>{c}</td>" for c in cells) + "</tr>"
    good = row("32 km", "12,5 km", "", "1:00:05", "3 / 2 / 1", "", "2:00:00", "7 (5, 4)", "10:00:00")
    rest = row("Mellantid 2", *"1234567") + row("Totalt", *"1234567") + row("", *"1234567") + row("short", "1")
    late = row("Målgång", "x", "", "", "9", "5:00", "unknown", "")
    pages = [(1, f"<table class='a splits-table b'>{rest}{good}</table><table class='splits-table'>{late}</table>"), (2, f"<table class='other'>{good}</table>"), (3, None), (4, "")]
    rows = nm.passages(spark.createDataFrame(pages, "page int, html string"), "page").orderBy("page", "sequence_no").collect()
    assert [(r["page"], r["sequence_no"], r["label"], r["checkpoint_key"]) for r in rows] == [(1, 1, "32 km", "32-km"), (1, 2, "Målgång", "malgang")]
    a, b = rows
    assert tuple(a)[4:] == (32.0, 12.5, 3605, 3, 2, 1, None, 7200, 7, 5, 4, "10:00:00")
    assert tuple(b)[4:] == (None, None, None, 9, None, None, "5:00", None, None, None, None, None)


def test_semantics(spark):
    entry = lambda years, labels, key, landmark=None, role="r": (years, labels, key, landmark, role, True, "c")
    config = spark.createDataFrame([([entry([1, 2], ["a", "b"], "x"), entry([2], ["a"], "y", "z", None), entry([3], ["f"], "finish"), entry([4], ["n"], None, None, "n")],)], nm.MAPPINGS)
    rows = spark.createDataFrame([(1, "a"), (2, "a"), (2, "b"), (3, "f"), (3, "a"), (4, "n"), (None, "a"), (1, None)], "year int, label string")
    got = {(r["year"], r["label"]): (r["semantic_key"], r["landmark_key"], r["role"]) for r in nm.with_semantics(rows, nm.semantics_index(config)).collect()}
    un = (None, None, "unmapped_source_checkpoint")
    assert got == {(1, "a"): ("x", "x", "r"), (2, "a"): ("y", "z", None), (2, "b"): ("x", "x", "r"), (3, "f"): ("finish", None, "r"), (3, "a"): un, (4, "n"): (None, None, "n"), (None, "a"): un, (1, None): un}
