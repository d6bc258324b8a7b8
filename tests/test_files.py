"""Folders of real files in, deliveries out."""

import hashlib
import json

from racelab.sources import files


def test_gpx(spark, tmp_path):
    pt = '<trkpt lat="{}" lon="{}">{}</trkpt>'
    (tmp_path / "a.gpx").write_text(
        f'<gpx><trk><trkseg>{pt.format(1, 2, "<ele>3.5</ele>")}{pt.format(4, 5, "")}</trkseg><trkseg></trkseg><trkseg>{pt.format(6, 7, "")}</trkseg></trk><trk><trkseg>{pt.format(8, 9, "")}</trkseg></trk></gpx>'
    )
    (tmp_path / "b.gpx").write_text('<gpx><rte><rtept lat="1" lon="2"/><rtept lat="3" lon="4"/></rte></gpx>')
    (tmp_path / "c.gpx").write_text("<gpx></gpx>")
    out = [(r["file"].rsplit("/")[-1], r["pos"], r["lat"], r["lon"], r["ele"]) for r in files.read_gpx(spark, str(tmp_path)).orderBy("file", "pos").collect()]
    assert out == [("a.gpx", 0, 1, 2, 3.5), ("a.gpx", 1, 4, 5, None), ("a.gpx", 2, 6, 7, None), ("a.gpx", 3, 8, 9, None), ("b.gpx", 0, 1, 2, None), ("b.gpx", 1, 3, 4, None)]


def test_geojson(spark, tmp_path):
    line = {"type": "LineString", "coordinates": [[2, 1], [4, 3, 100]]}
    feature = {"type": "Feature", "properties": {"x": 1}, "geometry": line}
    for name, doc in (("a", line), ("b", feature), ("c", {"type": "FeatureCollection", "features": [feature, {"type": "Feature", "geometry": None}, feature]}), ("d", {"type": "FeatureCollection", "features": []})):
        (tmp_path / f"{name}.geojson").write_text(json.dumps(doc, indent=1))
    (tmp_path / "e.geojson").write_text("not json")
    out = [(r["file"][-9], r["line"], r["pos"], r["lat"], r["lon"]) for r in files.read_geojson(spark, str(tmp_path)).orderBy("file", "line", "pos").collect()]
    assert out == [(n, i, p, lat, lon) for n, lines in (("a", 1), ("b", 1), ("c", 2)) for i in range(lines) for p, lat, lon in ((0, 1, 2), (1, 3, 4))]


def test_snapshots_and_config(spark, tmp_path):
    (tmp_path / "s").mkdir()
    (tmp_path / "s/1.jsonl").write_text('{"result_id": 1, "headers": ["A"], "row": ["x"]}\nbroken\n{"result_id": 2, "error": "timeout", "other": {}}\n')
    rows = [tuple(r) for r in files.read_snapshots(spark, str(tmp_path / "s")).collect()]
    assert sorted(rows, key=str) == sorted([(1, ["A"], ["x"], None), (None, None, None, None), (2, None, None, "timeout")], key=str)
    (tmp_path / "c").mkdir()
    (tmp_path / "c/list.json").write_text('[{"key": 1},\n {"key": 2, "label": "x"}]')
    (tmp_path / "c/one.json").write_text('{"key": 3}')
    assert {tuple(r) for r in files.read_config(spark, str(tmp_path / "c"), "key int, label string").collect()} == {(1, None), (2, "x"), (3, None)}


def test_bundles(spark, tmp_path):
    """Sections of several races, one of them large: parts in order, read back, and a manifest of what is there."""
    rows = [(f"r{i % 3}", i, f"n{i}") for i in range(100)] + [("big", i, "é") for i in range(1000, 1300)]
    marks = [(r, c) for r in ("r0", "big", "alone") for c in "ba"]
    sections = {"marks": (spark.createDataFrame(marks, "race_key string, cp string"), ["cp"]), "records": (spark.createDataFrame(rows, "race_key string, rid long, name string").repartition(3), ["rid"])}
    folder = f"file://{tmp_path}/out"
    files.write_bundles(sections, folder, file_records=50)
    written = {p: p.read_bytes() for p in (tmp_path / "out").rglob("*.txt")}
    by = {}
    for path, body in sorted(written.items()):
        race, section = (path.parts[k].split("=")[1] for k in (-4, -3))
        lines = [json.loads(line) for line in body.splitlines()]
        assert lines == sorted(lines, key=lambda x: list(x.values())) and len(lines) < 100
        by.setdefault((race, section), []).append((lines, body))
    assert [p.name for p in tmp_path.iterdir()] == ["out"]
    assert sorted(s for r, s in by if r == "r0") == ["0-marks", "1-records"] and len(by["big", "1-records"]) > 2
    back = files.read_bundles(spark, folder, "records", "rid long, name string")
    assert sorted(map(tuple, back.collect())) == sorted(rows)
    assert sorted(map(tuple, files.read_bundles(spark, folder, "marks", "cp string").collect())) == sorted(marks)
    want = {}
    for (race, section), parts in by.items():
        for key in ((race, section[2:]), (race, None), (None, None)):
            want.setdefault(key, []).extend(parts)
    sha = lambda parts: hashlib.sha256("".join(sorted(hashlib.sha256(b).hexdigest() for _, b in parts)).encode()).hexdigest()
    got = {(r["race_key"], r["section"]): (r["records"], r["files"], r["bytes"], r["sha256"]) for r in files.manifest(spark, folder).collect()}
    assert got == {k: (sum(len(x) for x, _ in v), len(v), sum(len(b) for _, b in v), sha(v)) for k, v in want.items()}


def test_star(spark, tmp_path):
    rows = [(2000 + i % 2, "a" if i % 10 else "b", i) for i in range(500)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would make one task
    files.write_star({"t": spark.createDataFrame(rows, "year int, family string, x int")}, str(tmp_path), ["year", "family"], file_rows=60)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/t").select("year", "family", "x").collect())) == sorted(rows)
    assert len(list((tmp_path / "t/year=2001/family=a").glob("*.parquet"))) > 1


def test_osm(spark, tmp_path):
    """Ways over several files with shared and repeated nodes, several tags, and ways that drop out."""
    (tmp_path / "a").mkdir()
    (tmp_path / "a/1.osm").write_text(
        '<?xml version="1.0"?>\n<osm version="0.6"><node id="1" lat="1.5" lon="10"/><node id="2" lat="2.5" lon="20"><tag k="x" v="y"/></node>\n'
        '<way id="70"><nd ref="1"/><nd ref="2"/><nd ref="3"/><nd ref="1"/><tag k="name" v="Old"/><tag k="highway" v="path"/><tag k="name" v="Round"/></way>\n'
        '<way id="71"><nd ref="1"/><nd ref="2"/><tag k="highway" v="motorway"/></way><way id="72"><nd ref="1"/><nd ref="99"/><tag k="highway" v="path"/></way></osm>'
    )
    (tmp_path / "2.osm").write_text(
        '<osm><node id="2" lat="2.5" lon="20"/><node id="3" lat="-3" lon="30"/><node id="4" lat="4"/>'
        '<way id="73"><nd ref="3"/><nd ref="2"/><tag k="highway" v="track"/></way><way id="73"><nd ref="3"/><nd ref="2"/><tag k="highway" v="track"/></way>'
        '<way id="74"><nd ref="1"/><tag k="highway" v="path"/></way><way id="75"><nd ref="1"/><nd ref="4"/><tag k="highway" v="path"/></way><way id="76"><nd ref="1"/><nd ref="2"/></way></osm>'
    )
    out = [(r["way"], r["pos"], r["lat"], r["lon"], r["highway"], r["name"]) for r in files.read_osm_ways(spark, str(tmp_path)).orderBy("way", "pos").collect()]
    round_ = [(70, i, lat, lon, "path", "Round") for i, (lat, lon) in enumerate([(1.5, 10), (2.5, 20), (-3, 30), (1.5, 10)])]
    assert out == [*round_, (73, 0, -3, 30, "track", None), (73, 1, 2.5, 20, "track", None)]
    assert {r["way"] for r in files.read_osm_ways(spark, str(tmp_path), ("motorway",)).collect()} == {71}
