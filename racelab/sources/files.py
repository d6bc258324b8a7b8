"""Files in and out: folders of documents as tables, and deliveries as folders of files.

Readers take a folder and return a DataFrame with a row for each point or record; Spark splits the work by files.
Writers split a race's records over files of a bounded number of rows, so neither a task nor a row holds a whole race.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelab.sources.shared import renamed

#: Records of a bundle's file.
FILE_RECORDS = 50_000
_POINT = "array<struct<_lat:double,_lon:double,ele:double>>"
_GPX = f"trk array<struct<trkseg:array<struct<trkpt:{_POINT}>>>>, rte array<struct<rtept:{_POINT}>>"
_LINE = "struct<type:string,coordinates:array<array<double>>>"
_GEOJSON = f"type string, coordinates array<array<double>>, geometry {_LINE}, features array<struct<geometry:{_LINE}>>"
SNAPSHOT = "result_id long, headers array<string>, row array<string>, error string"

#: The highways that are taken from an OSM file.
WALKED = ("path", "footway", "track", "steps", "pedestrian", "service", "unclassified", "tertiary", "secondary", "residential", "living_street", "cycleway", "bridleway", "road")


def document_id() -> Column:
    """The name of a row's file, without its folder and ending."""
    return F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(?:\.[^.]*)?$", 1)


def read_gpx(spark: SparkSession, folder: str) -> DataFrame:
    """(file, pos, lat, lon, ele): the points of all tracks and segments of each GPX file in order, else those of its routes.

    A file without points has no rows; elevations that are missing are null. Subfolders are read too.
    """
    files = spark.read.format("xml").option("rowTag", "gpx").option("recursiveFileLookup", "true").schema(_GPX).load(folder)
    empty = F.array().cast(_POINT)
    points = lambda lists: F.flatten(F.transform(lists, lambda x: F.coalesce(x, empty)))
    track = points(F.flatten(F.transform("trk", lambda t: F.transform(F.coalesce(t["trkseg"], F.array().cast(f"array<struct<trkpt:{_POINT}>>")), lambda s: s["trkpt"]))))
    route = points(F.transform("rte", lambda r: r["rtept"]))
    chosen = F.when(F.size(F.coalesce(track, empty)) > 0, track).otherwise(route)
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.posexplode(chosen).alias("pos", "p"))
    return rows.select("file", "pos", F.col("p._lat").alias("lat"), F.col("p._lon").alias("lon"), "p.ele")


def read_geojson(spark: SparkSession, folder: str) -> DataFrame:
    """(file, line, pos, lat, lon): line strings of each GeoJSON file, bare, in a feature or in a collection of features."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    g = files.select(F.col("_metadata.file_path").alias("file"), F.from_json("value", _GEOJSON).alias("g"))
    one = F.coalesce(F.col("g.coordinates"), F.col("g.geometry.coordinates"))
    of_features = F.transform("g.features", lambda f: f["geometry"]["coordinates"])
    lines = F.when(F.col("g.type") == "FeatureCollection", F.array_compact(of_features)).otherwise(F.array_compact(F.array(one)))
    rows = g.select("file", F.posexplode(lines).alias("line", "points")).select("file", "line", F.posexplode("points").alias("pos", "c"))
    return rows.select("file", "line", "pos", F.col("c")[1].alias("lat"), F.col("c")[0].alias("lon"))


def read_mercator(spark: SparkSession, folder: str, radius: float = 6378137.0) -> DataFrame:
    """(file, pos, lat, lon): JSON files of Web-Mercator points, ``[[x, y], ...]``, in degrees; others have no rows."""
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=True)
    rows = files.select(F.col("_metadata.file_path").alias("file"), F.posexplode(F.from_json("value", "array<array<double>>")).alias("pos", "c"))
    lat = F.degrees(2 * F.atan(F.exp(F.get("c", F.lit(1)) / radius)) - F.pi() / 2)
    return rows.select("file", "pos", lat.alias("lat"), F.degrees(F.get("c", F.lit(0)) / radius).alias("lon"))


def read_osm_ways(spark: SparkSession, folder: str, accepted: tuple[str, ...] = WALKED) -> DataFrame:
    """(way, pos, lat, lon, highway, name, tags): the points, in order, of each way of an accepted highway in a folder of OSM files.

    The files are scanned for nodes and for ways; a way gets its points from the nodes of all files. A way with a node
    that no file has, or with fewer than two, drops out. Nodes and ways that several files repeat count once.
    """
    scan = lambda tag, schema: spark.read.format("xml").option("rowTag", tag).option("recursiveFileLookup", "true").schema(schema).load(folder)
    nodes = scan("node", "_id long, _lat double, _lon double").where("_id is not null and _lat is not null and _lon is not null")
    nodes = nodes.groupBy(F.col("_id").alias("ref")).agg(F.min(F.struct(F.col("_lat").alias("lat"), F.col("_lon").alias("lon"))).alias("at"))
    ways = scan("way", "_id long, nd array<struct<_ref:long>>, tag array<struct<_k:string,_v:string>>").where("_id is not null")
    pairs = F.coalesce(F.filter("tag", lambda t: t["_k"].isNotNull()), F.array().cast("array<struct<_k:string,_v:string>>"))
    # of a repeated key the last counts
    tags = F.map_from_entries(F.filter(pairs, lambda t, i: ~F.exists(F.slice(pairs, i + 2, F.greatest(F.size(pairs), F.lit(1))), lambda u: u["_k"] == t["_k"])))
    refs = F.transform(F.filter("nd", lambda n: n["_ref"].isNotNull()), lambda n: n["_ref"])
    ways = ways.select(F.col("_id").alias("way"), refs.alias("refs"), tags.alias("tags")).where(F.try_element_at("tags", F.lit("highway")).isin(*accepted) & (F.size("refs") >= 2))
    ways = ways.groupBy("way").agg(F.min_by(F.struct("refs", "tags"), F.to_json(F.struct("refs", "tags"))).alias("w")).select("way", "w.*")
    found = ways.select("way", F.posexplode("refs").alias("pos", "ref")).join(nodes, "ref", "left")
    whole = found.groupBy("way").agg(F.bool_and(F.col("at").isNotNull()).alias("whole")).where("whole").select("way")
    named = ways.select("way", F.try_element_at("tags", F.lit("highway")).alias("highway"), F.try_element_at("tags", F.lit("name")).alias("name"), "tags")
    return found.join(whole, "way").join(named, "way").select("way", "pos", "at.lat", "at.lon", "highway", "name", "tags")


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """A provider's records, a JSON object on each line; a line that can't be read has nulls only."""
    return spark.read.schema(SNAPSHOT).json(folder)


def read_config(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The rows of all JSON files of a folder, each of which holds a list of objects or one object."""
    return spark.read.schema(schema).option("multiLine", "true").json(folder)


def write_documents(rows: DataFrame, folder: str, key: str = "key", body: str = "body") -> None:
    """Each row's text as a file of its own, below a folder of its key."""
    rows.select(key, F.col(body).alias("value")).write.partitionBy(key).text(folder)


def write_bundles(sections: dict[str, tuple[DataFrame, list[str]]], folder: str, race: str = "race_key", file_records: int | None = FILE_RECORDS) -> None:
    """A document for each race: its sections in the given order, each in parts of about ``file_records`` JSON lines.

    A section is a DataFrame with the race and an order of its rows. A part is a file of its own, written by one task,
    below race, section and part number, so a large race is written by many tasks and read back in order by those names.
    Without ``file_records`` a section is one part: a task streams its sorted lines to the file.
    The folder takes its place as a whole, by a rename, once all is written.
    """
    lines = []
    for i, (name, (rows, order)) in enumerate(sections.items()):
        values = F.to_json(F.struct(*(c for c in rows.columns if c != race)))
        lines.append(rows.select(race, F.lit(f"{i}-{name}").alias("section"), F.xxhash64(*order).alias("_h"), *(F.col(c).alias(f"_o{i}_{k}") for k, c in enumerate(order)), values.alias("value")))
    keys = sorted({c for x in lines for c in x.columns if c.startswith("_o")})
    whole = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), lines)
    parts = whole.groupBy(race, "section").agg((F.ceil(F.count("*") / file_records).cast("int") if file_records else F.lit(1)).alias("_parts"))
    dealt = whole.join(parts, [race, "section"]).withColumn("part", F.pmod(F.col("_h"), F.col("_parts")).cast("int")).repartition(race, "section", "part")
    beside = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    ordered = dealt.sortWithinPartitions(race, "section", "part", *keys)
    ordered.select(race, "section", "part", "value").write.partitionBy(race, "section", "part").text(beside)
    renamed(whole.sparkSession, beside, folder)


def read_bundles(spark: SparkSession, folder: str, section: str, schema: str, race: str = "race_key") -> DataFrame:
    """The rows of one section of all races."""
    of_section = spark.read.option("basePath", folder).schema(f"value string, {race} string, section string, part int").text(f"{folder}/*/section=[0-9]*-{section}")
    return of_section.select(race, F.from_json("value", schema).alias("r")).select(race, "r.*")


def manifest(spark: SparkSession, folder: str, race: str = "race_key") -> DataFrame:
    """(race, section, records, files, bytes, sha256) of each section, of each race (no section) and of all (neither).

    The hash is one of the files' hashes. A file is read into a row, so parts bound a row's size, else sections do.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder)
    text = F.col("content").cast("string")
    each = files.select(
        F.regexp_extract("path", rf"/{race}=([^/]*)/", 1).alias(race), F.regexp_extract("path", r"/section=[0-9]+-([^/]*)/", 1).alias("section"),
        "length", F.sha2("content", 256).alias("sha"), (F.octet_length(text) - F.octet_length(F.replace(text, F.lit("\n"), F.lit("")))).alias("records"),
    )
    hash_of = F.sha2(F.array_join(F.array_sort(F.collect_list("sha")), ""), 256)
    return each.rollup(race, "section").agg(F.sum("records").alias("records"), F.count("*").alias("files"), F.sum("length").alias("bytes"), hash_of.alias("sha256"))


def write_star(tables: dict[str, DataFrame], folder: str, by: list[str], file_rows: int = 20 * FILE_RECORDS) -> None:
    """Each table below its name, partitioned ``by`` columns; as many tasks write a partition as its rows need."""
    for name, rows in tables.items():
        sizes = rows.groupBy(*by).agg(F.ceil(F.count("*") / file_rows).cast("int").alias("_parts"))
        dealt = rows.join(sizes, by).withColumn("_part", F.pmod(F.xxhash64(*(c for c in rows.columns if c not in by)), F.col("_parts"))).repartition(*by, "_part")
        dealt.drop("_parts", "_part").write.partitionBy(*by).parquet(f"{folder}/{name}")


def write_bootstrap(races: DataFrame, folder: str) -> None:
    """The catalog of races as one JSON file: as many lines as there are races."""
    races.coalesce(1).write.json(folder)
