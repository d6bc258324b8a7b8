"""Passages of providers' tables, and what their checkpoints stand for by configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.functions import text as tx
from racelab.sources.html import table_cells

#: The class of a table of passages, first cells of its rows that are no passages, and how such may begin.
SPLITS_CLASS, NO_PASSAGES, INTERMEDIATE = "splits-table", ("Distans", "Totalt"), "Mellantid"
#: A configuration of checkpoints.
MAPPINGS = "mappings array<struct<years:array<int>,source_labels:array<string>,semantic_key:string,canonical_landmark_key:string,role:string,analysis_primary:boolean,confidence:string>>"


def passages(pages: DataFrame, key: str) -> DataFrame:
    """The passages of pages, (key, html), in the order of their rows; a page without such a table has none.

    A row counts with eight cells at least and a first cell that is neither empty nor a heading. Its cells are label,
    distance, one that is left out, time, ranks, pace, elapsed time, ranks, and perhaps a clock. What can't be parsed is
    null, also the elapsed time: the passage stays. ``sequence_no`` counts the passages of a page from 1.
    """
    cells = pages.select(key, F.inline(table_cells(F.col("html")))).where(F.col("table_class").contains(SPLITS_CLASS))
    rows = cells.groupBy(key, "table_no", "row_no").agg(F.transform(F.array_sort(F.collect_list(F.struct("cell_no", "text"))), lambda c: c["text"]).alias("c"))
    label = F.get("c", F.lit(0))
    kept = rows.where((F.size("c") >= 8) & (label != "") & ~label.isin(*NO_PASSAGES) & ~label.startswith(INTERMEDIATE))
    at = lambda i: F.get("c", F.lit(i))
    published = lambda i: F.nullif(at(i), F.lit(""))
    part, whole = tx.parse_rank_triple(at(4)), tx.parse_rank_triple(at(7))
    ranks = lambda prefix, r: (r["overall"].alias(f"{prefix}place_overall"), r["gender"].alias(f"{prefix}place_gender"), r["class_"].alias(f"{prefix}place_class"))
    return kept.select(
        key, F.row_number().over(Window.partitionBy(key).orderBy("table_no", "row_no")).alias("sequence_no"), label.alias("label"), tx.slug(label).alias("checkpoint_key"),
        tx.parse_distance(label).alias("reported_km"), tx.parse_distance(at(1)).alias("segment_km"), tx.parse_seconds(at(3)).cast("long").alias("segment_seconds"), *ranks("segment_", part),
        published(5).alias("segment_pace"), tx.parse_seconds(at(6)).cast("long").alias("seconds"), *ranks("", whole), published(8).alias("clock"),
    )


def semantics_index(config: DataFrame) -> DataFrame:
    """(year, label, semantic_key, landmark_key, role, analysis_primary, confidence) of configurations with ``MAPPINGS``.

    Of several entries for a year and label the last counts. The landmark is the entry's own, else its semantic key, but
    a finish is none.
    """
    entries = config.select(F.posexplode("mappings").alias("pos", "m")).select("pos", "m", F.explode("m.years").alias("year"))
    entries = entries.select("pos", "m", "year", F.explode("m.source_labels").alias("label")).groupBy("year", "label").agg(F.max_by("m", "pos").alias("m"))
    key = F.col("m.semantic_key")
    landmark = F.coalesce("m.canonical_landmark_key", F.when(key != "finish", key))
    return entries.select("year", "label", key.alias("semantic_key"), landmark.alias("landmark_key"), "m.role", "m.analysis_primary", "m.confidence")


def with_semantics(rows: DataFrame, index: DataFrame, unmapped: str = "unmapped_source_checkpoint") -> DataFrame:
    """Rows of a year and label with what their checkpoint stands for; ``role`` marks those that the index lacks.

    An entry may itself have no role, which stays null. The index is configuration: Spark broadcasts it while it is small.
    """
    found: Column = F.col("mapped").isNotNull()
    x = rows.join(index.withColumn("mapped", F.lit(True)), ["year", "label"], "left")
    return x.withColumn("role", F.when(found, F.col("role")).otherwise(F.lit(unmapped))).drop("mapped")
