"""Catalogs of a provider's classes and of what sources each edition has: small tables, joined plainly."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelab.functions import text as tx

#: The states of coverage.
NOT_INVENTORIED, NO_SPLITS, SPLITS = "not_inventoried", "no_split_table_in_sample", "split_table_observed"
SEEN, ADAPTER, UNSEEN = "participant_detail_observed", "team_or_relay_adapter_needed", "not_observed"


def classes(labels: DataFrame) -> DataFrame:
    """Rows with a ``label`` and its family, nominal and stated distance; an unmapped label has no family."""
    family = tx.race_family(F.col("label"))
    return labels.select("*", family.alias("family"), tx.nominal_km(family).alias("nominal_km"), tx.historical_km(F.col("label")).alias("historical_km"))


def mapped(found: DataFrame) -> DataFrame:
    """``classes`` of which every label has a family; the job fails at the first that has none."""
    text = F.concat(F.lit("unmapped class: "), F.coalesce("label", F.lit("(none)")))
    return found.withColumn("family", F.coalesce("family", F.raise_error(text).cast("string")))


def source_coverage(expected: DataFrame, observed: DataFrame, inventories: DataFrame, tracking: DataFrame, sources: DataFrame, relay: str = "duo60") -> DataFrame:
    """One row for each expected (year, family, route_family): which of its sources are there.

    ``observed`` are classes (year, family, distance_id, label); ``inventories`` (year, family, sample, has_table,
    labels) what a sampled result's page had; ``tracking`` (year, view, distance_ids); ``sources`` (year, family,
    trace_id, gpx, map) of a route's family, each a reference, an archived path, or null. A relay runs its route family's
    route, so its geometry comes from there. Missing rows on any side are states, not errors.
    """
    keys = ["year", "family"]
    route = sources.groupBy("year", F.col("family").alias("route_family")).agg(
        F.count("trace_id").alias("route_references"), F.array_sort(F.collect_set("trace_id")).alias("trace_ids"), F.count("gpx").alias("gpx_files"), F.count("map").alias("map_files")
    )
    x = expected.join(observed.withColumn("seen", F.lit(True)), keys, "left").join(inventories.withColumn("inventoried", F.lit(True)), keys, "left")
    x = x.join(tracking, "year", "left").join(route, ["year", "route_family"], "left").fillna(0, ["route_references", "gpx_files", "map_files"])
    table = F.coalesce("has_table", F.lit(False))
    labels = F.when(table, F.filter("labels", lambda s: (s != "") & (s != "Totalt"))).otherwise(F.array().cast("array<string>"))
    x = x.withColumn("split_labels", F.coalesce(labels, F.array().cast("array<string>")))
    is_relay = F.col("family") == relay
    geometry = (
        F.when(is_relay & (F.col("gpx_files") > 0), "via_route_family").when(is_relay & (F.col("route_references") > 0), "route_family_reference_only")
        .when(F.col("gpx_files") > 0, "archived").when(F.col("route_references") > 0, "reference_only").otherwise("missing")
    )
    return x.select(
        *keys, "route_family", F.coalesce("seen", F.lit(False)).alias("class_observed"), "distance_id", "label", F.when(F.col("sample").isNotNull(), SEEN).when(is_relay, ADAPTER).otherwise(UNSEEN).alias("detail_status"), "sample",
        F.when(F.col("inventoried").isNull(), NOT_INVENTORIED).when(table, SPLITS).otherwise(NO_SPLITS).alias("split_status"), "split_labels", F.size("split_labels").alias("split_count"),
        F.coalesce("view", F.lit(False)).alias("tracking_view"), F.coalesce(F.array_contains("distance_ids", F.col("distance_id")), F.lit(False)).alias("tracking_match"),
        "route_references", F.coalesce("trace_ids", F.array().cast("array<string>")).alias("trace_ids"), "gpx_files", "map_files", geometry.alias("geometry_status"),
    )


def enriched(races: DataFrame, observed: DataFrame, assigned: DataFrame, coverage: DataFrame, capabilities: DataFrame, geometry: DataFrame) -> DataFrame:
    """``races`` (year, family, route_family, course_version, ...) with what each catalog knows of them; none loses a race.

    The catalog's own version is kept as ``catalog_version`` beside the assigned one, and ``version_status`` is
    ``not_assigned`` where none is. ``geometry`` (year, route_family, hash, km) is that of the route family.
    """
    keys = ["year", "family"]
    x = races.withColumnRenamed("course_version", "catalog_version").join(observed.select(*keys, "distance_id", "label"), keys, "left")
    x = x.join(assigned.select(*keys, "course_version", F.col("status").alias("version_status")), keys, "left")
    x = x.join(coverage.select(*keys, "split_status", "split_labels", "detail_status", "geometry_status", "tracking_match"), keys, "left")
    x = x.join(geometry.select("year", "route_family", F.col("hash").alias("geometry_hash"), F.col("km").alias("geometry_km")), ["year", "route_family"], "left")
    x = x.join(capabilities, keys, "left")
    return x.withColumns({"version_status": F.coalesce("version_status", F.lit("not_assigned")), "split_status": F.coalesce("split_status", F.lit("unknown"))})
