"""Collects the queries of all operator modules, with the DuckDB SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from racelab.plans import audits, compare, evidence, geo, ingest, joins, network, rankings, routes, segments, stats

MODULES = (stats, segments, rankings, joins, compare, geo, routes, network, evidence, audits, ingest)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for module in MODULES for name, sql in module.ORACLE.items()}
