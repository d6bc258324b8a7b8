"""Counts and distributions with publish thresholds: below so many rows a figure is null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.operators.observations import at_least, finished, starter

#: Rows that a median, quartiles and outer deciles need.
MEDIAN_N, QUARTILE_N, DECILE_N = 5, 10, 20


def quantile(value: Column | str, q: float) -> Column:
    """Linear interpolation between ranks; nulls don't count."""
    return F.percentile(value, F.lit(q))


def nearest_rank(value: str, q: float) -> Column:
    """The value at rank ceil(q n)."""
    return F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})")


def distribution(value: str, prefix: str = "") -> list[Column]:
    """n, median, quartiles and outer deciles of a column."""
    n = F.count(value)
    steps = ((0.5, MEDIAN_N, "median"), (0.25, QUARTILE_N, "q25"), (0.75, QUARTILE_N, "q75"), (0.1, DECILE_N, "q10"), (0.9, DECILE_N, "q90"))
    return [n.alias(f"{prefix}n"), *(at_least(k, quantile(value, q), n).alias(f"{prefix}{name}") for q, k, name in steps)]


def finish_time() -> Column:
    """The finish time of finishers, else null."""
    return F.when(finished(), F.col("finish_seconds"))


def summary() -> list[Column]:
    """Aggregates: total, starters, finished, dnf, unknown and the median of at least five finish times."""
    n = F.count_if(finished())
    return [
        F.count("*").alias("total"), F.count_if(starter()).alias("starters"), n.alias("finished"),
        F.count_if(F.col("status") == "DNF").alias("dnf"), F.count_if(F.col("status") == "UNKNOWN").alias("unknown"),
        at_least(MEDIAN_N, quantile(finish_time(), 0.5), n).alias("median"),
    ]


def bins(rows: DataFrame, value: str, step: float, keys: list[str], series: list[str] | None = None) -> DataFrame:
    """A histogram on multiples of ``step`` for each group of ``keys``, empty bins included; ``series`` share bins."""
    if step <= 0:
        raise ValueError("step must be positive")
    series = series or []
    known = rows.where(F.col(value).isNotNull())
    counts = known.groupBy(*keys, *series, (F.floor(F.col(value) / step) * step).alias("bin")).agg(F.count("*").alias("n"))
    span = counts.groupBy(*keys).agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"))
    grid = span.select(*keys, F.explode(F.sequence("lo", "hi", F.lit(step).cast("bigint"))).alias("bin"))
    if series:
        grid = grid.join(counts.select(*keys, *series).distinct(), keys)
    return grid.join(counts, [*keys, *series, "bin"], "left").select(*keys, *series, "bin", F.coalesce("n", F.lit(0)).alias("n"))


def normalized(text: Column) -> Column:
    """Trimmed, white space collapsed, in lower case."""
    return F.lower(F.regexp_replace(F.trim(text), r"\s+", " "))


def groups(rows: DataFrame, column: str, keys: list[str]) -> DataFrame:
    """Summaries by normalized text; the name shown is that of the row with the smallest rid."""
    named = rows.withColumn("group_key", normalized(F.col(column))).where("group_key <> ''")
    return named.groupBy(*keys, "group_key").agg(F.min_by(column, "rid").alias("display"), *summary())


def age_group(age: Column) -> Column:
    return F.when(age < 30, "<30").when(age < 40, "30-39").when(age < 50, "40-49").when(age < 60, "50-59").when(age >= 60, "60+")


def top(rows: DataFrame, n: int, keys: list[str], *order: Column) -> DataFrame:
    """The first ``n`` rows of each group, with their rank."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("rank") <= n)
