"""Ranks and order statistics of groups that no single task has to hold.

A window over a group, or an exact percentile of it, has one task go through all its rows. That is the shorter way while
a group is small, which is certain where the whole table has at most ``TASK_ROWS`` rows; ``within`` says how many rows a
group has at most. Beyond, rows are dealt out by ranges of the order itself, numbered within each range, and the ranges'
counts summed up before them; and order statistics come from histograms that are refined around the wanted rank.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from racelab.sources.shared import stored

#: Rows of a group that one task may sort.
TASK_ROWS = 5_000_000
#: Buckets of a histogram, and how many values around a wanted rank are looked at one by one.
BUCKETS, GATHERED = 1024, 10_000


def fits(within: int | None) -> bool:
    """Whether a task may go through groups of ``within`` rows at most; of no known number it may not."""
    return within is not None and within <= TASK_ROWS


def _by(keys: list[str]) -> Window:
    return Window.partitionBy(*keys)


def numbered(rows: DataFrame, keys: list[str], order: list[Column], name: str, within: int | None = None) -> DataFrame:
    """``rows`` with their place, from 1 on, in the order of their group. The order must tell all rows of a group apart.

    Groups of more than ``TASK_ROWS`` rows, or of no known number, are numbered across tasks: a third of all rows may
    be one group. Keys may be null.
    """
    if fits(within):
        return rows.withColumn(name, F.row_number().over(_by(keys).orderBy(*order)))
    return added_up(rows, keys, order, F.lit(1), name)


def added_up(rows: DataFrame, keys: list[str], order: list[Column], amount: Column, name: str) -> DataFrame:
    """``rows`` with the sum of an amount over the rows of their group up to their own, across tasks."""
    # stored, so counts and places come from the same ranges, whatever happens to a task
    dealt = stored(rows.withColumn("_amount", amount.cast("long")).repartitionByRange(*keys, *order).withColumn("_range", F.spark_partition_id()))
    sums = dealt.groupBy(*keys, "_range").agg(F.sum("_amount").alias("_sum"))
    # a row for each group and range
    before = F.coalesce(F.sum("_sum").over(_by(keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*(F.col(k).alias(f"_{k}") for k in keys), F.col("_range").alias("_of"), before.alias("_before"))
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col("_range") == F.col("_of"))
    local = F.sum("_amount").over(_by([*keys, "_range"]).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.withColumn("_local", local).join(sums, same).select(*rows.columns, (F.col("_before") + F.col("_local")).alias(name))


def slower(rows: DataFrame, keys: list[str], value: str, within: int | None = None) -> DataFrame:
    """``rows`` with ``n``, the rows of their group, and ``slower``, how many of those have a larger value; ties have not."""
    if fits(within):
        n = F.count("*").over(_by(keys))
        # the default frame of an ordered window takes ties in
        return rows.select("*", n.alias("n"), (n - F.count("*").over(_by(keys).orderBy(value))).alias("slower"))
    each = rows.groupBy(*keys, value).agg(F.count("*").alias("_ties"))
    upto = stored(added_up(each, keys, [F.col(value)], F.col("_ties"), "_upto"))
    whole = upto.groupBy(*keys).agg(F.max("_upto").alias("n"))
    return rows.join(upto.drop("_ties"), [*keys, value]).join(whole, keys).select(*rows.columns, "n", (F.col("n") - F.col("_upto")).alias("slower"))


def standings(rows: DataFrame, keys: list[str], value: str, name: str, within: int | None = None) -> DataFrame:
    """``rows`` with their rank by descending value; equal values share one, and the next rank is as many behind."""
    if fits(within):
        return rows.withColumn(name, F.rank().over(_by(keys).orderBy(F.desc(value))))
    return slower(rows, keys, value).withColumn(name, F.col("slower") + 1).drop("n", "slower")


def with_largest(rows: DataFrame, keys: list[str], value: str, name: str, within: int | None = None) -> DataFrame:
    """``rows`` with the largest value of their group."""
    if fits(within):
        return rows.withColumn(name, F.max(value).over(_by(keys)))
    return rows.join(rows.groupBy(*keys).agg(F.max(value).alias(name)), keys)


def order_statistics(rows: DataFrame, keys: list[str], value: str, wanted: dict[str, Callable[[Column], Column]], buckets: int = BUCKETS, gathered: int = GATHERED) -> DataFrame:
    """(*keys, *wanted): for each group the values at some places of its ascending values, nulls left out.

    ``wanted`` gives a place, from 0 on, by the number of values. Counts of a histogram tell which bucket holds the
    place; the next round has a histogram of that bucket alone, until it holds few values or one value only. What is
    shuffled are counts, and at the end ``gathered`` values for each group and place at most. Values must be finite.
    """
    known = stored(rows.where(F.col(value).isNotNull()).select(F.struct(*keys).alias("k"), F.col(value).cast("double").alias("v")))
    spans = known.groupBy("k").agg(F.count("*").alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    places = F.array(*(F.struct(F.lit(name).alias("name"), at(F.col("inside")).cast("long").alias("place")) for name, at in wanted.items()))
    targets = stored(spans.select("k", "inside", "lo", "hi", F.inline(places)))
    wide = (F.col("hi") > F.col("lo")) & (F.col("inside") > gathered)
    while not targets.where(wide).isEmpty():
        bucket = F.least(F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * buckets), F.lit(buckets - 1))
        hits = known.join(targets.where(wide), "k").where(F.col("v").between(F.col("lo"), F.col("hi")))
        counts = hits.groupBy("k", "name", "place", bucket.alias("bucket")).agg(F.count("*").alias("inside"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        upto = F.sum("inside").over(Window.partitionBy("k", "name").orderBy("bucket"))  # as many rows as buckets
        inner = counts.withColumn("upto", upto).where((F.col("place") < F.col("upto")) & (F.col("place") >= F.col("upto") - F.col("inside")))
        inner = inner.select("k", "inside", "lo", "hi", "name", (F.col("place") - F.col("upto") + F.col("inside")).alias("place"))
        targets = stored(targets.where(~wide).unionByName(inner))
    near = known.join(targets.where("hi > lo"), "k").where(F.col("v").between(F.col("lo"), F.col("hi")))
    at = F.row_number().over(Window.partitionBy("k", "name").orderBy("v")) - 1
    found = near.withColumn("at", at).where(F.col("at") == F.col("place")).select("k", "name", "v")
    found = found.unionByName(targets.where("hi = lo").select("k", "name", F.col("lo").alias("v")))
    values = found.groupBy("k").agg(*(F.max(F.when(F.col("name") == name, F.col("v"))).alias(name) for name in wanted))
    return values.select("k.*", *wanted)


def nearest_rank_at(q: float) -> Callable[[Column], Column]:
    """The place of rank ceil(q n)."""
    return lambda n: F.greatest(F.ceil(n * q) - 1, F.lit(0))


def rounded_at(q: float) -> Callable[[Column], Column]:
    """The place round((n - 1) q), halves to even."""
    return lambda n: F.bround((n - 1) * q)
