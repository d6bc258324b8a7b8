"""Helpers that the text operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from racelab.sources.shared import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts the lineage and survives a lost executor."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A key with more than so many rows, and more than one in so many of all rows, is hot.
HOT_ROWS, HOT_KEYS = 1000, 1000


def joined(rows: DataFrame, unique: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``unique``, which has one row for each key and in ``n`` at least how many rows have that key.

    Hot keys are ``HOT_KEYS`` at most, so their rows of ``unique`` are broadcast and their many rows stay where they are;
    the others meet by key. The column ``n`` doesn't come along.
    """
    total, most = unique.agg(F.sum("n"), F.max("n")).first()
    cut = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (most or 0) <= cut:
        return rows.join(unique.drop("n"), key, how)
    hot = F.broadcast(unique.where(F.col("n") > cut).drop("n"))
    rest = rows.join(hot.select(key), key, "left_anti").join(unique.where(F.col("n") <= cut).drop("n"), key, how)
    return rows.join(hot, key).unionByName(rest)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once for each row.

    Inside a lambda, an expression over columns would be evaluated anew for every element, and the optimizer may
    inline a projected column there. A lambda's own variable is not.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def running(items: Column, start: Column, kind: str, step: Callable[[Column, Column], Column], block: int = 256) -> Column:
    """The states of a fold over an array, after each item; ``kind`` is a state's type.

    Each append copies an array, so the fold goes by blocks and copies no more than a block, or one entry for each.
    """

    def of(all_: Column) -> Column:
        def one(acc: Column, x: Column) -> Column:
            return let(step(acc["s"], x), lambda s: F.struct(s.alias("s"), F.array_append(acc["out"], s).alias("out")))

        def of_block(acc: Column, b: Column) -> Column:
            begin = F.struct(acc["s"].cast(kind).alias("s"), F.array().cast(f"array<{kind}>").alias("out"))
            part = F.aggregate(F.slice(all_, b * block + 1, F.lit(block)), begin, one)
            return let(part, lambda p: F.struct(p["s"].alias("s"), F.array_append(acc["out"], p["out"]).alias("out")))

        blocks = F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / block).cast("int"))
        begin = F.struct(start.cast(kind).alias("s"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.when(F.size(all_) > 0, F.aggregate(blocks, begin, of_block, lambda acc: F.flatten(acc["out"]))).otherwise(F.array().cast(f"array<{kind}>"))

    return let(items, of)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; all other characters stay."""
    return F.translate(text, UPPER, LOWER)


class Remembered(dict):
    """A function's values by argument; computes what it lacks and, beyond a bound, drops what wasn't used lately."""

    def __init__(self, of: Callable, kept: int = 300_000):
        super().__init__()
        self.of, self.kept, self.older = of, kept, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.of(key)
        if len(key) <= 64:
            if len(self) >= self.kept:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value
