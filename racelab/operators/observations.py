"""Observations at checkpoints, segments between them and the cohort that passed them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finished() -> Column:
    return (F.col("status") == "FINISHED") & (F.col("finish_seconds") > 0)


def starter() -> Column:
    return F.col("status").isin("FINISHED", "DNF", "DSQ")


def with_passages(results: DataFrame, splits: DataFrame) -> DataFrame:
    """Results with their few ``passages`` in the row: one shuffle by rid."""
    each = splits.groupBy("rid").agg(F.collect_list(F.struct("cp_key", "elapsed_seconds", "place_overall")).alias("passages"))
    return results.join(each, "rid", "left")


def laid_out(results: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Results with ``passages`` and ``overall_place``: these become ``observed``, the row's observations by boundary.

    An observation has seconds and place, null where none was published. The start is 0 unless the result is DNS or
    UNKNOWN; the finish is known of finishers only; nothing is interpolated. A race's boundaries are few, so they and
    all that follows of them stay in the result's row.
    """
    catalog = checkpoints.groupBy("race_key").agg(F.array_sort(F.collect_list(F.struct("seq", "cp_key", "km"))).alias("boundaries"))

    def observation(b: Column) -> Column:
        seen = lambda c: F.get(F.filter("passages", lambda p: p["cp_key"] == b["cp_key"]), F.lit(0))[c]
        seconds = (
            F.when(b["cp_key"] == "start", F.when(~F.col("status").isin("DNS", "UNKNOWN"), F.lit(0.0)))
            .when(b["cp_key"] == "finish", F.when(finished(), F.col("finish_seconds")))
            .otherwise(seen("elapsed_seconds"))
        )
        place = F.when(b["cp_key"] == "finish", F.col("overall_place")).otherwise(seen("place_overall"))
        return F.struct(b["cp_key"].alias("cp_key"), b["seq"].alias("seq"), b["km"].alias("km"), seconds.alias("seconds"), place.alias("place"))

    kept = [c for c in results.columns if c != "passages"]
    return results.join(catalog, "race_key").select(*kept, F.transform("boundaries", observation).alias("observed"))


def observations(laid: DataFrame) -> DataFrame:
    """One row for each result and boundary: cp_key, seq, km, seconds, place."""
    return laid.select(*(c for c in laid.columns if c != "observed"), F.inline("observed"))


def segments(laid: DataFrame) -> DataFrame:
    """Between consecutive boundaries: seconds if positive, km, pace and places gained."""
    o = F.col("observed")
    pairs = F.transform(F.slice(o, 1, F.greatest(F.size(o) - 1, F.lit(0))), lambda x, i: F.struct(x.alias("a"), F.get(o, i + 1).alias("b")))
    kept = [c for c in laid.columns if c != "observed"]
    x = laid.select(*kept, F.inline(pairs))
    took, km = F.col("b.seconds") - F.col("a.seconds"), F.col("b.km") - F.col("a.km")
    return x.select(
        *kept, F.col("a.seq").alias("seg_no"), F.col("a.cp_key").alias("from_key"), F.col("b.cp_key").alias("to_key"),
        F.when(took > 0, took).alias("seconds"), km.alias("km"), F.when(took > 0, took / km).alias("pace"),
        (F.col("a.place") - F.col("b.place")).alias("gain"), F.col("b.seconds").alias("elapsed"), F.col("b.place").alias("to_place"),
    )


def of_complete_cohort(laid: DataFrame) -> DataFrame:
    """Finishers seen at every boundary of their own race."""
    return laid.where(finished() & F.forall("observed", lambda x: x["seconds"].isNotNull()))


def at_least(n: int, value: Column, count: Column | str = "n") -> Column:
    """``value`` where enough rows stand behind it, else null."""
    return F.when((F.col(count) if isinstance(count, str) else count) >= n, value)
