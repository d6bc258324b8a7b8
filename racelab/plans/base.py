"""The race data that queries read, built on demand."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelab.operators import observations as ob
from racelab.sources import fixtures as fx


class Data:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    def table(self, name: str) -> DataFrame:
        return fx.table(self.spark, self.sf, name)

    @cached_property
    def most(self) -> int:
        """As many results as a race can have at most: the rows of the table, which its files' footers tell."""
        return self.table("orders").count()

    @cached_property
    def timed(self) -> DataFrame:
        """Results with the seconds at checkpoints."""
        return fx.timed_results(self.spark, self.sf)

    @cached_property
    def results(self) -> DataFrame:
        return fx.results(self.spark, self.sf)

    @cached_property
    def placed(self) -> DataFrame:
        return fx.placed(self.results, ["overall_place", "gender_place", "class_place"], self.most)

    @cached_property
    def races(self) -> DataFrame:
        return fx.races(self.results)

    @cached_property
    def checkpoints(self) -> DataFrame:
        return fx.checkpoints(fx.race_keys(self.spark, self.sf))

    @cached_property
    def splits(self) -> DataFrame:
        return fx.splits(fx.placed(self.timed, ["place_1", "place_2"], self.most))

    @cached_property
    def laid(self) -> DataFrame:
        """Results with their observations in the row."""
        placed = fx.placed(self.timed, list(fx.PLACES), self.most).withColumn("passages", fx.passages())
        return ob.laid_out(placed.drop("elapsed_1", "elapsed_2", "place_1", "place_2"), self.checkpoints)

    @cached_property
    def obs(self) -> DataFrame:
        return ob.observations(self.laid)

    @cached_property
    def segments(self) -> DataFrame:
        return ob.segments(self.laid)

    @cached_property
    def complete(self) -> DataFrame:
        return ob.of_complete_cohort(self.laid).select("rid")

    @cached_property
    def cohort_segments(self) -> DataFrame:
        """Segments of results that were seen at every boundary."""
        return ob.segments(ob.of_complete_cohort(self.laid))

    @cached_property
    def courses(self) -> DataFrame:
        return fx.courses(self.results)

    @cached_property
    def points(self) -> DataFrame:
        return fx.route_points(self.spark, self.sf)

    @cached_property
    def landmarks(self) -> DataFrame:
        return fx.landmarks(self.spark, self.sf)


class Book:
    """The queries of a module and the SQL that checks them."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def query(self, sql: str | None = None, rounded: str = ""):
        """Registers the decorated function of a :class:`Data` under its name.

        Columns named in ``rounded`` are rounded to six places on both sides: interpolation differs in the last bits.
        """
        columns = rounded.split()

        def add(f: Callable[[Data], DataFrame]):
            self.queries[f.__name__] = lambda spark, sf: f(Data(spark, sf)).withColumns({c: F.round(c, 6) for c in columns})
            if sql:
                cut = ", ".join(f"round({c}, 6) AS {c}" for c in columns)
                self.sql[f.__name__] = fx.oracle(f"SELECT * REPLACE ({cut}) FROM ({sql})" if columns else sql)
            return f

        return add
