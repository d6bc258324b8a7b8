"""Rules as data, counted in the scan that writes a table: what breaks them, and whether the table may stay.

A rule is a condition that a row breaks. All rules of a table are counted by ``DataFrame.observe`` right before the
write, in the tasks that write, so no second scan is needed and a task that is repeated counts once. Beside each count
stand the smallest and the largest key that broke the rule: a sample that stays as small however many rows do.
"""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from racelab.sources.shared import removed, renamed


class Rule(NamedTuple):
    """What is wrong with a row that meets ``breach``; a hard rule stops publication, any other informs."""

    name: str
    breach: str
    hard: bool = True

    def column(self) -> Column:
        """A condition that can't be decided isn't met."""
        return F.coalesce(F.expr(self.breach), F.lit(False))


class Finding(NamedTuple):
    name: str
    hard: bool
    value: int
    first: object
    last: object


def measures(rules: list[Rule], key: str) -> list[Column]:
    """Of each rule: how many rows break it, and the smallest and largest of their keys."""
    out = []
    for r in rules:
        broken = F.when(r.column(), F.col(key))
        out += [F.count_if(r.column()).alias(f"{r.name}_n"), F.min(broken).alias(f"{r.name}_first"), F.max(broken).alias(f"{r.name}_last")]
    return out


def findings(rows: DataFrame, rules: list[Rule], key: str) -> DataFrame:
    """(name, hard, value, first, last) of each rule: one aggregate for all, then a row for each."""
    each = [F.struct(F.lit(r.name).alias("name"), F.lit(r.hard).alias("hard"), F.col(f"{r.name}_n").alias("value"), F.col(f"{r.name}_first").alias("first"), F.col(f"{r.name}_last").alias("last")) for r in rules]
    return rows.agg(*measures(rules, key)).select(F.inline(F.array(*each)))


def publish(rows: DataFrame, folder: str, rules: list[Rule], key: str, kept: list[str] | None = None) -> list[Finding]:
    """Writes ``rows`` as Parquet to ``folder`` and returns what broke the rules; where a hard one is broken, nothing stays.

    Rows go to a folder beside, which takes the place of ``folder`` as a whole once all rules are counted. ``kept`` are
    the columns that are written, all by default; rules may ask for others.
    """
    seen = Observation(f"rules-{uuid.uuid4().hex}")
    observed = rows.observe(seen, F.count("*").alias("rows"), *measures(rules, key))
    beside = f"{folder.rstrip('/')}.{uuid.uuid4().hex}"
    columns = kept or rows.columns
    try:
        # the observed columns have to reach the observation, so they are dropped behind it
        observed.select(*columns).write.parquet(beside)
        got = seen.get
        found = [Finding(r.name, r.hard, got[f"{r.name}_n"], got[f"{r.name}_first"], got[f"{r.name}_last"]) for r in rules]
        broken = [f"{f.name}: {f.value} rows, keys {f.first} to {f.last}" for f in found if f.hard and f.value]
        if broken:
            raise ValueError(f"not published: {'; '.join(broken)}")
        renamed(rows.sparkSession, beside, folder)
        return found
    except Exception:
        removed(rows.sparkSession, beside)
        raise
