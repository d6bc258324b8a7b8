"""Every registered query of the race operators against its DuckDB SQL."""

import math
import os

import duckdb
import pytest

from racelab import registry

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else round(float(v), 6) if type(v).__name__ == "Decimal" else v


def ordered(rows):
    return sorted((tuple(map(plain, r)) for r in rows), key=lambda r: [(x is None, f"{x:030.6f}" if isinstance(x, int | float) else str(x)) for x in r])


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    frame = registry.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    rows = [tuple(r[c] for c in columns) for r in frame.collect()]
    if name not in registry.oracle_sql():
        assert rows
        return
    cursor = duck.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == columns
    assert ordered(rows) == ordered([tuple(r[names.index(c)] for c in columns) for r in cursor.fetchall()])
