"""The SQL of the queries of this subpackage, in DuckDB on the tables of the correctness gate."""

import os

import duckdb
import pytest

from corpusloom.llm import registry

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_equals_sql(spark, name):
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    rows = c.execute(registry.ORACLES[name])
    names = [d[0] for d in rows.description]
    mine = registry.QUERIES[name](spark, SF)
    assert sorted(mine.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, mine.select(*names).collect()))) == sorted(map(repr, rows.fetchall()))
