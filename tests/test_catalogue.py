"""Every query with SQL against DuckDB on the smallest tables; the plans' promises."""

import os

import duckdb
import pytest

from corpusloom.plans import catalogue, jobqueries, roundtrips  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in os.listdir(SF):
        c.execute(f"CREATE VIEW {t.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{t}'")
    return c


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_equals_sql(spark, db, name):
    mine = catalogue.QUERIES[name](spark, SF)
    rows = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in rows.description]
    assert sorted(mine.columns) == sorted(names)
    got = sorted(repr(tuple(r)) for r in mine.select(*names).collect())
    assert got == sorted(repr(r) for r in rows.fetchall())


def test_queries_without_sql_run(spark):
    for name in set(catalogue.QUERIES) - set(catalogue.ORACLES):
        assert catalogue.QUERIES[name](spark, SF).count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    p = plan(catalogue.QUERIES["english_only"](spark, SF))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p and "ReadSchema: struct<doc_id:bigint,lang:string>" in p


def test_dedup_shuffles_no_text(spark):
    from corpusloom.operators.dedup import chunk_hashes
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    p = plan(chunk_hashes(docs, F.col("doc_id"), F.col("text"), 512).groupBy("hash").agg(F.min(F.struct("key", "place"))))
    exchange = next(line for line in p.splitlines() if "Exchange hashpartitioning(hash" in line)
    assert "text" not in exchange


def test_antijoin_joins_on_a_key(spark):
    p = plan(catalogue.QUERIES["decontam_antijoin"](spark, SF))
    assert "BroadcastHashJoin" in p and "NestedLoop" not in p and "Cartesian" not in p


def test_optional_parts_are_left_out_if_something_is_missing(monkeypatch):
    """Whether the parts themselves or a package that they need can't be imported, the core's queries stay."""
    import __spark_entry__ as entry

    for missing in ("corpusloom.llm", "numpy"):

        def fails(name, missing=missing):
            raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)

        monkeypatch.setattr(entry, "import_module", fails)
        assert set(entry.queries()) == set(catalogue.QUERIES) and set(entry.oracle_sql()) == set(catalogue.ORACLES)
