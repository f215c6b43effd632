"""Every registered query against its SQL, on whole tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from weirflow.plans.catalog import all_oracles, all_queries

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def database(sf):
    connection = duckdb.connect()
    for file in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def content(frame):
    columns = sorted(frame.columns)
    return columns, sorted(tuple(map(str, r)) for r in frame[columns].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf, database, name):
    assert content(QUERIES[name](spark, sf).toPandas()) == content(
        database.execute(ORACLES[name]).df()
    )


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
