"""Queries with oracle SQL against DuckDB, on the smallest tables."""

import duckdb
import pytest

from topicsieve.llm.oracles import ORACLES
from topicsieve.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    found = QUERIES[name](spark, SF)
    connection = duckdb.connect()
    for table in ("documents", "conversations"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    wanted = connection.sql(ORACLES[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    rows = [tuple(r[c] for c in columns) for r in found.collect()]
    assert sorted(rows) == sorted(wanted.select(*columns).fetchall())


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
