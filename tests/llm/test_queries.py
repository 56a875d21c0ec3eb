"""The registered queries against their SQL, and what the entry file offers."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from duesight.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.conftest import SMALL


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SMALL}/{table}.parquet')")
    result = connection.execute(ORACLE_SQL[name])
    columns = [c[0] for c in result.description]
    want = sorted(map(tuple, result.fetchall()), key=str)
    frame = QUERIES[name](spark, SMALL)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(map(tuple, frame.select(*columns).collect()), key=str) == want


def test_every_operator_is_registered():
    names = contract.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in names and set(ORACLE_SQL) <= set(contract.oracle_sql())
