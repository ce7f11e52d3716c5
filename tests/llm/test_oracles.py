from __future__ import annotations

import duckdb
import pytest
from compare import compare
from llm.samples import SF

from niaga.llm import queries


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_duckdb(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    assert compare(queries.queries()[name](spark, SF), con, queries.oracle_sql()[name]) is None
