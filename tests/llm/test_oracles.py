"""Corpus queries with an oracle against DuckDB, each over whole tables."""

from __future__ import annotations

import duckdb
import pytest

from clickpath.llm.catalog import QUERIES
from clickpath.llm.oracles import ORACLE_SQL
from tests.conftest import SF001, SF01


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
@pytest.mark.parametrize("folder", [SF001, SF01])
def test_query_matches_oracle(spark, name, folder):
    with duckdb.connect() as con:
        for t in ("documents", "benchmark", "pages", "embeddings"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
        rel = con.sql(ORACLE_SQL[name])
        columns, want = rel.columns, rel.fetchall()
    got = QUERIES[name](spark, folder).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
