"""The registered SQL against the queries, on the smallest tables."""

import duckdb
import pytest

from tonality.llm.catalog import QUERIES
from tonality.llm.oracle import ORACLE_SQL

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    found = con.execute(ORACLE_SQL[name])
    columns = [d[0] for d in found.description]
    assert sorted(columns) == sorted(df.columns)
    assert sorted(map(str, found.fetchall())) == sorted(str(tuple(r)) for r in df.select(*columns).collect())
