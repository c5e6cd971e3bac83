import duckdb
import pytest

from reviewlake.llm.queries import LLM_ORACLES, LLM_QUERIES

BASE = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    expected = con.execute(LLM_ORACLES[name])
    columns = [c[0] for c in expected.description]
    got = LLM_QUERIES[name](spark, BASE)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(expected.fetchall())
