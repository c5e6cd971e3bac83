"""Every registered query: Spark result == DuckDB oracle on sf0.001 (rows-only where no oracle)."""

import math

import duckdb
import pytest

import __spark_entry__ as entry

BASE = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{BASE}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["label", "n_reviews"] and df.count() > 0


def test_every_query_has_an_oracle_or_is_iterative():
    # The corpus operators say in their own tests which of them SQL can express.
    rows_only = {q for q in set(QUERIES) - set(ORACLES) if not q.startswith("op") and q != "pipeline"}
    assert rows_only <= {"word2vec_vectors", "kmeans_clusters", "tfidf_hashing",
                         "sentiment_metrics", "sentiment_scores", "recommend_cosine", "recommend_saved_model"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    sdf = QUERIES[name](spark, BASE)
    srows = sdf.collect()
    if name not in ORACLES:
        assert len(srows) > 0
        return
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(sdf.columns)
    key = sorted(cols)
    a = sorted((tuple(_norm(r[c]) for c in key) for r in srows), key=repr)
    b = sorted((tuple(_norm(dict(zip(cols, r))[c]) for c in key) for r in cur.fetchall()), key=repr)
    assert a == b
