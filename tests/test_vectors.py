"""Vector maths and exact / two-level search against numpy brute force."""

import contextlib
import io

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.functions import vectors as vx
from reviewlake.operators import sparse_topn, topk, two_level
from reviewlake.plans import recommend


def _vec_df(spark, mat, id_col="id"):
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(mat)],
                                 f"{id_col} long, vec array<double>")


def test_unit_dot_cosine(spark):
    df = spark.createDataFrame([(0, [3.0, 4.0], [1.0, 0.0]), (1, [0.0, 0.0], [1.0, 1.0])],
                               "id long, a array<double>, b array<double>")
    r = {x["id"]: x for x in df.select("id", vx.unit("a").alias("u"), vx.dot("a", "b").alias("d"),
                                        vx.cosine("a", "b").alias("c"), vx.sq_l2("a", "b").alias("l")).collect()}
    assert r[0]["u"] == [0.6, 0.8] and r[0]["d"] == 3.0 and abs(r[0]["c"] - 0.6) < 1e-12 and r[0]["l"] == 20.0
    assert r[1]["u"] == [0.0, 0.0] and r[1]["c"] is None          # zero vector stays zero, cosine undefined
    twice = df.select(vx.unit(vx.unit("a")).alias("u")).collect()[0]["u"]
    assert np.allclose(twice, [0.6, 0.8])


def test_knn_matches_brute_force(spark):
    rnd = np.random.default_rng(3)
    mat = rnd.normal(size=(300, 8))
    mat[5] = mat[9]                   # identical vectors -> tie broken by id
    mat[11] = 0.0                     # zero vector
    v = _vec_df(spark, mat)
    got = topk.knn(v, v, 7, metric="l2", block_rows=64).collect()
    d = ((mat[:, None, :] - mat[None, :, :]) ** 2).sum(-1)
    for q in range(300):
        exp = sorted(range(300), key=lambda j: (round(d[q, j], 9), j))[:7]
        have = [r["id"] for r in sorted([r for r in got if r["qid"] == q], key=lambda r: r["rank"])]
        assert have == exp
    self_hits = [r for r in got if r["qid"] == r["id"]]
    assert all(abs(r["score"]) < 1e-9 for r in self_hits)
    five = [r["id"] for r in sorted([r for r in got if r["qid"] == 5], key=lambda r: r["rank"])][:2]
    assert five == [5, 9]


def test_cosine_topk(spark):
    rnd = np.random.default_rng(5)
    mat = rnd.normal(size=(120, 6))
    v = _vec_df(spark, mat)
    got = topk.knn(v, v, 3, metric="cosine", block_rows=50).collect()
    n = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    c = n @ n.T
    for q in (0, 17, 119):
        exp = sorted(range(120), key=lambda j: (-round(c[q, j], 9), j))[:3]
        have = [r["id"] for r in sorted([r for r in got if r["qid"] == q], key=lambda r: r["rank"])]
        assert have == exp


def _nearest(mat, q, k):
    d = ((mat - mat[q]) ** 2).sum(-1)
    return sorted(range(len(mat)), key=lambda j: (round(d[j], 9), j))[:k]


@pytest.mark.parametrize("kind", ["clustered", "even", "one hot cluster", "equal"])
def test_two_level_search_is_exact(spark, kind):
    rnd = np.random.default_rng(11)
    mat = {"clustered": np.concatenate([c + 0.2 * rnd.normal(size=(150, 16)) for c in rnd.normal(size=(8, 16)) * 4]),
           "even": rnd.normal(size=(1200, 16)),
           "one hot cluster": np.concatenate([rnd.normal(size=(800, 16)) * 0.01, rnd.normal(size=(400, 16)) * 3]),
           "equal": np.repeat(rnd.normal(size=(4, 16)), 300, axis=0)}[kind]
    mat = mat / np.linalg.norm(mat, axis=1, keepdims=True) if kind == "even" else mat
    v = _vec_df(spark, mat).repartition(4)
    got = recommend.search_two_level(v, v.where("id % 50 = 7"), 10, n_clusters=12).collect()
    assert len(got) == 24 * 10
    for q in range(7, len(mat), 50):
        own = sorted((r for r in got if r.qid == q), key=lambda r: r["rank"])
        assert [r.id for r in own] == _nearest(mat, q, 10)
        assert all(10 <= r.scanned <= len(mat) for r in own)
    if kind == "clustered":                                    # and it does pass over far clusters
        assert max(r.scanned for r in got) < len(mat) / 2


def test_two_level_search_in_batches_and_odd_rows(spark):
    rnd = np.random.default_rng(2)
    mat = rnd.normal(size=(90, 4))
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0]), (902, [float("nan"), 0.0, 0.0, 0.0]), (903, [float("inf"), 0.0, 0.0, 0.0])]
    v = _vec_df(spark, mat).unionByName(spark.createDataFrame(odd, "id long, vec array<double>"))
    index = two_level.build(v, fit_rows=40)
    asked = v.select(F.col("id").alias("qid"), "vec")
    got = two_level.search(index, asked, 100, batch_bytes=8 * 30 * sum(index.centres.shape)).collect()
    assert index.rows.count() == 90 and len(got) == 90 * 90                # k above the number of vectors: all of them
    for q in (0, 41, 89):
        assert [r.id for r in sorted((r for r in got if r.qid == q), key=lambda r: r["rank"])] == _nearest(mat, q, 100)
    none = v.where("id < 0")
    assert two_level.search(index, none.withColumnRenamed("id", "qid"), 3).count() == 0
    assert two_level.search(two_level.build(none), asked, 3).count() == 0


def test_query_batches_give_the_same_rows(spark):
    rnd = np.random.default_rng(4)
    v = _vec_df(spark, rnd.normal(size=(200, 8)))
    q = v.select(F.col("id").alias("qid"), "vec")
    for metric in ("l2", "cosine", "dot"):
        one, many = (sorted(map(tuple, topk.knn_batch(v, q, 5, metric, max_bytes=m).collect())) for m in (1 << 20, 8 * 8 * 50))
        assert one == many and len(one) == 1000


def test_search_of_many_blocks_and_equal_vectors(spark, monkeypatch):
    """More blocks than the grid has at first, copies of a vector, ids that repeat or are null, rows without a vector."""
    rnd = np.random.default_rng(8)
    mat = rnd.normal(size=(260, 6))
    mat[100:180] = mat[7]                                        # 81 copies: more than k
    mat[200] = 0.0
    monkeypatch.setattr(topk, "BLOCK_VALUES", 30 * 6)
    v = _vec_df(spark, mat).unionByName(spark.createDataFrame(
        [(900, None), (901, [float("nan")] * 6), (902, [1.0, None, 0.0, 0.0, 0.0, 0.0])], "id long, vec array<double>"))
    for metric in ("l2", "cosine", "dot"):
        got = topk.knn(v, v, 5, metric, block_rows=20).collect()
        if metric == "l2":
            s = ((mat[:, None, :] - mat[None, :, :]) ** 2).sum(-1)
        else:
            n = np.linalg.norm(mat, axis=1, keepdims=True) if metric == "cosine" else 1.0
            with np.errstate(invalid="ignore"):
                u = mat / n
            s = -(u @ u.T)
        want = set()
        for q in range(260):
            order = sorted((j for j in range(260) if np.isfinite(s[q, j])), key=lambda j: (round(s[q, j], 9), j))[:5]
            want |= {(q, j, i + 1) for i, j in enumerate(order)}
        assert {(r.qid, r.id, r["rank"]) for r in got} == want and len(got) == len(want)


def test_search_copies_no_row_into_more_blocks_than_the_grid_has(spark):
    """Before, every vector went to every block of 2048 queries, so shuffled bytes grew with the square of the rows."""
    assert topk.GRID_QUERIES <= 16 and topk.GRID <= 32
    v = _vec_df(spark, np.random.default_rng(9).normal(size=(1500, 4)))
    written = []
    keep = topk.cut_lineage
    topk.cut_lineage = lambda df, name: written.append((name, keep(df, name))) or written[-1][1]
    try:
        assert topk.knn(v, v, 3, block_rows=10).count() == 4500
    finally:
        topk.cut_lineage = keep
    grid = dict(written)["knn-grid"].first()
    assert (grid["_bq"], grid["_bv"]) == (16, 2)


def test_scores_of_far_and_large_vectors(spark):
    """Single precision only filters: lengths that differ by many orders and near ties come out in exact order."""
    rnd = np.random.default_rng(10)
    mat = np.concatenate([rnd.normal(size=(40, 3)) * 1e-4, rnd.normal(size=(40, 3)), 3 + rnd.normal(size=(40, 3)) * 1e-7, rnd.normal(size=(4, 3)) * 1e18])
    v = _vec_df(spark, mat)
    got = topk.knn(v, v, 6).collect()
    with np.errstate(over="ignore"):
        d = ((mat[:, None, :] - mat[None, :, :]) ** 2).sum(-1)
    for q in range(len(mat)):
        have = [r.id for r in sorted((r for r in got if r.qid == q), key=lambda r: r["rank"])]
        assert have == sorted(range(len(mat)), key=lambda j: (round(d[q, j], 9), j))[:6]


def test_top_similar_matches_pairs(spark):
    w = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (3, "b", 1.0), (3, "c", 5.0),
                               (4, "c", 1.0), (5, "z", 0.0), (6, "z", 3.0)], "id long, term string, weight double")
    got = sparse_topn.top_similar(w, "id", 2).collect()
    best = {(r["id1"], r["rank"]): (r["id2"], r["score"]) for r in got}
    assert best[(1, 1)] == (3, 2.0) and best[(1, 2)] == (2, 1.0)
    assert best[(3, 1)] == (4, 5.0)
    assert best[(5, 1)] == (6, 0.0)          # shares a zero-weight term: listed with score 0
    assert (2, 2) not in best                 # 2 shares a term with 1 only


@pytest.mark.parametrize("part_rows", [7, sparse_topn.PART_ROWS])
def test_sparse_top_n_equals_all_pairs(spark, part_rows):
    """Skewed postings (one term in every row, a few in half of them) with ties, against all dot products."""
    rnd = np.random.default_rng(6)
    n, terms = 160, 60
    m = np.where(rnd.random((n, terms)) < np.linspace(0.5, 0.01, terms), rnd.integers(1, 9, (n, terms)) / 4, 0.0)
    m *= np.linspace(0.1, 2, terms)
    m[:, 0] = 0.05
    m[30] = m[31] = m[32]
    m[40] = 0                                                   # a row without terms
    rows = [(int(i), f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)] + [(7, "nil", 0.0), (8, "nil", 0.0)]
    w = spark.createDataFrame(rows, "id long, term string, weight double").repartition(5)
    asked = spark.range(n).where("id % 3 = 0")
    holds = m > 0
    shares = (holds.astype(int) @ holds.T.astype(int)) > 0
    shares[7, 8] = shares[8, 7] = True
    dot = m @ m.T
    for queries, which in ((asked, range(0, n, 3)), (None, range(n))):
        got = sorted(map(tuple, sparse_topn.top_similar(w, "id", 5, queries, part_rows).select("id1", "rank", "id2").collect()))
        want = [(q, r + 1, j) for q in which for r, j in enumerate(
            sorted((j for j in range(n) if j != q and shares[q, j]), key=lambda j: (-round(dot[q, j], 9), j))[:5])]
        assert got == want


@pytest.mark.parametrize("small", [40, 1 << 20])
def test_sparse_top_n_by_blocks_equals_all_pairs(spark, monkeypatch, small):
    """Few kinds of rows, so that most pairs share terms and tie: before, every such pair was written."""
    rnd = np.random.default_rng(12)
    n = 150
    rows = [(i, t, float(x)) for i in range(n) for t, x in (("all", 0.0), (f"a{i % 4}", 1.5), (f"b{rnd.integers(5)}", 0.25 + i % 2))]
    rows += [(None, "a1", 9.0), (3, "one", 2.0), (5, "one", 1.0), (5, "one", 0.5), (6, "alone", 3.0)]
    w = spark.createDataFrame(rows, "id long, term string, weight double").repartition(4)
    m = np.zeros((n, 16))
    names: dict[str, int] = {}
    for i, t, x in rows:
        if i is not None:
            m[i, names.setdefault(t, len(names))] += x
    monkeypatch.setattr(sparse_topn, "FEW_PAIRS", 0)
    monkeypatch.setattr(sparse_topn, "PAIRS_PER_POSTING", 0)
    monkeypatch.setattr(sparse_topn, "SMALL_POSTINGS", small)
    written = []
    keep = sparse_topn.cut_lineage
    monkeypatch.setattr(sparse_topn, "cut_lineage", lambda df, name: written.append(name) or keep(df, name))
    dot = m @ m.T
    for queries, which in ((spark.range(n).where("id % 7 = 0"), range(0, n, 7)), (None, range(n))):
        for k in (4, n + 5):
            got = sorted(map(tuple, sparse_topn.top_similar(w, "id", k, queries).select("id1", "rank", "id2").collect()))
            assert got == [(q, r + 1, j) for q in which for r, j in enumerate(
                sorted((j for j in range(n) if j != q), key=lambda j: (-round(dot[q, j], 9), j))[:k])]
    assert "candidates" not in written


def test_rows_of_equal_weights_meet_as_one(spark, monkeypatch):
    """Before, every row added up the postings of all rows, also of those that are alike."""
    rows = [(i, t, x) for i in range(400) for t, x in ((f"a{i % 3}", 1.5), (f"b{i % 5}", 0.25), ("all", 0.5))]
    w = spark.createDataFrame(rows, "id long, term string, weight double").repartition(4)
    monkeypatch.setattr(sparse_topn, "FEW_PAIRS", 0)
    monkeypatch.setattr(sparse_topn, "PAIRS_PER_POSTING", 0)
    written, keep = {}, sparse_topn.cut_lineage
    monkeypatch.setattr(sparse_topn, "cut_lineage", lambda df, name: written.setdefault(name, keep(df, name)))
    got = sorted(map(tuple, sparse_topn.top_similar(w, "id", 4).select("id1", "rank", "id2").collect()))
    score = [[(i % 3 == j % 3) * 2.25 + (i % 5 == j % 5) * 0.0625 for j in range(15)] for i in range(15)]
    assert got == [(i, r + 1, j) for i in range(400) for r, j in enumerate(
        sorted((j for j in range(400) if j != i), key=lambda j, i=i: (-score[i % 15][j % 15], j))[:4])]
    assert written["classes"].count() == 15 * 3


def test_long_lists_are_looked_up_once_the_best_are_found(monkeypatch):
    """Before, a query added up all its postings, and read a score of every row."""
    rnd = np.random.default_rng(3)
    n = 4000
    rows = {(i, int(t)): float(x) for i in range(n) for t, x in [(0, 0.01 * (1 + i % 7)), (1 + rnd.integers(3), 0.3),
            *((10 + (i + k * 97) % 250, 2.0 + rnd.integers(5)) for k in range(2))]}
    posted = tuple(np.array(x) for x in zip(*((i, t, x) for (i, t), x in rows.items()), strict=True))
    asked = tuple(x[posted[0] % 41 == 0] for x in posted)
    found, keep = [], sparse_topn._best_rows
    monkeypatch.setattr(sparse_topn, "_best_rows", lambda *x: found.append(keep(*x)) or found[-1])
    m = np.zeros((n, 260))
    for (i, t), x in rows.items():
        m[i, t] = x
    seen = 0
    for own, ids, scores in sparse_topn.block_best(asked, posted, 5):
        dot = m @ m[own]
        want = sorted(np.flatnonzero(dot), key=lambda j, dot=dot: (-round(dot[j], 9), j))[:5]
        assert ids.tolist() == want and np.allclose(scores, dot[want])
        seen += 1
    assert seen == len(range(0, n, 41)) and sum(len(x[0]) for x in found) < seen * n / 100


def test_documents_in_blocks_equal_rows_of_postings(spark, monkeypatch):
    """Before, all postings were shuffled by term and by id, and copied for every block of queries."""
    from reviewlake.operators import term_blocks
    rnd = np.random.default_rng(8)
    rows = [(i, ["every", *(f"w{x}" for x in rnd.zipf(1.4, int(rnd.integers(3, 40))) % 500)]) for i in range(300)]
    rows += [(300, []), (301, None), (302, ["every"]), (303, ["every", None, ""]), (None, ["every", "w1"]), (304, ["é", "w1", "w1"]),
             (350, ["every"]), (351, ["none"])]
    docs = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(3)
    monkeypatch.setattr(recommend, "PACKED_ROWS", 10)
    monkeypatch.setattr(term_blocks, "BLOCK_TOKENS", 500)
    monkeypatch.setattr(term_blocks, "BATCH", 7)
    monkeypatch.setattr(term_blocks, "ASKED_POSTINGS", 300)
    for queries in (spark.range(400).where("id % 50 = 0"), None):
        got = []
        for packed in (False, True):
            w = recommend.unit_weights(recommend.tfidf_terms(docs, "id", "tokens", packed=packed), "id")
            assert isinstance(w, term_blocks.TermBlocks) == packed
            found = sparse_topn.top_similar(w, "id", 6, queries).select("id1", "rank", "id2", F.round("score", 6).alias("score"))
            got.append(sorted(map(tuple, found.collect())))
        assert got[0] == got[1] and len(got[0]) > 30
    twice = docs.unionByName(docs.where("id = 3"))
    assert isinstance(recommend.tfidf_terms(twice, "id", "tokens", packed=True), type(twice))


def test_common_terms_are_passed_over(spark):
    """A term that every row has makes no candidates once rarer terms fill the n best."""
    rows = [(i, "all", 0.01) for i in range(3000)] + [(i, f"g{i // 20}", 1.0) for i in range(3000)]
    w = spark.createDataFrame(rows, "id long, term string, weight double")
    written = []
    keep = sparse_topn.cut_lineage
    sparse_topn.cut_lineage = lambda df, name: written.append((name, keep(df, name))) or written[-1][1]
    try:
        got = sparse_topn.top_similar(w, "id", 5).count()
    finally:
        sparse_topn.cut_lineage = keep
    assert got == 15_000 and dict(written)["candidates"].count() == 3000 * 19


def test_unit_in_sql_plan_has_no_python(spark):
    df = spark.range(3).select(F.array(F.col("id").cast("double"), F.lit(1.0)).alias("v"))
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.select(vx.unit("v")).explain()
    assert "Python" not in buf.getvalue() and "WholeStageCodegen" in buf.getvalue() or "*(" in buf.getvalue()


def test_ml_feature_pipelines(spark):
    from pyspark.ml.functions import vector_to_array
    docs = spark.createDataFrame([(i, ["a", "b", "c", str(i % 5), "the"]) for i in range(40)],
                                 "id long, tokens array<string>")
    out = recommend.tfidf_counts(docs, "tokens", ["the"], k=3)
    assert out.select(F.size(vector_to_array("pca_features"))).first()[0] == 3
    hashed = recommend.tfidf_vectors(docs, "tokens")
    assert hashed.count() == 40
    asm = recommend.assemble(hashed, ["features"])
    assert "features_vec" in asm.columns
    rm = recommend.stopwords_remover(["THE"]).transform(docs)
    assert "the" not in rm.first()["filtered"]


def test_sentiment_training_is_deterministic(spark):
    from reviewlake.operators import filters
    from reviewlake.plans import sentiment, standins
    from reviewlake.sources.tables import table
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    prep = filters.known_labels(sentiment.prepare_reviews(standins.reviews(docs))).persist()
    _m1, _w1, met1 = sentiment.train_sentiment(prep, tree_counts=(5,), num_partitions=1)
    _m2, _w2, met2 = sentiment.train_sentiment(prep, tree_counts=(5,), num_partitions=1)
    a, b = met1.collect()[0], met2.collect()[0]
    assert a == b
    assert 0.0 <= a["accuracy"] <= 1.0 and abs(a["error"] - (1 - a["accuracy"])) < 1e-12
    prep.unpersist()


def test_spread_only_on_request(spark):
    from reviewlake.session import SPREAD_CONF, spread
    rows, asked = spark.range(0, 1000, numPartitions=1), spark.conf.get(SPREAD_CONF)
    try:
        spark.conf.unset(SPREAD_CONF)
        assert spread(rows) is rows
        spark.conf.set(SPREAD_CONF, "5")
        assert spread(rows, "id").rdd.getNumPartitions() == 5
    finally:
        spark.conf.set(SPREAD_CONF, asked)
