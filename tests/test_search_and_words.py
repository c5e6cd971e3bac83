"""Products by texts, draws with replacement, learned compounds: against plain Python."""

import collections
import hashlib
import itertools
import random

import pytest
from pyspark.sql import functions as F

from reviewlake.operators import filters, sampling, segment


def test_products_of_texts(spark):
    r = random.Random(1)
    names = [(i, "".join(r.choice("abc é💡") for _ in range(r.randint(0, 12)))) for i in range(400)] + [(900, None), (901, "aaaaaaa")]
    texts = [(i, "".join(r.choice("abc é💡") for _ in range(i % 7))) for i in range(120)] + [(500, None), (501, ""), (502, "aaaaaa"), (503, "not there")]
    got = filters.find_products(spark.createDataFrame(names, "id long, name string"),
                                spark.createDataFrame(texts, "qid long, text string"), "name").collect()
    want = {(q, min(i for i, n in names if n is not None and t in n)) for q, t in texts
            if t is not None and any(n is not None and t in n for _, n in names)}
    assert {tuple(x) for x in got} == want and len(got) == len(want)
    none = spark.createDataFrame([], "qid long, text string")
    assert filters.find_products(spark.createDataFrame(names, "id long, name string"), none, "name").count() == 0


def test_products_of_equal_names_are_searched_once(spark):
    """Before, every product of a name was a candidate of every text in it; a repeated product lost its name."""
    names = [(i, ("red box", "blue ring", "hot bolt")[i % 3]) for i in range(300)] + [(1, "blue ring"), (None, "grey cup"), (None, "red box")]
    texts = [(q, ("ring", "ed", "", "cup", "zzz")[q % 5]) for q in range(100)] + [(0, "bolt")]
    written = []
    keep = filters.cut_lineage
    filters.cut_lineage = lambda df, name: written.append((name, keep(df, name))) or written[-1][1]
    try:
        got = filters.find_products(spark.createDataFrame(names, "id long, name string"), spark.createDataFrame(texts, "qid long, text string"), "name")
        got = sorted(map(tuple, got.collect()))
    finally:
        filters.cut_lineage = keep
    assert got == [(q, (1, 0, 0)[q % 5]) for q in range(100) if q % 5 < 3]
    sizes = {name: df.count() for name, df in written}
    assert sizes["product-names"] == 3 and sizes["distinct-texts"] == 6


@pytest.mark.parametrize("draws", [0, 7, 2000])
def test_draws_with_replacement(spark, draws):
    n = 311
    df = spark.range(n).select((F.col("id") * 3).alias("k"), F.lit("keep").alias("other"), F.lit(-1).alias("x")).repartition(6)
    got = {r.k: r.x for r in sampling.random_backfill(df, "k", "x", 5, 9, draws, seed=3).collect()}
    number = lambda i, seed, m: int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:15], 16) % m
    want = {3 * i: -1 for i in range(n)}
    for i in range(draws):
        want[3 * number(i, 3, n)] = 5 + number(i, 4, 5)
    assert got == want
    assert sampling.random_backfill(df.where("k < 0"), "k", "x", 5, 9, draws).count() == 0


def _all_paths(n, spans):
    """Total gain of the best set of spans that don't overlap, by trying every subset."""
    best = 0
    for k in range(len(spans) + 1):
        for some in itertools.combinations(spans, k):
            some = sorted(some)
            if all(a[0] + a[1] <= b[0] for a, b in itertools.pairwise(some)):
                best = max(best, sum(g for _, _, g in some))
    return best


def test_best_path_equals_every_path():
    r = random.Random(4)
    for _ in range(400):
        n = r.randint(0, 9)
        spans = sorted({(s, k, r.randint(1, 6)) for s, k in [(r.randrange(9), r.randint(2, 3)) for _ in range(r.randint(0, 8))] if s + k <= n})
        spans = [next(g) for _, g in itertools.groupby(spans, key=lambda x: x[:2])]         # one gain for each place
        gain = {x[:2]: x[2] for x in spans}
        path = segment.best_path(n, spans)
        assert all(a[0] + a[1] <= b[0] for a, b in itertools.pairwise(path)) and sum(gain[p] for p in path) == _all_paths(n, spans)


def test_learned_compounds_and_segmentation(spark):
    import math
    r = random.Random(7)
    plain = [f"w{i}" for i in range(40)]
    def sentence():
        out = []
        for _ in range(r.randint(3, 25)):
            out += r.choice([[r.choice(plain)], [r.choice(plain)], ["máy", "tính"], ["ba", "lô", "du"]])
        return out
    rows = [(i, sentence()) for i in range(150)] + [(900, None), (901, []), (902, ["", "máy", None, "tính", ""]), (903, ["máy"])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>").repartition(3)
    learned = {x.compound: (x.length, x.n, x.gain) for x in segment.learn(df, "tokens", min_gain=1_000_000).collect()}
    clean = [[w for w in t or [] if w] for _, t in rows]
    one, many = collections.Counter(w for t in clean for w in t), collections.Counter()
    for t in clean:
        for k in (2, 3):
            many.update(tuple(t[i:i + k]) for i in range(len(t) - k + 1))
    total = sum(one.values())
    want = {}
    for c, n in many.items():
        gain = round((math.log(n / total) - sum(math.log(one[w] / total) for w in c)) * 1_000_000)
        if n >= segment.MIN_COUNT and gain >= 1_000_000:
            want["_".join(c)] = (len(c), n, gain)
    assert learned.keys() == want.keys() and {"máy_tính", "ba_lô_du", "ba_lô"} <= learned.keys()
    assert all(abs(learned[c][2] - want[c][2]) <= 1 and learned[c][:2] == want[c][:2] for c in want)
    compounds = spark.createDataFrame([(c, *v) for c, v in want.items()], "compound string, length int, n long, gain long")
    got = {x.id: x.words for x in segment.segment(df, "tokens", compounds).collect()}
    for (i, _), t in zip(rows, clean, strict=True):
        spans = [(s, k, want["_".join(t[s:s + k])][2]) for k in (2, 3) for s in range(len(t) - k + 1) if "_".join(t[s:s + k]) in want]
        words, at = [], 0
        for s, k in segment.best_path(len(t), spans):
            words += [*t[at:s], "_".join(t[s:s + k])]
            at = s + k
        assert got[i] == [*words, *t[at:]]
    assert got[902] == ["máy_tính"] and got[900] == [] and segment.segment(df.where("id < 0"), "tokens", compounds).count() == 0


def test_components_of_sparse_rows(spark):
    """Variance within 1 % of the exact one, scores equal up to sign; a row without terms takes part."""
    import numpy as np

    from reviewlake.operators import sparse_pca
    rnd = np.random.default_rng(3)
    n, terms = 150, 90
    m = np.where(rnd.random((n, terms)) < 0.15, rnd.random((n, terms)), 0.0)
    m[:50, :6] += 2 * rnd.random((50, 1))
    m[60:100, 20:25] += rnd.random((40, 1))
    m[7] = 0
    rows = [(int(i), f"t{j}", float(m[i, j])) for i, j in zip(*np.nonzero(m), strict=True)]
    postings = spark.createDataFrame(rows, "id long, term string, weight double").repartition(4)
    got, variances = sparse_pca.components(spark.range(n), postings, k=5)
    centred = m - m.mean(axis=0)
    u, s, _ = np.linalg.svd(centred, full_matrices=False)
    exact = s[:5] ** 2 / (n - 1)
    assert abs(variances.sum() - exact.sum()) <= 0.01 * exact.sum() and np.all(np.abs(variances - exact) <= 0.05 * exact)
    assert np.all(np.abs(variances - exact)[:2] <= 1e-4 * exact[:2])
    scores = np.array([r.pca_features for r in got.orderBy("id").collect()])
    assert scores.shape == (n, 5)
    for j in range(2):                                          # the planted ones are far apart
        assert abs(abs(np.corrcoef(scores[:, j], u[:, j] * s[j])[0, 1]) - 1) < 1e-3
    none, v = sparse_pca.components(spark.range(0), postings.where("id < 0"), k=5)
    assert none.count() == 0 and len(v) == 0
    few, v = sparse_pca.components(spark.range(3), postings.where("id < 3"), k=50)
    assert len(v) <= 2 and few.count() == 3


def test_pieces_of_words_have_the_runs_of_all_rows(monkeypatch):
    """Rows of many lengths cut into small pieces, and rows that begin in the middle of a buffer."""
    import pyarrow as pa
    rnd = random.Random(3)
    rows = [[rnd.choice("abcd") for _ in range(rnd.choice((0, 1, 2, 9)))] for _ in range(60)]
    monkeypatch.setattr(segment, "PIECE_WORDS", 7)
    column = pa.array([["x"], *rows], pa.list_(pa.string())).slice(1)
    got, numbers = collections.Counter(), []
    for row, words, size in segment._pieces(column):
        numbers.append((row, len(size)))
        assert len(size) == 1 or size.sum() <= 7
        for length, at, compound, which, n in segment._runs(words, size, 3):
            assert len(at) == n.sum() and len(set(compound.to_pylist())) == len(compound)
            got.update(dict(zip([(length, c) for c in compound.to_pylist()], n.tolist())))
            assert [compound[w].as_py() for w in which] == ["_".join(words[a + i].as_py() for i in range(length)) for a in at]
    assert sum(n for _, n in numbers) == 60
    assert got == collections.Counter((k, "_".join(t[i:i + k])) for t in rows for k in (1, 2, 3) for i in range(len(t) - k + 1))


def test_segmentation_shuffles_known_runs_only(spark):
    """Runs of words are found where the rows lie: none is written out as a row to look it up."""
    df = spark.createDataFrame([(i, ["x", "a", "b", "c", f"u{i}"]) for i in range(8)], "id long, tokens array<string>")
    out = segment.segment(df, "tokens", spark.createDataFrame([("a_b", 2, 7), ("b_c", 2, 9), (None, 2, 9)], "compound string, length int, gain long"))
    assert {tuple(r.words) for r in out.collect()} == {("x", "a", "b_c", f"u{i}") for i in range(8)}
    assert "Generate" not in out._jdf.queryExecution().optimizedPlan().toString()
    learned = {r.compound: r.n for r in segment.learn(df, "tokens", min_gain=1).collect()}
    assert learned == {"x_a": 8, "a_b": 8, "b_c": 8, "x_a_b": 8, "a_b_c": 8}
