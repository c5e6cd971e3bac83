import collections
import hashlib
import re

from pyspark.sql import functions as F

from reviewlake.llm import ngram_join, stream_dedup, substring_dedup
from reviewlake.llm.components import components

SPACES = re.compile(r"[\x20\x09-\x0D]")


def exact_groups(rows):
    groups = collections.defaultdict(list)
    for at, (i, t, *_) in enumerate(rows):
        groups[SPACES.sub("", t or "")].append((-len(t or ""), i is None, i, at))
    return groups


def check_exact(result, rows):
    expected = collections.Counter()
    for key, members in exact_groups(rows).items():
        keep = min(members, key=lambda m: (m[0], m[1], m[2] or 0))
        for n, (_, _, i, _) in enumerate(sorted(members, key=lambda m: (m[0], m[1], m[2] or 0))):
            expected[i, keep[2], len(members), n == 0, hashlib.sha256(key.encode()).hexdigest()] += 1
    return expected, collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in result)


def test_exact_dedup_equals_brute_force(docs, rows):
    expected, got = check_exact(stream_dedup.deduplicate(docs).collect(), rows)
    assert got == expected


def test_exact_dedup_over_many_micro_batches(docs, rows):
    """Hits in later batches meet the state of earlier ones."""
    expected, got = check_exact(stream_dedup.deduplicate(docs, batch_bytes=1).collect(), rows)
    assert got == expected


def test_exact_dedup_checks_full_bytes_when_digests_clash(docs, rows):
    weak = lambda text: (F.length(text) % 3).cast("string")
    result = stream_dedup.deduplicate(docs, digest=weak).collect()
    expected, _ = check_exact([], rows)
    strip = lambda c: collections.Counter(x[:4] for x in c.elements())
    assert strip(collections.Counter((r.doc_id, r.keep_id, r.group_size, r.kept, "") for r in result)) == strip(expected)


def test_exact_dedup_kept_rows_have_all_columns(docs, rows):
    kept = stream_dedup.kept_rows(docs)
    assert kept.columns == docs.columns
    result = kept.collect()
    assert len(result) == len(exact_groups(rows))
    assert {SPACES.sub("", r.text or "") for r in result} == set(exact_groups(rows))
    assert all(r.digest == "extra digest" for r in result)


def test_exact_dedup_query_makes_micro_batches_that_meet_the_state(spark, monkeypatch):
    """The registered query runs in several micro-batches; digests of copies are updated by later ones."""
    from reviewlake.llm.queries import op6_exact_dedup
    from reviewlake.session import list_folder
    made = {}
    real = stream_dedup.scratch_path
    monkeypatch.setattr(stream_dedup, "scratch_path", lambda s, name: made.setdefault(name, real(s, name)))
    rows = op6_exact_dedup(spark, "/root/testdata/sf0.001").collect()
    assert len([f for f in list_folder(spark, made["dedup-state"]) if f.startswith("batch=")]) >= 2
    states = spark.read.parquet(made["dedup-state"]).groupBy("digest").agg(
        F.count(F.lit(1)).alias("n"), F.max("group_size").alias("size")).where("n > 1").collect()
    assert states and all(r["size"] > 1 for r in states) and sum(r.kept for r in rows) == len({r.text_sha256 for r in rows})
    assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "unset") == "unset"      # the caller's session is as it was


def test_exact_dedup_fails_if_a_locator_is_wrong(docs, monkeypatch):
    import pytest
    real = stream_dedup.run_stream
    shifted = F.col("keep").withField("row", F.col("keep.row") + 1_000_000)
    monkeypatch.setattr(stream_dedup, "run_stream", lambda *a: real(*a).withColumn("keep", shifted))
    with pytest.raises(RuntimeError, match="locator"):
        stream_dedup.deduplicate(docs)


def test_exact_dedup_locators_lead_to_the_text(spark):
    import pyarrow.parquet as pq
    found = stream_dedup.deduplicate(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).collect()
    table = pq.read_table("/root/testdata/sf0.001/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    for r in found:
        path, row = r.locator.rsplit("#", 1)
        at = table[int(row)]
        assert path.endswith("documents.parquet") and at["doc_id"] == r.keep_id
        assert hashlib.sha256(SPACES.sub("", at["text"]).encode()).hexdigest() == r.text_sha256


def test_exact_dedup_empty(no_docs):
    assert stream_dedup.deduplicate(no_docs).count() == 0 and stream_dedup.kept_rows(no_docs).count() == 0


def shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def near_components(rows):
    sets = [shingles(t) for _, t, *_ in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    for a, (i, *_) in enumerate(rows):
        if i is not None:
            low[root(a)] = min(low.get(root(a), i), i)
    return sets, [root(a) for a in range(len(rows))], low


def check_near(result, rows):
    sets, root, low = near_components(rows)
    expected = collections.Counter((i, len(sets[a]), low.get(root[a]) if sets[a] else i) for a, (i, *_) in enumerate(rows))
    assert collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in result) == expected


def test_ngram_join_equals_brute_force(docs, rows):
    check_near(ngram_join.join_groups(docs).collect(), rows)


def test_ngram_join_with_every_token_frequent(docs, rows):
    """Pairs of tokens alone find the same groups."""
    check_near(ngram_join.join_groups(docs, frequent=1).collect(), rows)


def test_ngram_join_of_a_large_near_group(spark):
    """Variants of one text, of which many are similar only through others."""
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        own = list(base)
        for j in range(i % 6):
            own[(7 * i + 11 * j) % 60] = f"x{i}_{j}"
        rows.append((i, " ".join(own)))
    for frequent in (64, 2):
        check_near(ngram_join.join_groups(spark.createDataFrame(rows, "doc_id long, text string"), frequent).collect(), rows)


def test_ngram_join_of_repeated_rows_in_different_tasks():
    """A named and an unnamed row read by two tasks, which share one shingle, keep their sets and aren't linked."""
    import numpy as np
    import pyarrow as pa
    shared = [f"s{i}" for i in range(5)]
    texts = [" ".join(shared + [f"t{k}_{i}" for i in range(n - 1)]) for k, n in enumerate((100, 81))]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 0]), pa.array([True, False]), pa.array(texts)], ["node", "plain", "text"])
    sent = [b for _ in range(2) for b in ngram_join._scatter_task(1)(iter([batch]))]
    shares = ngram_join._count_bucket(1)((pa.scalar(0),), pa.Table.from_batches(sent * 2))
    # Held by these two only, so one token of each is shared; all other tokens need no signature.
    assert ngram_join._prefix_bucket(64)(shares).num_rows == 0
    third = pa.RecordBatch.from_arrays([pa.array([2, 3]), pa.array([True, True]), pa.array([t + " end" for t in texts])],
                                       ["node", "plain", "text"])
    sent += list(ngram_join._scatter_task(1)(iter([third])))
    shares = ngram_join._count_bucket(1)((pa.scalar(0),), pa.Table.from_batches(sent))
    sets = ngram_join._prefix_bucket(64)(shares).to_pylist()
    tokens = [np.cumsum(ngram_join.unpack(r["tokens"])[0]) for r in sets]
    assert len(sets) == 4 and [len(np.unique(t)) for t in tokens] == [len(t) for t in tokens]
    assert sorted((r["n"], len(t)) for r, t in zip(sets, tokens, strict=True)) == [(81, 81), (82, 81), (100, 100), (101, 100)]
    pairs = [{f"{k}_{c}" if k != "node" else c: r[k] for c, r in (("a", x), ("b", y)) for k in ("node", "n", "tokens")}
             for i, x in enumerate(sets) for y in sets[i + 1:]]
    linked = [r for b in ngram_join._verify_task(iter([pa.RecordBatch.from_pylist(pairs)])) for r in b.to_pylist()]
    sizes = {r["node"]: r["n"] for r in sets}
    assert sorted(sorted((sizes[r["a"]], sizes[r["b"]])) for r in linked) == [[81, 82], [100, 101]]


def test_signatures_meet_for_every_similar_pair():
    import numpy as np
    r = np.random.default_rng(3)
    for _ in range(400):
        n = int(r.integers(4, 60))
        x = r.choice(10_000, n, replace=False)
        y = x.copy()
        y[:int(r.integers(0, n // 8 + 2))] = r.choice(np.arange(10_000, 20_000), n, replace=False)[:1]
        y = np.unique(y)[int(r.integers(0, 2)):]
        both = len(np.intersect1d(x, y))
        if 5 * both < 4 * (n + len(y) - both):
            continue
        times = lambda t: 2 + (t % 7)
        order = lambda t: t[np.lexsort((t, times(t)))].astype(np.int64)
        shared = [order(np.intersect1d(x, y)), order(np.intersect1d(x, y))]
        for frequent in (0, 3, 100):
            for own in (shared, [order(x), order(y)]):
                (a, la), (b, lb) = (ngram_join.signatures(len(s), t, times(t), frequent) for s, t in zip((x, y), own, strict=True))
                common, ia, ib = np.intersect1d(a, b, return_indices=True)
                least = -(-4 * (n + len(y)) // 9)
                early = (la[ia] <= n - least + 1) & (lb[ib] <= len(y) - least + 1)
                assert early.any(), (n, len(y), both, frequent, common)


def test_one_of_each_group(docs, rows):
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    result = kept.collect()
    sets, root, low = near_components(rows)
    groups = {root[a] for a in range(len(rows)) if sets[a]}
    assert sum(1 for r in result if shingles(r.text)) == len(groups)
    assert sum(1 for r in result if not shingles(r.text)) == sum(1 for s in sets if not s)
    assert {i for i in low.values()} <= {r.doc_id for r in result}


def test_ngram_join_empty(no_docs, spark):
    assert ngram_join.join_groups(no_docs).count() == 0 and ngram_join.one_of_each(no_docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, ""), (3, "   ")], "doc_id long, text string")
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join_groups(blank).collect()} == {(1, 0, 1), (2, 0, 2), (3, 0, 3)}


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 200)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5), (2000, 1999), (1999, 2000)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1200)}, 1999: 1999, 2000: 1999}


def passages(rows, k=35):
    words = [(t or "").encode().split() for _, t, *_ in rows]
    count = collections.Counter(tuple(w[i:i + k]) for w in words for i in range(len(w) - k + 1))
    out = collections.Counter()
    for (i, *_), w in zip(rows, words, strict=True):
        gone = set()
        for j in range(len(w) - k + 1):
            if count[tuple(w[j:j + k])] > 1:
                gone.update(range(j, j + k))
        kept = b" ".join(x for j, x in enumerate(w) if j not in gone)
        out[i, len(w), len(gone), hashlib.sha256(kept).hexdigest()] += 1
    return out


def test_substring_dedup_equals_brute_force(docs, rows):
    result = substring_dedup.remove_repeats(docs).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result) == passages(rows)
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in result)


def test_substring_dedup_of_heavy_content(spark, monkeypatch):
    """A passage of most texts, copies, and one word repeated: heavy windows don't travel, the rest does."""
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(i, " ".join(f"u{i}_{j}" for j in range(i % 40)) + " " + passage + f" v{i} w{i}") for i in range(120)]
    rows += [(1000 + i, "again " * 60 + f"end{i}") for i in range(3)] + [(2000, rows[7][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    result = substring_dedup.remove_repeats(frame).collect()
    assert collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in result) == passages(rows)


def test_substring_dedup_empty(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def test_exact_dedup_shuffles_no_text_to_find_its_locator(spark, tmp_path):
    """Locators stay small enough to broadcast, where a row for each would be too many."""
    n = 20_000
    spark.range(n).select(F.col("id").alias("doc_id"), F.concat(F.lit("t "), F.when(F.col("id") % 10 == 9, F.col("id") - 1).otherwise(F.col("id"))).alias("text")) \
        .coalesce(4).write.parquet(f"{tmp_path}/documents")
    docs = spark.read.parquet(f"{tmp_path}/documents")
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16k")
    try:
        kept = stream_dedup.kept_rows(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
        assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(n) if i % 10 != 9]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)


def test_prefixes_of_a_bucket_take_few_bytes_a_token():
    import tracemalloc

    import numpy as np
    import pyarrow as pa
    from reviewlake.llm.blocks import deltas, pack, unpack
    n_docs, each = 200, 1500
    values = []
    for bucket in range(4):
        node = np.arange(n_docs, dtype=np.int64) * 3
        values.append(pack(deltas(node), np.full(n_docs, 4 * each, dtype=np.uint32), np.full(n_docs, each, dtype=np.uint32),
                           np.tile(np.arange(each, dtype=np.uint32), n_docs), np.full(n_docs * each, n_docs, dtype=np.uint32)))
    table = pa.table({"bucket": pa.array([0, 1, 2, 3], pa.int32()), "packed": pa.array(values, pa.binary())})
    run = ngram_join._prefix_bucket(ngram_join.FREQUENT)
    tracemalloc.start()
    try:
        got = run(table)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert got.column("node").to_pylist() == (np.arange(n_docs) * 3).tolist() and set(got.column("n").to_pylist()) == {4 * each}
    assert all(len(unpack(v.as_py())[0]) == 4 * each for v in got.column("tokens"))
    assert peak < 48 * 4 * n_docs * each                            # with name and size beside each token: 58
