import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import backoff_lm, block_topk, lang_crf, license_scan, mixing, packing, secret_scan

SMALL = "/root/testdata/sf0.001"


# Packing

def check_packed(pieces, rows, window):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    expected = collections.Counter()
    for i, t, *_ in rows:
        expected[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    by_row, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for p in pieces:
        by_row[p.row_id].append(p)
        by_sequence[p.sequence_id].append(p)
        assert p.ids_crc32 == zlib.crc32(np.asarray(p.ids, "<u4").tobytes()) and len(p.ids) == p.length
    got = collections.Counter()
    for own in by_row.values():
        own.sort(key=lambda p: p.start)
        ids = [x for p in own for x in p.ids]
        assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert all(p.doc_tokens == len(ids) for p in own)
        got[own[0].doc_id, tuple(ids)] += 1
    assert got == expected
    for own in by_sequence.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        assert sum(p.length for p in own) <= window
    return sum(p.length for p in pieces) / window / len(by_sequence)


@pytest.mark.parametrize(("window", "most", "cut"), [(2048, 64, 16), (64, 3, 8), (7, 1, 1)])
def test_packing_round_trip(docs, rows, window, most, cut):
    pieces = packing.pack_documents(docs, window, most, cut, merge_tasks=2, with_ids=True).collect()
    assert check_packed(pieces, rows, window) > 0.9


def test_packing_empty(no_docs):
    assert packing.pack_documents(no_docs).count() == 0


def test_encoder_equals_tokenizer_on_odd_texts():
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(packing.tokenizer_path())
    encoder = packing.Encoder(packing.tokenizer_path())
    for t in ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a \n b", "a\n\nb.", "it's fine, isn't it?", "x.,\ny", "\x1c a\x85b",
              "1,000.5 é.ü, <|endoftext|> z<|endoftext|>", "a b  c", "...", "don.'t ,.", "\n", "a\r\nb", "foo .bar\tbaz"]:
        for _ in range(2):
            assert list(np.frombuffer(encoder.ids(t), "<u4")) == tokenizer.encode(t, add_special_tokens=False).ids, t


# License scan

def test_license_spans(spark):
    mit, gpl = license_scan.TEMPLATES["MIT"], license_scan.TEMPLATES["GPL-3.0-notice"]
    changed = gpl.replace("free software", "FREE   software").replace("by the Free Software Foundation", "by")
    rows = [(1, "vor é 💡 " + mit + " danach " + mit), (2, "x " + changed + " y"), (3, None), (4, ""),
            (5, "nothing licensed under the sun here"), (None, mit), (7, ("filler words " * 30_000) + mit.upper()), (1, "again " + mit)]
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").withColumn("license", F.lit("x"))).collect()
    text = dict(rows[:3] + rows[6:7])
    got = collections.Counter((r.doc_id, r.license) for r in found)
    assert got == {(1, "MIT"): 3, (2, "GPL-3.0-notice"): 1, (None, "MIT"): 1, (7, "MIT"): 1}
    first = sorted((r for r in found if r.doc_id == 1), key=lambda r: r.start)
    assert {text[1][r.start:r.stop] for r in first if r.start > 8 or r.start == 8} >= {mit.rstrip(".")}
    gpl_row = next(r for r in found if r.doc_id == 2)
    assert 0.8 <= gpl_row.coverage < 1 and gpl_row.start == 2 and gpl_row.stop == len(rows[1][1]) - 3
    assert next(r for r in found if r.doc_id == 7).coverage == 1


def test_license_scan_of_documents_finds_each_notice(docs, rows):
    got = collections.Counter(r.doc_id for r in license_scan.scan(docs).collect())
    short = [t for t in license_scan.TEMPLATES.values() if len(t) < 90]
    assert got == collections.Counter(i for i, t, *_ in rows for s in short for _ in range((t or "").count(s)))


def test_license_names_and_whole_texts():
    """Each text is found as itself; a text that differs in a telling word, or is mostly put-in words, isn't."""
    import pyarrow as pa
    templates = license_scan.shipped()
    found = lambda t: [(r["license"], r["coverage"]) for b in license_scan._scan_task(templates, 0.8)(iter([
        pa.RecordBatch.from_arrays([pa.array([1]), pa.array([t])], ["doc_id", "text"])])) for r in b.to_pylist()]
    for name, text in templates.items():
        assert found(f"some words before {text} and some after") == [(name, 1)], name
    assert {"Apache-2.0-whole", "GPL-2.0-whole", "GPL-3.0-whole", "LGPL-2.1-whole", "MPL-2.0-whole", "MIT-whole", "BSD-3-Clause-whole",
            "BSD-2-Clause-whole", "CC-BY-SA-4.0-whole", "Unlicense-whole"} <= set(templates)
    names = lambda t: [n for n, _ in found(t)]
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    assert names(gnu.format("Lesser ", 3)) == ["LGPL-3.0"] and names(gnu.format("Affero ", 3)) == ["AGPL-3.0"]
    assert names(gnu.format("", 2)) == ["GPL-2.0"] and names(gnu.format("Lesser ", "2.1")) == ["LGPL-2.1"] and names(gnu.format("", 4)) == []
    assert names("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.") == ["CC-BY-NC-4.0-notice"]
    assert names("Released under the BSD License.") == names("Licensed under the Mozilla License, Version 2.0.") == []
    assert names("This work is licensed under a very long and quite other Creative Commons and Attribution of 4.0 International License.") == []
    whole = templates["Apache-2.0-whole"].replace("worldwide", "world-wide")
    assert [n for n, c in found(whole) if 0.9 < c < 1] == ["Apache-2.0-whole"]


def test_license_scan_empty_and_short_template(no_docs):
    assert license_scan.scan(no_docs).count() == 0
    with pytest.raises(ValueError):
        license_scan.Index({"short": "MIT"})


# Language

def test_language_held_out_accuracy(spark):
    from reviewlake.llm.queries import op5_language
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = op5_language(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in got if r.held_out]
    assert len(got) == len(truth) and {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_language_odd_rows(docs, rows):
    found = lang_crf.learn_and_predict(docs, F.lit(True), train_docs=20, carry=["doc_id", "text", "label"]).collect()
    assert len(found) == len(rows)
    for r in found:
        letters = any(c.isalpha() for c in r.row.text or "")
        assert (r.lang_pred == "und") == (not letters) and 0 <= r.score <= 1 and r.row.label == "extra label"
        if not letters:
            assert r.score == 0


def test_language_nothing_learned(docs, no_docs):
    assert {(r.lang_pred, r.score) for r in lang_crf.learn_and_predict(docs, F.lit(False), carry=["doc_id"]).collect()} == {("und", 0.0)}
    assert lang_crf.learn_and_predict(no_docs, F.lit(True)).count() == 0


def test_marginals_equal_enumeration():
    r = np.random.default_rng(1)
    counts = np.array([3, 0, 5, 1])
    emission, transitions = r.normal(size=(9, 3)), r.normal(size=(3, 3))
    gamma, _ = lang_crf.marginals(emission, counts, transitions)
    at = 0
    for n in counts:
        p = np.zeros((n, 3))
        for path in np.ndindex(*[3] * n) if n else []:
            start = np.exp(transitions[:, path[0]]).sum()
            s = start * math.exp(sum(emission[at + i, y] for i, y in enumerate(path))
                                 + sum(transitions[a, b] for a, b in zip(path, path[1:], strict=False)))
            for i, y in enumerate(path):
                p[i, y] += s
        if n:
            np.testing.assert_allclose(gamma[at:at + n], p / p.sum(axis=1, keepdims=True), rtol=1e-4)
        at += n


def test_marginals_across_segments(monkeypatch):
    r = np.random.default_rng(2)
    counts = np.array([150, 7, 64, 65])
    emission, transitions = r.normal(size=(counts.sum(), 4)), r.normal(size=(4, 4))
    short = lang_crf.marginals(emission, counts, transitions)[0]
    monkeypatch.setattr(lang_crf, "SEGMENT", 1000)
    np.testing.assert_allclose(short, lang_crf.marginals(emission, counts, transitions)[0], atol=1e-4)


def test_code_switched_words_get_their_language():
    en, de = "the house is on the hill and they see it", "das haus ist auf dem berg und sie sehen es"
    model = lang_crf.fit([en] * 20 + [de] * 20, ["en"] * 20 + ["de"] * 20)
    import pyarrow as pa
    w = lang_crf.words(pa.array([en + " " + de]), lower=True)
    inverse, ids, owner, _ = lang_crf.word_features(w, model.lexicon)
    gamma, _ = lang_crf.marginals(lang_crf._sums(model.weights, ids, owner, int(inverse.max()) + 1)[inverse], w.counts, model.transitions)
    assert [model.labels[i] for i in gamma.argmax(axis=1)] == ["en"] * 10 + ["de"] * 10


def test_language_is_learned_from_all_parts_of_long_texts():
    import pyarrow as pa
    en, de = "the house is on the hill and they see it", "das haus ist auf dem berg und sie sehen es"
    head = "zz qq " * lang_crf.TRAIN_WORDS
    model = lang_crf.fit([f"{head}{t} " + f"{t} " * 300 for t in [en] * 3 + [de] * 3], ["en"] * 3 + ["de"] * 3)
    for text, label in ((en, "en"), (de, "de")):
        w = lang_crf.words(pa.array([text]), lower=True)
        inverse, ids, owner, _ = lang_crf.word_features(w, model.lexicon)
        gamma, _ = lang_crf.marginals(lang_crf._sums(model.weights, ids, owner, int(inverse.max()) + 1)[inverse], w.counts, model.transitions)
        assert [model.labels[i] for i in gamma.argmax(axis=1)] == [label] * 10


# Exact top-k

def brute_top(vectors, k):
    whole = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in vectors
             if i is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = set()
    for q in (i for i in whole if i % 20 == 0):
        scored = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=False)), i) for i, v in whole.items() if i != q)[:k]
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(scored)}
    return out


def test_topk_equals_brute_force(spark):
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=6).astype(np.float32).tolist()) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 340)] + [(340, None), (341, [None] * 6), (342, [math.nan] * 6), (343, []),
                                                         (344, [math.inf] * 6), (None, [1.0] * 6), (360, [1.0, 2.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("n", F.lit("x"))
    vectors = block_topk.quantised(frame, "vec_id", "embedding")
    for shape in ((4, 16, 8), (256, 4096, 1024)):
        got = block_topk.top_k(vectors, vectors.where("id % 20 = 0"), 20, *shape).collect()
        assert {tuple(x) for x in got} == brute_top(rows, 20) and len(got) == len(brute_top(rows, 20))


def test_topk_of_repeated_ids(spark):
    rows = [(0, [1.0]), (0, [1.0]), (0, [2.0]), (1, [3.0]), (1, [3.0]), (2, [1.0])]
    v = block_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    got = [tuple(r) for r in block_topk.top_k(v, v.where("id % 20 = 0"), k=3).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 64 * 192), (0, 2, 1, 64 * 192), (0, 3, 2, 64 * 64)]


def test_topk_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, -1.0]), (1, [2.0, 0.0])], "vec_id long, embedding array<float>")
    v = block_topk.quantised(few, "vec_id", "embedding")
    assert [tuple(r) for r in block_topk.top_k(v, v.where("id % 20 = 0")).collect()] == [(0, 1, 1, 64 * 128)]
    assert block_topk.top_k(v.where("false"), v.where("false")).count() == 0


def test_pruning_keeps_ties_and_large_products():
    ids = np.arange(40)
    m = np.tile(np.array([[1 << 40, -(1 << 41)]]), (40, 1))
    who, key, score = block_topk.search(np.array([3]), m[:1], ids, m, 5, 4)
    assert key.tolist() == [0, 1, 2, 4, 5] and set(score.tolist()) == {(1 << 63) - 1}


def test_topk_scores_travel_from_shard_to_shard(spark, monkeypatch):
    """Before, every shard gave k rows of every query, and each shard met its own copy of the batches, which could be broadcast."""
    r = np.random.default_rng(9)
    ids, m = np.arange(90), r.integers(-9, 9, (90, 5))
    best = None
    for at in range(0, 90, 18):
        best = block_topk.search(ids[:7], m[:7], ids[at:at + 18], m[at:at + 18], 4, 5, best)
    want = [(q, i) for q in range(7) for i in sorted((i for i in range(90) if i != q), key=lambda i, q=q: (-(m[q] @ m[i]), i))[:4]]
    assert list(zip(best[0].tolist(), best[1].tolist(), strict=True)) == want

    rows = [(int(i), [float(x) for x in v]) for i, v in zip(ids, m, strict=True)]
    v = block_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), "vec_id", "embedding")
    monkeypatch.setattr(block_topk, "HELD_BATCHES", 2)
    monkeypatch.setattr(block_topk, "GRID", 6)
    monkeypatch.setattr(block_topk, "RANGES", 2)
    found = block_topk.top_k(v, v.where("id % 20 = 0"), 4, 2, 3, 1)
    assert {tuple(x) for x in found.collect()} == brute_top(rows, 4)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "MapInArrow" in plan


# Language model

def test_lm_equals_brute_force(docs, rows):
    import itertools
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2
    got = backoff_lm.learn_and_score(docs, learn).collect()
    texts = [(i, (t or "").encode().lower().split() + [None]) for i, t, *_ in rows]
    trained = [t for i, t in texts if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    count = collections.Counter(itertools.chain(*trained))
    pair = collections.Counter(p for t in trained for p in zip(["start", *t[:-1]], t, strict=True))
    total, followers = collections.Counter(), collections.Counter(h for h, _ in pair)
    for (h, _), n in pair.items():
        total[h] += n
    n, v = sum(count.values()), len(count)
    once, twice = (sum(x == k for x in pair.values()) for k in (1, 2))
    d = once / (once + 2 * twice)
    root = lambda w: (count[w] + 1) / (n + v + 1)

    def p(h, w):
        return (max(pair[h, w] - d, 0) + d * followers[h] * root(w)) / total[h] if total[h] else root(w)
    expected = sorted((i or 0, len(t), sum(count[w] > 0 for w in t), sum(math.log10(root(w)) for w in t),
                       sum(math.log10(p(h, w)) for h, w in zip(["start", *t[:-1]], t, strict=True))) for i, t in texts)
    found = sorted((r.doc_id or 0, r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    assert {r.train_tokens for r in got} == {n} and len(found) == len(expected)
    for a, b in zip(found, expected, strict=True):
        assert a[:3] == b[:3]
        assert a[3:] == pytest.approx(b[3:], rel=1e-9, abs=1e-9)


def test_lm_nothing_learned_or_read(docs, no_docs):
    assert {(r.score, r.n_known) for r in backoff_lm.learn_and_score(docs, F.lit(False)).collect()} == {(0.0, 0)}
    assert backoff_lm.learn_and_score(no_docs, F.lit(True)).count() == 0


def test_automaton_states_are_distributions():
    words_, arcs = np.array([5, 3, 0, 2]), {(0, 1): 2, (0, 0): 1, (1, 3): 3}
    pairs = [(s, t) for s in range(4) for t in range(4)]
    total = np.array([arcs.get(x, 0) for x in pairs])
    followers = np.array([2, 1, 0, 0])
    a = backoff_lm.Automaton(words_.astype(float), 10, 3, np.array([s for s, _ in pairs]), np.array([t for _, t in pairs]), total,
                             followers, np.array([3, 3, 0, 0]), 0.6)
    p = 10 ** a.walk(np.arange(16)).reshape(4, 4)
    missing = 1 - sum((words_ + 1) / 14)                     # of tokens outside the vocabulary
    share = np.array([0.6 * 2 / 3, 0.6 / 3, 1, 1])
    np.testing.assert_allclose(p.sum(axis=1) + share * missing, 1)


# Mixing

def test_mixing_meets_the_limits(docs, rows):
    got = mixing.mix(docs, block_tokens=200).collect()
    counts = collections.Counter()
    for _, t, _, s in rows:
        counts[s] += len((t or "").encode().split())
    weight = {r.source: r.weight for r in got}
    assert set(weight) == set(counts)
    repeats = [weight[s] / counts[s] for s in counts if counts[s]]
    assert max(repeats) / min(repeats) <= mixing.MAX_REPEATS + 1e-3
    copies = collections.Counter((r.doc_id, r["pass"]) for r in got)
    assert {i for i, _ in copies} == {i for i, *_ in rows} and len([r for r in got if r["pass"] == 1]) == len(rows)
    assert all(0 <= r.schedule - (r["pass"] - 1) < 1 for r in got)


def test_mixing_to_an_entropy(spark):
    rows = [(i, "w " * 10, "big") for i in range(800)] + [(1000 + i, "w " * 10, "mid") for i in range(150)]
    rows += [(2000 + i, "w " * 10, None) for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(frame, target_entropy=0.9, max_repeats=100, block_tokens=20).collect()
    w = {r.source: r.weight for r in got}
    entropy = -sum(x * math.log(x) for x in w.values()) / math.log(3)
    assert entropy == pytest.approx(0.9, abs=1e-3) and sum(w.values()) == pytest.approx(1)
    tokens = collections.Counter()
    for r in got:
        tokens[r.source] += r.n_tokens
    for s in w:
        assert tokens[s] / sum(tokens.values()) == pytest.approx(w[s], abs=0.03)
    half = mixing.mix(frame, target_entropy=0.9, max_repeats=100, block_tokens=20, budget=5000).collect()
    assert sum(r.n_tokens for r in half) == pytest.approx(5000, rel=0.1)


def test_mixing_small_source_meets_its_weight(spark):
    """A source far smaller than a block is repeated in part, not as a whole or not at all."""
    rows = [(i, "w " * 10, "big" if i < 800 else "small") for i in range(1000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.source: r for r in mixing.realised(mixing.mix(frame, target_entropy=0.82)).collect()}
    assert got["small"].weight == pytest.approx(0.256, abs=0.01)
    for r in got.values():
        assert r.realised == pytest.approx(r.weight, abs=0.02)


def test_mixing_rows_and_empty(docs, rows, no_docs):
    mixed = mixing.mix_rows(docs)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == {i for i, *_ in rows}
    assert mixing.mix(no_docs).count() == 0 and mixing.mix_rows(no_docs).count() == 0


# Secret scan

ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(t):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(t) if len(m.group(1)) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m.group()) >= 24]
    return sorted(out)


def test_secret_base_equals_brute_force(docs, rows):
    got = secret_scan.summary(secret_scan.scan(docs)).collect()
    expected = collections.Counter()
    for i, t, *_ in rows:
        spans = base_spans(t or "")
        text = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        expected[i, *(sum(s[1] == k for s in spans) for k in range(3)), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == expected
    for r in got:
        assert r.spans == "" or all(re.fullmatch(r"(assign|access|hex|live):\d+:\d+", s) for s in r.spans.split(","))


def test_secret_ownership(spark):
    live, copied = "Zx9Kq2Lm8Rt5Wb3Yc7Vd1", "Ab1Cd2Ef3Gh4Ij5Kl6Mn7"
    rows = [(i, f"see {copied} here", f"owner{i}") for i in range(5)] + [(10, f"mine {live} ok", "me"), (11, None, None), (12, "", "me")]
    got = {r.doc_id: r for r in secret_scan.summary(secret_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert got[10].spans == f"live:5:{5 + len(live)}" and got[10].n_owner_specific == 1
    assert all(got[i].spans == "" and got[i].n_copied == 1 for i in range(5)) and got[11].spans == got[12].spans == ""


def test_one_owner_in_many_documents_stays_live(spark):
    key, shared = "Zx9Kq2Lm8Rt5Wb3Yc7Vd1", "Qw9Kq2Lm8Rt5Wb3Yc7Vd1"
    rows = [(i, f"see {key} and {shared} here", "me") for i in range(50)] + [(99, shared, "you")]
    got = secret_scan.summary(secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()
    assert all(r.spans == f"live:4:{4 + len(key)}" and (r.n_owner_specific, r.n_copied, r.most_repositories) == (1, 1, 50)
               for r in got if r.doc_id != 99)
    assert [(r.spans, r.n_copied) for r in got if r.doc_id == 99] == [("", 1)]


def test_live_spans_equal_brute_force(spark):
    """Random texts of values that overlap base findings or not, of one owner or of several."""
    r = random.Random(12)
    pool = ["".join(r.choice("abcdefghijKLMNOP0123456789+/_-") for _ in range(r.randint(18, 30))) for _ in range(40)]
    pool += [f"AKIA{'ABCDEFGH'}{i}23456789Z" for i in range(4)] + ["0123456789abcdef" * 2, "password=", "token: ", "é", "💡 x"]
    rows = [(i, "".join(r.choice(pool) + r.choice([" ", "", "\n", " "]) for _ in range(r.randint(0, 12))), r.choice(["a", "b", None]))
            for i in range(150)]
    generic = [[(m.start(), m.end(), m.group()) for m in re.finditer("[A-Za-z0-9+/_-]{20,}", t) if len(set(m.group())) >= 10
                and sum(c.isdigit() for c in m.group()) >= 3 and re.search("[A-Za-z]", m.group())] for _, t, _ in rows]
    owners = collections.defaultdict(set)
    for (_, t, owner), found in zip(rows, generic, strict=True):
        for value in [v for _, _, v in found] + [m.group(1) for m in ASSIGN.finditer(t) if len(m.group(1)) >= 6] + [
                t[a:b] for a, k, b, _ in base_spans(t) if k]:
            owners[value].add(owner)
    want = {}
    for (i, t, _), found in zip(rows, generic, strict=True):
        base = base_spans(t)
        live = [(a, 3, b, "live") for a, b, v in found if len(owners[v]) == 1 and not any(x < b and a < y for x, _, y, _ in base)]
        want[i] = ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(base + live))
    got = {x.doc_id: x.spans for x in secret_scan.summary(secret_scan.scan(
        spark.createDataFrame(rows, "doc_id long, text string, source string"))).collect()}
    assert got == want and sum(s.count("live") for s in got.values()) > 20


def test_a_hundred_thousand_matches_in_one_text(spark):
    import time
    text = " ".join(hashlib.md5(str(i).encode()).hexdigest() for i in range(100_000))
    docs = spark.createDataFrame([(1, text, "me")], "doc_id long, text string, source string")
    began = time.time()
    got = secret_scan.summary(secret_scan.scan(docs)).first()
    spans = [f"hex:{33 * i}:{33 * i + 32}" for i in range(100_000)]
    assert got.n_hex == 100_000 and got.base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest()
    assert got.spans == ",".join(spans) and time.time() - began < 60


def test_secret_scan_runs_no_python(spark, docs):
    plan = secret_scan.summary(secret_scan.scan(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secret_empty(no_docs):
    assert secret_scan.summary(secret_scan.scan(no_docs)).count() == 0


# Runs of language in code-switched texts

def test_language_runs(spark):
    """Stretches of planted code-switched texts: their labels, ends in code points, and the words of each."""
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang")
    rows = table.where("lang IS NOT NULL").collect()
    model = lang_crf.learn(table, F.col("doc_id") % 2 == 0)
    by_lang = collections.defaultdict(list)
    for r in rows:
        if r.doc_id % 2 and len(r.text.split()) >= 60:
            by_lang[r.lang].append(r.text.split())
    langs = [x for x in sorted(by_lang) if x in model.labels][:3]
    planted = {}
    for i in range(12):
        a, b = langs[i % len(langs)], langs[(i + 1) % len(langs)]
        first, second = by_lang[a][i % len(by_lang[a])][:40], by_lang[b][i % len(by_lang[b])][20:60]
        planted[i] = (a, b, "é " + " ".join(first), " ".join(second) + " 123 ...")
    docs = spark.createDataFrame([(i, f"{x}\n{y}") for i, (_, _, x, y) in planted.items()] + [(50, None), (51, ""), (52, "123 ...")],
                                 "doc_id long, text string").withColumns({c: F.lit("x") for c in ("start", "stop", "lang", "score")})
    found = lang_crf.label_runs(docs.repartition(3), model).collect()
    right = total = 0
    for i, (a, b, x, y) in planted.items():
        text, own = f"{x}\n{y}", sorted((r for r in found if r.doc_id == i), key=lambda r: r.start)
        assert all(r.stop <= s.start and r.lang != s.lang for r, s in zip(own, own[1:]))
        spoken = [w for w in re.finditer(r"[^\x20\x09-\x0D]+", text) if any(c.isalpha() or c > "\x7f" for c in w.group())]
        assert sum(r.n_words for r in own) == len(spoken) and all(0 < r.score <= 1 + 1e-6 for r in own)
        for w in spoken:
            run = next(r for r in own if r.start <= w.start() and w.end() <= r.stop)
            right += run.lang == (a if w.start() < len(x) else b)
            total += 1
        assert own[0].start == spoken[0].start() and own[-1].stop == spoken[-1].end()
    assert {r.doc_id for r in found} == set(planted) and right / total > 0.85


# Pipeline

def test_pipeline_stages(docs, spark):
    import corpus_pipeline
    from reviewlake.session import cut_lineage
    here = docs
    for name, stage in corpus_pipeline.STAGES:
        before, here = here, cut_lineage(stage(spark, here, SMALL), "test-stage")
        if name != "packing":
            assert here.columns == docs.columns
        if name == "language ID":
            assert {r.text for r in here.select("text").collect()} <= {r.text for r in before.select("text").collect()}
            assert all(any(c.isalpha() for c in r.text) for r in here.select("text").collect())
    last = here.groupBy("row_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert all(r.n == r.m for r in last) and len(last) == before.count()


def test_pipeline_of_no_documents(no_docs, spark):
    import corpus_pipeline
    from reviewlake.session import cut_lineage
    here = no_docs
    for _, stage in corpus_pipeline.STAGES:
        here = cut_lineage(stage(spark, here, SMALL), "test-stage")
    assert here.count() == 0
