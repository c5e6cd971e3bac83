"""Spelling variants, byte-level BPE and fill-in-middle against plain Python statements of their contracts."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlake.llm import byte_bpe, infilling, spelling
from reviewlake.llm.queries import op12_byte_bpe

SMALL = "/root/testdata/sf0.001"
sha = lambda t: hashlib.sha256(t.encode() if isinstance(t, str) else t).hexdigest()


# Spelling variants

def lower_ascii(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def expected_variants(rows, every=97, least=3):
    n = collections.Counter()
    for i, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= 5:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= least}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    out = {}
    for w in n:
        around = [x for m in (-1, 0, 1) for x in by_length[len(w) + m] if near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = (form, n[w], len(around), None if form is None else n[form])
    def root(w):
        while out[w][0] is not None:
            w = out[w][0]
        return w
    return {(w, f, root(w), n, k, m) for w, (f, n, k, m) in out.items()}


WORDS = "word string, n long"


@pytest.mark.parametrize("pairs_of_a_key", [0, spelling.PAIRS_OF_A_KEY])
def test_variants_equal_brute_force(spark, pairs_of_a_key):
    r = random.Random(3)
    letters = "abÀéÿ×n"
    some = ["".join(r.choice(letters) for _ in range(r.randint(4, 8))) for _ in range(60)]
    some += [w[:i] + r.choice(letters) + w[i + r.randint(0, 1):] for w in some for i in (0, len(w) // 2, len(w))]
    texts = [" ".join(r.choice(some).upper() if r.random() < 0.2 else r.choice(some) for _ in range(150)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, texts[1]), (3, texts[3]), (99, None), (98, ""), (97, " ,\n")]
    if pairs_of_a_key:
        rows += [(96, "x" * 9_000 + " " + "x" * 8_999 + " " + "y" * 5)] + [(95, "x" * 9_000)] * 4 + [(94, "x" * 8_999)] * 9
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {c: F.lit("extra") for c in ("word", "key", "n", "form", "root", "l", "rest", "other", "doc", "run")}).repartition(5)
    got = {tuple(x) for x in spelling.variants(docs, typo_every=13, pairs_of_a_key=pairs_of_a_key).collect()}
    assert got == expected_variants(rows, 13)
    assert any(x[0] != x[2] and x[1] != x[2] for x in got)
    assert not pairs_of_a_key or any(len(x[0]) == 8_999 and x[4] for x in got)


def test_variants_of_the_documents(docs, rows):
    assert {tuple(x) for x in spelling.variants(docs).collect()} == expected_variants(rows)


def test_a_common_ending_makes_no_large_key(spark):
    """4,000 words share their last ten letters: signatures are refined, so each key verifies a bounded number of pairs."""
    r = random.Random(5)
    stems = {"".join(r.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(1500)}
    stems |= {s[:4] + "z" + s[5:] for s in sorted(stems)[:300]} | {s[:3] + s[4:] for s in sorted(stems)[:300]}
    every = sorted(s + "ification" for s in stems)
    vocabulary = spark.createDataFrame([(w, 1) for w in every], WORDS)
    got = {(x.a, x.b) for x in spelling.near_pairs(vocabulary).collect()}
    cut = collections.defaultdict(set)
    for w in every:
        for i in range(len(w)):
            cut[i, w[:i] + w[i + 1:]].add(w)
    want = {(a, b) for g in cut.values() for a in g for b in g if a < b}
    known = set(every)
    want |= {(w[:i] + w[i + 1:], w) for w in every for i in range(len(w)) if w[:i] + w[i + 1:] in known}
    assert got == want and len(got) > 300


def test_variants_empty(no_docs):
    assert spelling.variants(no_docs).count() == 0


def test_long_chain_of_forms(spark):
    """Each word is near the next and half as frequent; all end at the most frequent."""
    base = "abcdefghij"
    chain = [base[:i] + "z" * (10 - i) for i in range(11)]
    rows = [(i, " ".join([w] * (3 * 2 ** i))) for i, w in enumerate(chain)]
    got = {x.word: x for x in spelling.variants(spark.createDataFrame(rows, "doc_id long, text string"), typo_every=1 << 40).collect()}
    assert all(got[w].root == base for w in chain) and [got[w].form for w in chain] == [*chain[1:], None]


# Byte-level BPE

@pytest.fixture(scope="module")
def reference_encoding():
    import public_tokenizers
    import tiktoken
    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_offsets_and_decoding(docs, rows, reference_encoding):
    got = byte_bpe.encode(docs).collect()
    want = collections.Counter((i, tuple(reference_encoding.encode_ordinary(t or ""))) for i, t, *_ in rows)
    assert collections.Counter((x.doc_id, tuple(x.ids)) for x in got) == want
    texts = collections.defaultdict(set)
    for i, t, *_ in rows:
        texts[i].add(t or "")
    table = {r: t for t, r in byte_bpe.read_ranks(byte_bpe.ranks_path()).items()}
    for x in got:
        text = next(t for t in texts[x.doc_id] if reference_encoding.encode_ordinary(t) == x.ids)
        at, data = 0, text.encode()
        for token, a, b in list(zip(x.ids, x.starts, x.ends, strict=True))[:3000]:
            whole = text[a:b].encode()
            before = len(text[:a].encode()) if a < 50 or not text.isascii() else a
            assert before <= at and at + len(table[token]) <= before + len(whole) and data[at:at + len(table[token])] == table[token]
            assert at + len(table[token]) > before + len(whole) - len(text[b - 1].encode())
            at += len(table[token])
    back = byte_bpe.text_of(byte_bpe.decode(byte_bpe.encode(docs, offsets=False))).collect()
    assert collections.Counter((x.doc_id, x.text) for x in back) == collections.Counter((i, t or "") for i, t, *_ in rows)
    assert all(x.head_bytes == x.tail_bytes == 0 for x in back) and any(x.n_split for x in back)


def test_every_code_point_and_odd_pieces(reference_encoding):
    own = byte_bpe.codec()
    texts = [f"a{chr(c)}b 1{chr(c)} {chr(c)}2  {chr(c)}." for c in range(0x110000) if c % 7 == 3 and not 0xD800 <= c < 0xE000]
    r = random.Random(9)
    tokens = list(byte_bpe.read_ranks(byte_bpe.ranks_path()))
    texts += [b"".join(r.choice(tokens) for _ in range(9)).decode("utf-8", "ignore") for _ in range(4000)]
    texts += ["".join(r.choice("aab eeh ' \n\t<|.1é") for _ in range(30)) for _ in range(4000)]
    texts += ["", " ", "\n\n  x", "it's I'LL don't", "<|endoftext|>", "a" * 5000, "\x1c \x1c\x85x", "é" * 999]
    assert [x.tolist() for x in own.encode(texts)] == reference_encoding.encode_ordinary_batch(texts)


def test_pieces_have_the_ids_of_the_whole_text(reference_encoding):
    r = random.Random(2)
    own = byte_bpe.codec()
    texts = ["".join(r.choice("ab é \x1c\x1f\x85\u3000\u200b\n\r\t'.  x1") for _ in range(r.randint(0, 60))) for _ in range(6000)]
    assert all("".join(byte_bpe._PIECE.findall(t)) == t for t in texts)
    assert [x.tolist() for x in own.encode(texts)] == reference_encoding.encode_ordinary_batch(texts)
    assert own.encode([]) == [] and [x.tolist() for x in own.encode([""])] == [[]]


def test_slices_that_split_characters(spark, reference_encoding):
    text = "naïve 💡𝒳 — ꙮ日本語"
    ids = reference_encoding.encode_ordinary(text)
    rows = [(i, ids[a:b]) for i, (a, b) in enumerate((a, b) for a in range(len(ids)) for b in range(a, len(ids) + 1))]
    got = byte_bpe.text_of(byte_bpe.decode(spark.createDataFrame([*rows, (None, None)], "doc_id long, ids array<int>"))).collect()
    for x in got:
        data = reference_encoding.decode_bytes(rows[x.doc_id][1]) if x.doc_id is not None else b""
        assert bytes(x.decoded) == data
        assert data[x.head_bytes:len(data) - x.tail_bytes].decode() == x.text and x.head_bytes <= 3 and x.tail_bytes <= 3
        assert "�" not in x.text and x.text in text
    assert any(x.tail_bytes for x in got) and any(x.head_bytes for x in got)


def test_unknown_ids_are_an_error(spark):
    with pytest.raises(Exception, match="not in the rank file"):
        byte_bpe.decode(spark.createDataFrame([(1, [1, 60_000])], "doc_id long, ids array<int>")).collect()


def test_byte_bpe_query(spark, reference_encoding):
    table = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()}
    got = op12_byte_bpe(spark, SMALL).collect()
    assert len(got) == len(table)
    for x in got:
        ids = reference_encoding.encode_ordinary(table[x.doc_id])
        assert (x.n_tokens, x.ids_sha256, x.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(table[x.doc_id]))


def test_byte_bpe_empty(no_docs):
    assert byte_bpe.encode(no_docs).count() == byte_bpe.round_trip(no_docs).count() == 0


# Fill-in-middle

def expected_form(i, text, seed=42):
    text = text or ""
    x = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(x[8 * j:8 * j + 8], 16) for j in range(4)]
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return i, n, "plain", None, None, text
    if h[3] % 100 < 80:
        return i, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return i, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_infilling_equals_brute_force(spark, docs, rows):
    r = random.Random(8)
    odd = [(20_000 + i, "".join(r.choice("<PSM> \tab💡\x1c /") for _ in range(r.randint(0, 25)))) for i in range(800)]
    odd += [(30_001, None), (30_002, ""), (30_003, " \n "), (30_004, "<P>"), (30_005, "a <M> b"), (30_006, "no white space"), (30_007, "ab " * 200_000)]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumns(
        {c: F.lit("extra") for c in ("form", "n", "h1", "output")})
    found = infilling.fill_in_middle(both).withColumn("restored", infilling.restored(F.col("output"), F.col("form"))).collect()
    every = [(i, t) for i, t, *_ in rows] + odd
    assert collections.Counter(tuple(x)[:6] for x in found) == collections.Counter(expected_form(i, t) for i, t in every)
    assert collections.Counter((x.doc_id, x.restored) for x in found) == collections.Counter((i, t or "") for i, t in every)
    assert {x.form for x in found} == {"plain", "psm", "spm"}


def test_infilling_parameters(spark, no_docs):
    assert infilling.fill_in_middle(no_docs).count() == 0
    docs = spark.createDataFrame([(i, f"one two three {i}") for i in range(200)], "doc_id long, text string")
    assert {x.form for x in infilling.fill_in_middle(docs, rate=100, suffix_first=0).collect()} == {"psm"}
    assert {x.form for x in infilling.fill_in_middle(docs, rate=0).collect()} == {"plain"}
    a, b = (sorted(map(tuple, infilling.fill_in_middle(docs, seed=s).collect())) for s in (1, 2))
    assert a != b and a == sorted(expected_form(i, f"one two three {i}", 1) for i in range(200))


def test_block_sizes_do_not_matter(spark, monkeypatch):
    import pyarrow as pa
    texts = ["a b  c", "", None, "é 💡", "x" * 50]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(5)), "text": pa.array(texts)})
    whole = pa.Table.from_batches(byte_bpe._encode_task(None, None, True)(iter([batch]))).to_pydict()
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 1)
    monkeypatch.setattr(byte_bpe, "BLOCK_IDS", 1)
    parts = list(byte_bpe._encode_task(None, None, True)(iter([batch])))
    assert len(parts) > 2 and pa.Table.from_batches(parts).to_pydict() == whole
    back = pa.Table.from_batches(byte_bpe._decode_task(None, None)(iter(parts))).to_pydict()
    assert back["decoded"] == [(t or "").encode() for t in texts]
    assert np.asarray(back["n_split"]).sum() > 0
