import random
from pathlib import Path

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlake.llm import blocks, ngram_join

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aB é\t\n\r\x0b\x0c\x1c💡", max_size=30)), max_size=6)


@given(TEXTS)
@settings(max_examples=200, deadline=None)
def test_words_are_those_of_bytes_split(texts):
    w = blocks.words(pa.array(texts, pa.string()), lower=True)
    joined = w.joined()
    for i, t in enumerate(texts):
        expected = (t or "").encode().lower().split()
        for x in (w, joined):
            own = range(x.first[i], x.first[i + 1])
            assert [x.data[x.starts[j]:x.ends[j]].tobytes() for j in own] == expected
    assert (w.hashes() == joined.hashes()).all()


@given(TEXTS, st.integers(1, 12))
@settings(max_examples=100, deadline=None)
def test_equal_runs_of_words_hash_alike_and_stay_in_their_row(texts, n):
    w = blocks.words(pa.array(texts, pa.string()))
    h, at = blocks.ngrams(w.hashes(), w.first, n)
    expected = [tuple((t or "").encode().split()[i:i + n]) for t in texts for i in range(len((t or "").encode().split()) - n + 1)]
    assert len(h) == len(at) == len(expected)
    assert len(set(h.tolist())) == len(set(expected))
    assert len(set(zip(h.tolist(), expected, strict=True))) == len(set(expected))


def test_pack_restores_arrays():
    r = np.random.default_rng(1)
    arrays = [np.sort(r.integers(0, 1 << 63, 1000).astype(np.uint64)), np.zeros(0, np.uint32), r.integers(0, 9, 7).astype(np.uint8)]
    for a, b in zip(arrays, blocks.unpack(blocks.pack(*arrays)), strict=True):
        assert a.dtype == b.dtype and (a == b).all()
    assert (np.cumsum(blocks.deltas(arrays[0]), dtype=np.uint64) == arrays[0]).all()


def test_slices_hold_all_rows_in_order_within_bounds():
    r = random.Random(2)
    texts = [None if r.random() < 0.1 else "x" * r.randint(0, 50) for _ in range(500)] + ["y" * 1000]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"])
    parts = list(blocks.slices([batch], "text", 200))
    assert [t for p in parts for t in p.column(0).to_pylist()] == texts
    assert all(p.num_rows == 1 or sum(len(t or "") for t in p.column(0).to_pylist()) <= 200 for p in parts)


def test_spread_partitions_positions():
    values = blocks.mix64(np.arange(1000, dtype=np.uint64))
    parts = blocks.spread(values, 7)
    assert sorted(np.concatenate([p for _, p in parts]).tolist()) == list(range(1000))
    assert len(parts) == 7 and blocks.spread(values[:0], 7) == []


def test_a_task_leaves_its_process_little_memory_and_holds_little():
    """In a process of its own, as a Python worker: what others left free there would hide what a task keeps."""
    import subprocess
    import sys
    code = """
import re, tracemalloc
import numpy as np, pyarrow as pa
from reviewlake.llm import ngram_join
from reviewlake.llm.blocks import releasing
def own():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) // 1024
def batches(n):
    rng = np.random.default_rng(1)
    texts = pa.array([" ".join(w) for w in rng.integers(0, 100_000, (n, 500)).astype(str)])
    yield pa.RecordBatch.from_arrays([pa.array(range(n)), texts, pa.array([True] * n)], ["node", "text", "plain"])
def rows(n):
    return sum(b.num_rows for b in releasing(ngram_join._scatter_task(8))(batches(n)))
rows(1)
before = own()
assert rows(3000) >= 8
print(own() - before)
(batch,) = batches(1300)
tracemalloc.start()
ngram_join.token_sets(batch.column("text"))
print(tracemalloc.get_traced_memory()[1] / batch.column("text").nbytes)
"""
    root = str(Path(__file__).resolve().parents[2])
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120, check=True).stdout
    left, held = map(float, out.split())
    assert left < 30 and held < 8


def test_token_sets_do_not_depend_on_the_parts(monkeypatch):
    texts = pa.array(["a b c d e f a b c d e", None, "", "x y", "B c D e f g", "é " * 40, "a b c d e f a b c d e"])
    whole = ngram_join.token_sets(texts)
    monkeypatch.setattr(ngram_join, "SET_BYTES", 1)
    monkeypatch.setattr(blocks, "_HASHED_BYTES", 1)
    assert all(np.array_equal(a, b) and a.dtype == b.dtype for a, b in zip(whole, ngram_join.token_sets(texts), strict=True))
    assert [len(x) for x in ngram_join.token_sets(pa.array([], pa.string()))] == [0, 0, 0]
