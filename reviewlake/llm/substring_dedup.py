"""Removal of repeated passages by super-k-mer partitioning.

A window is ``k`` consecutive words of one document. Its minimiser is the smallest hash among its
runs of ``m`` words. Consecutive windows that share a minimiser travel as one packed string to the
minimiser's bucket; windows of equal words share their minimiser, so they meet in one bucket,
where sorting counts them exactly (equal hashes are compared byte by byte). Each word covered by a
window that also starts elsewhere is removed.

Hot content is settled before anything travels. A first pass counts windows and m-word runs in each
task; what holds at least 1/HEAVY of a task's windows is summed over all tasks, and at most HEAVY
windows and HEAVY runs become a bounded table. A heavy window is known to repeat and
doesn't travel; a heavy run is the minimiser of a window only if all its runs are heavy, and such a
window goes to a bucket by its own hash. So no bucket gets more of one content than about 1/HEAVY
of all windows, and buckets are sized by the total of words.

Defined results: null or empty text has no words, its kept text is empty. A row is known by its
doc_id (which may be null) and its text; rows that repeat both are two occurrences, and both lose
what the other has. Texts with fewer than ``k`` words lose nothing. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import Words, ngrams, pack, range_hashes, runs, slices, spread, unpack, words
from reviewlake.session import cut_lineage

WINDOW_WORDS = 35
MINIMISER_WORDS = 3
HEAVY = 1 << 16
LEAST_HEAVY = 8
BLOCK_BYTES = 4 << 20
#: Packed text (before compression) that one bucket is meant to hold.
BUCKET_BYTES = 6 << 20


def _window_bytes(w: Words, at: int, k: int) -> bytes:
    """Words at..at+k-1, joined by one space; ``w`` is joined."""
    return w.data[w.starts[at]:w.ends[at + k - 1]].tobytes()


def _count_task(k: int, m: int):
    """Heavy windows (kind 1, with their text) and m-word runs (kind 0) of a task, and its words (kind 2)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, size, seen = 0, 0, {0: [], 1: []}
        text: dict[int, bytes] = {}
        for block in slices(batches, "text", BLOCK_BYTES):
            w = words(block.column("text")).joined()
            h = w.hashes()
            total, size = total + len(h), size + len(w.data)
            for kind, n in ((0, m), (1, k)):
                value, at = ngrams(h, w.first, n)
                value, where, count = np.unique(value, return_index=True, return_counts=True)
                often = count >= max(LEAST_HEAVY, len(at) // HEAVY)
                seen[kind].append((value[often], count[often]))
                if kind:
                    for v, i in zip(value[often].tolist(), at[where[often]].tolist(), strict=True):
                        text.setdefault(v, _window_bytes(w, i, k))
        rows = [(2, 0, total, None), (3, 0, size, None)]
        for kind, found in seen.items():
            if found:
                value = np.concatenate([x[0] for x in found])
                count = np.concatenate([x[1] for x in found])
                value, back = np.unique(value, return_inverse=True)
                count = np.bincount(back, weights=count, minlength=len(value)).astype(np.int64)
                keep = count >= max(LEAST_HEAVY, total // HEAVY)
                rows += [(kind, int(v), int(c), text.get(v) if kind else None)
                         for v, c in zip(value[keep].tolist(), count[keep], strict=True)]
        kind, value, count, window = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(np.array(value, dtype=np.uint64).view(np.int64)),
             pa.array(count, pa.int64()), pa.array(window, pa.binary())], ["kind", "value", "n", "window"])
    return run


class Heavy:
    """The bounded table of heavy windows and heavy runs."""

    def __init__(self, runs_: np.ndarray, windows: np.ndarray, texts: list[bytes]):
        self.runs = np.sort(runs_)
        by = np.argsort(windows)
        self.windows, self.texts = windows[by], [texts[i] for i in by]

    def is_run(self, hashes: np.ndarray) -> np.ndarray:
        return _among(self.runs, hashes)[0]

    def is_window(self, w: Words, hashes: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
        """Whether the window of each hash is a heavy one, by its words."""
        found, place = _among(self.windows, hashes)
        for i in np.flatnonzero(found):
            found[i] = _window_bytes(w, at[i], k) == self.texts[place[i]]
        return found


def _among(ordered: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(ordered):
        return np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=np.int64)
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values, place


def minimisers(order: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Smallest of order[i:i+width] for each i of ``at``."""
    low, size = order, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    return np.minimum(low[at], low[at + width - size])


def super_kmers(w: Words, heavy: Heavy, k: int, m: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, number of windows, bucket hash) of the packed strings of a block."""
    h = w.hashes()
    window, at = ngrams(h, w.first, k)
    if not len(at):
        return at, at, window
    run = range_hashes(h, np.arange(len(h) - m + 1), np.arange(m, len(h) + 1))
    last = np.uint64(1) << np.uint64(63)
    low = minimisers((run >> np.uint64(1)) | np.where(heavy.is_run(run), last, np.uint64(0)), at, k - m + 1)
    target = np.where(low >= last, window, low)              # all its runs are heavy: by the window itself
    go = ~heavy.is_window(w, window, at, k)
    joined = np.zeros(len(at), dtype=bool)
    joined[1:] = go[1:] & go[:-1] & (at[1:] == at[:-1] + 1) & (target[1:] == target[:-1])
    first = np.flatnonzero(go & ~joined)
    length = np.diff(np.append(np.cumsum(joined & go)[first], np.count_nonzero(joined & go))) + 1 if len(first) else first
    return at[first], length, target[first] << np.uint64(1)


def _scatter_task(k: int, m: int, heavy, n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, "text", BLOCK_BYTES):
            w = words(block.column("text")).joined()
            first, length, target = super_kmers(w, heavy.value, k, m)
            row = np.searchsorted(w.first, first, side="right") - 1
            start, end = w.starts[first] if len(first) else first, w.ends[first + length + k - 2] if len(first) else first
            ids, keys = (block.column(c).to_numpy(zero_copy_only=False) for c in ("id0", "key"))
            buckets, values = [], []
            for bucket, own in spread(target, n_buckets):
                size = end[own] - start[own] + 1
                stop = np.cumsum(size)
                data = w.data[np.repeat(start[own] - (stop - size), size) + np.arange(stop[-1])]
                docs, doc = np.unique(row[own], return_inverse=True)
                buckets.append(bucket)
                values.append(pack(data, length[own].astype(np.uint32), (first[own] - w.first[row[own]]).astype(np.uint32),
                                   doc.astype(np.uint32), ids[docs], keys[docs]))
            if buckets:
                yield pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(values, pa.binary())],
                                                 ["bucket", "packed"])
    return run


def repeated(w: Words, k: int) -> np.ndarray:
    """For each window of the rows of ``w``, in order: whether its words start at another place too."""
    value, at = ngrams(w.hashes(), w.first, k)
    order = np.argsort(value, kind="stable")
    start, size = runs(value[order])
    out = np.zeros(len(at), dtype=bool)
    many = size > 1
    for s, z in zip(start[many].tolist(), size[many].tolist(), strict=True):
        own = order[s:s + z]
        texts = [_window_bytes(w, i, k) for i in at[own]]
        if all(t == texts[0] for t in texts):
            out[own] = True
        else:                                               # different words with one hash
            out[own] = [texts.count(t) > 1 for t in texts]
    return out


def _count_bucket(k: int):
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(v) for v in table.column("packed").to_pylist()]
        data, length, first, doc, ids, keys = (
            np.concatenate([p[i] for p in parts]) for i in range(6))
        shift = np.cumsum([0] + [len(p[4]) for p in parts[:-1]])
        doc = doc + np.repeat(shift, [len(p[3]) for p in parts])
        space = np.flatnonzero(data == 32)                  # one after each word
        starts = np.append(0, space[:-1] + 1)
        n_words = length.astype(np.int64) + k - 1
        w = Words(data, starts, space, np.append(0, np.cumsum(n_words)))
        again = repeated(w, k)
        of = np.repeat(np.arange(len(length)), length)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(length.astype(np.int64)) - length, length)
        hit = np.flatnonzero(again)
        new = np.ones(len(hit), dtype=bool)
        new[1:] = (of[hit[1:]] != of[hit[:-1]]) | (hit[1:] != hit[:-1] + 1)
        begin = hit[new]
        end = hit[np.append(np.flatnonzero(new)[1:] - 1, len(hit) - 1)] if len(hit) else hit
        own = of[begin]
        return pa.table({"id0": pa.array(ids[doc[own]]), "key": pa.array(keys[doc[own]]),
                         "first": pa.array(first[own] + nth[begin], pa.int64()),
                         "last": pa.array(first[own] + nth[end] + k, pa.int64())})
    return run


def _remove_task(k: int, heavy, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in slices(batches, "text", BLOCK_BYTES):
            w = words(block.column("text")).joined()
            steps = np.zeros(len(w.starts) + 1, dtype=np.int64)
            window, at = ngrams(w.hashes(), w.first, k)
            hot = at[heavy.value.is_window(w, window, at, k)]
            np.add.at(steps, hot, 1)
            np.add.at(steps, hot + k, -1)
            spans = block.column("spans")
            lists = spans.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            base = np.repeat(w.first[:-1], lists)
            flat = spans.flatten()
            np.add.at(steps, base + flat.field("first").to_numpy(zero_copy_only=False), 1)
            np.add.at(steps, base + flat.field("last").to_numpy(zero_copy_only=False), -1)
            keep = np.cumsum(steps[:-1]) == 0
            kept = w.data[np.repeat(keep, w.ends - w.starts + 1)]
            bytes_ = np.append(0, np.cumsum(np.where(keep, w.ends - w.starts + 1, 0)))[w.first]
            texts = [kept[a:max(a, b - 1)].tobytes() for a, b in zip(bytes_[:-1], bytes_[1:], strict=True)]
            removed = w.counts - np.diff(np.append(0, np.cumsum(keep))[w.first])
            out = {"doc_id": block.column("doc_id"), "n_words": pa.array(w.counts, pa.int64()),
                   "n_removed": pa.array(removed, pa.int64()),
                   "kept_sha256": pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())}
            if with_text:
                out["kept_text"] = pa.array([t.decode() for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays(list(out.values()), list(out))
    return run


def heavy_content(docs: DataFrame, k: int, m: int) -> tuple[Heavy, int]:
    """The bounded table of hot content, and the bytes of all joined words."""
    counted = cut_lineage(docs.select("text").mapInArrow(
        _count_task(k, m), "kind int, value long, n long, window binary"), "heavy")
    summed = counted.groupBy("kind", "value").agg(F.sum("n").alias("n"), F.first("window", ignorenulls=True).alias("window"))
    top = {i: summed.where(F.col("kind") == i).orderBy(F.desc("n"), "value").limit(HEAVY).collect() for i in (0, 1)}
    size = counted.where("kind = 3").agg(F.sum("n")).first()[0] or 0
    as_hash = lambda rows: np.array([r.value for r in rows], dtype=np.int64).view(np.uint64)
    return Heavy(as_hash(top[0]), as_hash(top[1]), [bytes(r.window) for r in top[1]]), size


def remove_repeats(docs: DataFrame, k: int = WINDOW_WORDS, m: int = MINIMISER_WORDS, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_removed, kept_sha256) and the kept text if asked for."""
    sc = docs.sparkSession.sparkContext
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    own = own.select("doc_id", "text", F.coalesce("doc_id", F.lit(-1)).alias("id0"),
                     F.xxhash64("doc_id", "text").alias("key"))
    table, size = heavy_content(own, k, m)
    heavy = sc.broadcast(table)
    n_buckets = max(1, -(-3 * size // BUCKET_BYTES))
    packed = own.select("id0", "key", "text").mapInArrow(_scatter_task(k, m, heavy, n_buckets), "bucket int, packed binary")
    spans = packed.groupBy("bucket").applyInArrow(_count_bucket(k), "id0 long, key long, first long, last long")
    by_row = (spans.groupBy("id0", "key").agg(F.collect_list(F.struct("first", "last")).alias("spans"))
              .withColumnsRenamed({"id0": "i", "key": "h"}))
    # Repeated rows find the spans of both; they are the same words.
    met = own.join(by_row, (F.col("id0") == F.col("i")) & (F.col("key") == F.col("h")), "left")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    return met.select("doc_id", "text", F.coalesce("spans", F.array().cast(
        "array<struct<first:bigint,last:bigint>>")).alias("spans")).mapInArrow(_remove_task(k, heavy, with_text), schema)
