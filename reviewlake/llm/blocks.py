"""Helpers for task-side numpy work on Arrow batches of texts.

A *block* is a run of rows whose texts hold a bounded number of bytes (a single longer text makes
a block of its own), so the memory of one task does not depend on the number of rows it reads.
All functions are pure; Spark partitions and shuffles the work.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes that separate words: space and \t \n \v \f \r.
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: ASCII A-Z to a-z, every other byte as it is.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)          # multiplier of the rolling hashes (odd, so invertible)
_ODD_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser on uint64, so that every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_HASHED_BYTES = 1 << 18
_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """0..n-1 powers of the multiplier (or of its inverse); kept between calls, grown by doubling."""
    have = _powers[kind]
    if len(have) < n:
        base = np.full(max(n, 1 << 16), _ODD if kind == "up" else _ODD_INVERSE, dtype=np.uint64)
        base[0] = 1
        have = np.cumprod(base, dtype=np.uint64)
        if len(have) <= 1 << 23:
            _powers[kind] = have
    return have[:n]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of values[s:e] for each pair; equal runs hash alike wherever they stand."""
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _power("up", len(values)), dtype=np.uint64, out=total[1:])
    h = (total[ends] - total[starts]) * _power("down", len(values) + 1)[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xA24BAED4963EE407))


def slices(batches: Iterable[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut so that the texts of a slice hold at most ``max_bytes`` (or it is one row)."""
    for batch in batches:
        size = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def release() -> None:
    """Gives back to the system what freed arrays left in the process. Python workers are reused and outlive their tasks, so
    they would hold it beside the memory of the stages that follow."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)          # of glibc only
    if trim is not None:
        trim(0)


def releasing(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """The function for ``mapInArrow``, which gives memory back when its input ends."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()
    return task


def releasing_group(run: Callable[[tuple, pa.Table], pa.Table]):
    """The function of key and rows for ``applyInArrow``, which gives memory back after each group."""
    def group(key: tuple, table: pa.Table) -> pa.Table:
        try:
            return run(key, table)
        finally:
            release()
    return group


def records(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    """One row at a time, for rows that hold large values (a whole batch of them would be large in Python)."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column and the offset of each row in them (null: empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def _last(ends: np.ndarray) -> np.ndarray:
    """1 at the last byte of each word's room (there the word is over), else 0."""
    out = np.zeros(ends[-1] if len(ends) else 0, dtype=np.int64)
    out[ends - 1] = 1
    return out


@dataclass
class Words:
    """Words of a block of texts: byte ranges in ``data``, and the first word of each row."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray          # n_rows + 1 positions in starts

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word, worked out over a bounded number of bytes at a time."""
        out = np.empty(len(self.starts), dtype=np.uint64)
        i = 0
        while i < len(out):
            j = max(i + 1, int(np.searchsorted(self.ends, self.starts[i] + _HASHED_BYTES, side="right")))
            low = self.starts[i]
            out[i:j] = range_hashes(_BYTE[self.data[low:self.ends[j - 1]]], self.starts[i:j] - low, self.ends[i:j] - low)
            i = j
        return out

    def joined(self) -> Words:
        """The same words with exactly one space after each."""
        size = self.ends - self.starts + 1
        ends = np.cumsum(size)
        starts = ends - size
        data = self.data[np.repeat(self.starts - starts, size) + np.arange(ends[-1] if len(ends) else 0) - _last(ends)]
        data[ends - 1] = 32
        return Words(data, starts, ends - 1, self.first)


def words(column: pa.Array, lower: bool = False, between: np.ndarray = _SPACE) -> Words:
    """Words of each row: runs of bytes that aren't in ``between``, A-Z lower-cased when asked for.

    By default words are ``[^\\x20\\x09-\\x0D]+``.
    """
    data, offsets = utf8(column)
    if lower:
        data = _LOWER[data]
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = ~between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)          # a row starts (or the last ends) before this byte
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def window_starts(first: np.ndarray, n: int) -> np.ndarray:
    """First word of every run of n consecutive words that lies in one row."""
    counts = np.maximum(np.diff(first) - (n - 1), 0)
    row = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + first[row]


def ngrams(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of n consecutive words that lies in one row, and the word it starts at.

    A row with fewer than n words has none.
    """
    if len(hashes) < n:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    at = window_starts(first, n)
    if n > 8:
        return range_hashes(hashes, at, at + n), at
    h = hashes[at]
    for j in range(1, n):
        h = h * _ODD + hashes[at + j]
    return mix64(h + np.uint64(n)), at


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; byte planes are kept together, so that small numbers shrink."""
    out = [len(arrays).to_bytes(1, "little")]
    body = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        out.append(a.dtype.char.encode() + len(a).to_bytes(8, "little"))
        body.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes() if len(a) else b"")
    return b"".join(out) + zstandard.ZstdCompressor(level=1).compress(b"".join(body))


def unpack(value: bytes) -> list[np.ndarray]:
    """What ``pack`` was given."""
    n = value[0]
    heads = [(np.dtype(chr(value[1 + 9 * i])), int.from_bytes(value[2 + 9 * i:10 + 9 * i], "little")) for i in range(n)]
    body = np.frombuffer(zstandard.ZstdDecompressor().decompress(value[1 + 9 * n:]), dtype=np.uint8)
    out, at = [], 0
    for kind, size in heads:
        planes = body[at:at + size * kind.itemsize].reshape(kind.itemsize, size)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += size * kind.itemsize
    return out


def deltas(ascending: np.ndarray) -> np.ndarray:
    """First value and then the steps of an ascending array (they pack well); ``np.cumsum`` restores it."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def runs(ordered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values."""
    if not len(ordered):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
    return starts, np.diff(np.append(starts, len(ordered)))


def spread(values: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """(bucket, positions) for values that are well-mixed uint64; positions keep their order."""
    bucket = (values >> np.uint64(40)) % np.uint64(n)
    order = np.argsort(bucket, kind="stable")
    starts, sizes = runs(bucket[order])
    return [(int(bucket[order[s]]), order[s:s + z]) for s, z in zip(starts, sizes, strict=True)]
