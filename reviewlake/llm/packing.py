"""Bounded-space online packing of token sequences into fixed windows.

Each task keeps at most ``open_windows`` windows open. A document's tokens (with an end id) fill
whole windows first; the rest goes to the open window where it leaves the smallest gap. When it
fits nowhere and no more windows may be opened, the fullest one is emitted, its gap filled with a
cut of the piece if the gap is at least ``min_cut`` tokens, and the rest opens a new window. What is
still open at the end of a task is merged with the leftovers of ``merge_tasks`` - 1 other tasks by
best fit. A task holds one block of texts and its open windows, whatever the size of its input.

Token ids are those of the tokenizer on the whole text. A text may be cut, without a change of
its ids, at a space or a line end that stands alone between other characters; ids of the parts
between are looked up first, and only new parts go through the tokenizer.

Defined results: null text is empty, and an empty text is the end id alone. A null doc_id is kept.
Rows that repeat a doc_id are documents of their own, told apart by row_id. An empty table gives no
pieces. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import releasing, releasing_group, slices
from reviewlake.session import cut_lineage

WINDOW = 2048
OPEN_WINDOWS = 64
MIN_CUT = 16
MERGE_TASKS = 16
END_ID = 1
#: Entries of a worker's table of known parts; there are an old and a new one, for parts after a space and others.
KNOWN_PARTS = 1 << 18
_SAFE_SPACE = re.compile(r"(?<=\S) (?=\S)")
_RUN_OF_SPACES = re.compile(r"\s\s")


def tokenizer_path() -> str:
    """The public byte-level BPE file of this machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b if b in shown else 256 + hidden.index(b) for b in range(256)}


_LETTERS = _byte_letters()


class _Parts(dict):
    """Ids (as little-endian uint32 bytes) of a part that follows ``prefix``; fills itself.

    When it is full, it becomes the old generation, from which parts that are met again return.
    """

    def __init__(self, tokenizer, prefix: str, bare: _Parts | None = None):
        super().__init__()
        self.tokenizer, self.prefix, self.bare = tokenizer, prefix, self if bare is None else bare
        self.model, self.old, self.sign = tokenizer.model, {}, prefix.translate(_LETTERS)

    def __missing__(self, part: str) -> bytes:
        ids = self.old.get(part)
        if ids is None:
            ids = self._encode(part)
        if len(part) <= 48:
            if len(self) >= KNOWN_PARTS:
                self.old = dict(self)
                self.clear()
            self[part] = ids
        return ids

    def _encode(self, part: str) -> bytes:
        if part.isalpha():                          # one word for the tokenizer, so its model alone will do
            letters = self.sign + part if part.isascii() else (self.prefix + part).encode().decode("latin-1").translate(_LETTERS)
            tokens = self.model.tokenize(letters)
            return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        left, line_end, right = part.partition("\n")
        if line_end and left and right and not left[-1].isspace() and not right[0].isspace():
            return self[left] + self.bare[line_end] + self.bare[right]
        stem = part.rstrip(".,")
        if stem != part and stem and stem[-1].isalpha():
            return self[stem] + self.bare[part[len(stem):]]
        return np.asarray(self.tokenizer.encode(self.prefix + part, add_special_tokens=False).ids, dtype="<u4").tobytes()


class Encoder:
    """Token ids of whole texts as little-endian uint32 bytes."""

    _shared: dict[str, Encoder] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self.bare = _Parts(tokenizer, "")
        self.spaced = _Parts(tokenizer, " ", self.bare)

    @classmethod
    def shared(cls, path: str | None) -> Encoder:
        """One encoder per worker process and file."""
        path = path or tokenizer_path()
        if path not in cls._shared:
            cls._shared[path] = cls(path)
        return cls._shared[path]

    def ids(self, text: str) -> bytes:
        parts = _SAFE_SPACE.split(text) if _RUN_OF_SPACES.search(text) else text.split(" ")
        return (self.bare[parts[0]] if parts[0] else b"") + b"".join(map(self.spaced.__getitem__, parts[1:]))


class OpenWindows:
    """Online packer of one task; ``emit`` gets (number, pieces) of each finished window."""

    def __init__(self, window: int, most: int, min_cut: int, emit):
        self.window, self.most, self.min_cut, self.emit = window, most, min_cut, emit
        self.gaps: list[tuple[int, int]] = []                # (gap, number), ascending
        self.pieces: dict[int, list] = {}
        self.number = 0

    def _open(self) -> int:
        self.number += 1
        self.pieces[self.number] = []
        return self.number

    def _put(self, number: int, gap: int, doc, start: int, length: int) -> None:
        self.pieces[number].append((doc, start, length, self.window - gap))
        if gap == length:
            self.emit(number, self.pieces.pop(number))
        else:
            insort(self.gaps, (gap - length, number))

    def add(self, doc, length: int) -> None:
        start = 0
        while length - start >= self.window:
            self._put(self._open(), self.window, doc, start, self.window)
            start += self.window
        rest = length - start
        if not rest:
            return
        at = bisect_left(self.gaps, (rest, 0))
        if at < len(self.gaps):
            gap, number = self.gaps.pop(at)
            self._put(number, gap, doc, start, rest)
            return
        if len(self.gaps) >= self.most:
            gap, number = self.gaps.pop(0)
            if gap >= self.min_cut:
                self._put(number, gap, doc, start, gap)
                start, rest = start + gap, rest - gap
            else:
                self.emit(number, self.pieces.pop(number))
        self._put(self._open(), self.window, doc, start, rest)

    def leftovers(self) -> Iterator[tuple[int, list]]:
        yield from sorted(self.pieces.items())


def merge(lengths: list[int], window: int) -> list[tuple[int, int]]:
    """(window number, offset) of each piece: longest first, each where it leaves the smallest gap."""
    gaps: list[tuple[int, int]] = []
    place, opened = [(0, 0)] * len(lengths), 0
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        at = bisect_left(gaps, (lengths[i], 0))
        if at < len(gaps):
            gap, number = gaps.pop(at)
        else:
            gap, number, opened = window, opened, opened + 1
        place[i] = (number, window - gap)
        if gap > lengths[i]:
            insort(gaps, (gap - lengths[i], number))
    return place


_SCHEMA = ("row_id long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
           "offset long, task int, open boolean")


def _pack_task(window: int, most: int, min_cut: int, path: str | None, end_id: int, with_ids: bool):
    names = [x.split()[0] for x in _SCHEMA.split(",")] + ["ids"] * with_ids
    kinds = [pa.int64()] * 8 + [pa.int32(), pa.bool_()] + [pa.list_(pa.int32())] * with_ids
    end = np.asarray([end_id], dtype="<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = Encoder.shared(path), TaskContext.get().partitionId()
        rows: list[tuple] = []

        def emit(number: int, pieces: list, still_open: bool = False) -> None:
            for (row_id, doc_id, ids), start, length, offset in pieces:
                own = ids[4 * start:4 * (start + length)]
                rows.append((row_id, doc_id, start, length, zlib.crc32(own), len(ids) // 4, (task << 40) + number,
                             offset, task, still_open) + ((np.frombuffer(own, "<u4").astype(np.int32),) if with_ids else ()))

        def record() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)
            rows.clear()
            return out

        packer, at = OpenWindows(window, most, min_cut, emit), task << 40
        for block in slices(batches, "text", 4 << 20):
            for doc_id, text in zip(block.column("doc_id").to_pylist(), block.column("text").to_pylist(), strict=True):
                ids = encoder.ids(text or "") + end
                packer.add((at, doc_id, ids), len(ids) // 4)
                at += 1
                if len(rows) >= 20_000:
                    yield record()
        for number, pieces in packer.leftovers():
            emit(number, pieces, True)
        if rows:
            yield record()
    return run


def _merge_task(window: int):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        place = merge(table.column("length").to_pylist(), window)
        first = (1 << 62) + (key[0].as_py() << 40)
        for name, values in (("sequence_id", [first + n for n, _ in place]), ("offset", [o for _, o in place])):
            table = table.set_column(table.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return table.drop_columns(["key"])
    return run


def pack_documents(docs: DataFrame, window: int = WINDOW, open_windows: int = OPEN_WINDOWS, min_cut: int = MIN_CUT,
                   merge_tasks: int = MERGE_TASKS, path: str | None = None, end_id: int = END_ID,
                   with_ids: bool = False) -> DataFrame:
    """One row per piece: its place in the document and in its sequence; with the ids if asked for."""
    schema = _SCHEMA + (", ids array<int>" if with_ids else "")
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    pieces = cut_lineage(narrow.mapInArrow(
        releasing(_pack_task(window, open_windows, min_cut, path, end_id, with_ids)), schema), "packed")
    left = pieces.where("open").withColumn("key", F.floor(F.col("task") / merge_tasks))
    merged = left.groupBy("key").applyInArrow(releasing_group(_merge_task(window)), schema)
    return pieces.where("NOT open").unionByName(merged).drop("task", "open")
