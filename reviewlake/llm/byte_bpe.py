"""Byte-level BPE encoding and decoding with the ``tokenizers`` library over Arrow batches.

A rank file (one line for each token: base64 of its bytes, and its rank) is all there is to build
the tokenizer from: every byte stands as a letter, tokens are strings of such letters, and the merge
that makes a token is the last step of merging its own bytes by rank. A text is split by the public
pattern, each piece that is a token as a whole gets its id, and others are merged.

Tokens are runs of bytes, not of characters. Their byte lengths and the character that each byte
belongs to give the offsets of every token in code points; a token that starts or ends inside
a character covers that character. Decoding puts the bytes of the ids together through the
reversed byte table first and reads characters from the whole, so characters that are split over
tokens come back; what is no whole character at either end of a slice of ids is left as bytes.

Texts are cut in pieces where white space follows another character: no match of the pattern lies
across such a place, so ids of the pieces, end to end, are those of the whole text. Each distinct piece of a block passes
through the tokenizer once (most words of a block are repeats), and rows gather the ids of their pieces.

Defined results: null text is empty and has no ids; null ids decode to no bytes; an id that is not in the
table is an error. Rows that repeat a doc_id are rows of their own, null doc_ids are kept, an
empty table gives no rows. ``encode`` and ``decode`` keep doc_id and what they make; extra columns
are ignored. A task holds a block of texts or ids (a longer row is a block of its own).
"""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import slices, utf8

BLOCK_BYTES = 4 << 20
#: Pieces that pass through the tokenizer as one text.
JOINED_PIECES = 4096
#: White space of the pattern (Python's also has the four separators) with what follows, or at the end of a text.
_PIECE = re.compile(r"[^\S\x1c-\x1f]*[\S\x1c-\x1f]+|[^\S\x1c-\x1f]+")
#: Ids of a block that is decoded at once.
BLOCK_IDS = 1 << 18


def ranks_path() -> str:
    """The public rank file of this machine."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def byte_letters() -> list[str]:
    """The letter of each byte: itself where it is printable, else the next one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        letters.setdefault(b, chr(256 + len(letters) - len(shown)))
    return [letters[b] for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def last_merge(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge gives this one: its bytes merged by rank until two are left."""
    parts = [token[i:i + 1] for i in range(len(token))]
    none = len(ranks)
    while len(parts) > 2:
        at = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], none))
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return parts[0], parts[1]


class Codec:
    """Tokenizer and byte table of a rank file."""

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"         # Spark gives every core a task
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers
        ranks = read_ranks(path)
        letters = byte_letters()
        word = lambda token: "".join(letters[b] for b in token)
        order = sorted(ranks, key=ranks.get)
        merges = [tuple(map(word, last_merge(t, ranks))) for t in order if len(t) > 1]
        self.tokenizer = Tokenizer(models.BPE(vocab={word(t): r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.Split(Regex(pattern), "isolated"),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # The reversed byte table: letters of the vocabulary back to bytes, all tokens end to end.
        back = {letter: b for b, letter in enumerate(letters)}
        vocabulary = self.tokenizer.get_vocab()
        tokens = [b""] * (max(vocabulary.values()) + 1)
        for letters_of, i in vocabulary.items():
            tokens[i] = bytes(back[x] for x in letters_of)
        self.lengths = np.asarray([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        known: dict[str, int] = {}
        code, pieces = [], np.zeros(len(texts) + 1, dtype=np.int64)
        for i, text in enumerate(texts):
            code += [known.setdefault(p, len(known)) for p in _PIECE.findall(text)]
            pieces[i + 1] = len(code)
        flat, start, size = self._encode_pieces(list(known))
        code = np.asarray(code, dtype=np.int64)
        ends = np.concatenate(([0], np.cumsum(size[code])))
        ids = flat[np.repeat(start[code] - ends[:-1], size[code]) + np.arange(ends[-1])]
        return np.split(ids, ends[pieces[1:-1]]) if texts else []

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All ids end to end, and where those of each piece start and how many they are.

        Pieces that start with white space and end without pass through the tokenizer joined, as they would stand in a
        text; the bytes of the ids tell them apart again. Others (first or last of a text) pass one by one.
        """
        alone = np.fromiter((p[0] not in " \n\t" or p.isspace() for p in pieces), dtype=bool, count=len(pieces))
        together = [pieces[i] for i in np.flatnonzero(~alone)]
        texts = ["".join(together[i:i + JOINED_PIECES]) for i in range(0, len(together), JOINED_PIECES)]
        texts += [pieces[i] for i in np.flatnonzero(alone)]
        found = [np.asarray(e.ids, dtype=np.int32) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        flat = np.concatenate(found) if found else np.zeros(0, np.int32)
        order = np.concatenate([np.flatnonzero(~alone), np.flatnonzero(alone)])
        last_byte = np.cumsum(np.fromiter((len(pieces[i].encode()) for i in order), dtype=np.int64, count=len(order)))
        last_id = np.searchsorted(np.cumsum(self.lengths[flat]), last_byte) + 1
        start, size = np.empty(len(pieces), dtype=np.int64), np.empty(len(pieces), dtype=np.int64)
        size[order] = np.diff(last_id, prepend=0)
        start[order] = last_id - size[order]
        return flat, start, size

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of all ids, end to end."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths) or not self.lengths[ids].all()):
            raise ValueError("an id that is not in the rank file")
        size = self.lengths[ids]
        ends = np.cumsum(size)
        return self.bytes[np.repeat(self.starts[ids] - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)]


@lru_cache(maxsize=4)
def codec(path: str | None = None, pattern: str | None = None) -> Codec:
    """One for each worker process, file and pattern."""
    if pattern is None:
        import public_tokenizers
        pattern = public_tokenizers.PATTERN
    return Codec(path or ranks_path(), pattern)


def character_offsets(data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First code point and end of each token, from the UTF-8 bytes and the byte lengths of the tokens."""
    character = np.cumsum((data & 0xC0) != 0x80) - 1             # of each byte
    ends = np.cumsum(sizes)
    return character[ends - sizes], character[ends - 1] + 1


def _lists(values: list[np.ndarray], lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, kind))


def _encode_task(path: str | None, pattern: str | None, offsets: bool):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for block in slices(batches, "text", BLOCK_BYTES):
            column = block.column("text")
            ids = own.encode(["" if t is None else t for t in column.to_pylist()])
            lengths = np.asarray([len(x) for x in ids])
            out = {"doc_id": block.column("doc_id"), "ids": _lists(ids, lengths, pa.int32())}
            if offsets:
                data, edges = utf8(column)
                found = [character_offsets(data[edges[i]:edges[i + 1]], own.lengths[x]) for i, x in enumerate(ids)]
                for j, name in enumerate(("starts", "ends")):
                    out[name] = _lists([f[j].astype(np.int32) for f in found], lengths, pa.int32())
            yield pa.RecordBatch.from_pydict(out)
    return run


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, offsets: bool = True) -> DataFrame:
    """doc_id, ids, and (unless switched off) the code points that each token starts and ends at."""
    schema = "doc_id long, ids array<int>" + (", starts array<int>, ends array<int>" if offsets else "")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_encode_task(path, pattern, offsets), schema)


def _whole_characters(data: bytes) -> tuple[int, int]:
    """Bytes before the first, and up to the end of the last, whole character of a slice of UTF-8."""
    head = 0
    while head < min(3, len(data)) and data[head] & 0xC0 == 0x80:
        head += 1
    for back in range(1, min(4, len(data) - head) + 1):
        lead = data[-back]
        if lead & 0xC0 != 0x80:
            need = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            return head, len(data) - (back if need > back else 0)
    return head, len(data)


def _id_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order, cut so that a slice holds a bounded number of ids (or one row)."""
    for batch in batches:
        counts = batch.column("ids").value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
        ends, at = np.cumsum(counts, dtype=np.int64), 0
        while at < batch.num_rows:
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BLOCK_IDS, side="right")))
            yield batch.slice(at, stop - at)
            at = stop


def _decode_task(path: str | None, pattern: str | None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path, pattern)
        for block in _id_blocks(batches):
            column = block.column("ids")
            ids = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            edges = np.concatenate(([0], np.cumsum(column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
            data = own.decode(ids)
            token_ends = np.concatenate(([0], np.cumsum(own.lengths[ids])))
            inside = np.concatenate(([0], np.cumsum((data[token_ends[:-1]] & 0xC0) == 0x80)))
            rows = [data[token_ends[a]:token_ends[b]].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            whole = [_whole_characters(r) for r in rows]
            yield pa.RecordBatch.from_arrays([
                block.column("doc_id"), pa.array(rows, pa.binary()), pa.array([a for a, _ in whole], pa.int32()),
                pa.array([len(r) - b for r, (_, b) in zip(rows, whole, strict=True)], pa.int32()),
                pa.array(inside[edges[1:]] - inside[edges[:-1]], pa.int64())],
                ["doc_id", "decoded", "head_bytes", "tail_bytes", "n_split"])
    return run


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, decoded (bytes), head_bytes and tail_bytes (of characters cut off at the ends of a slice of ids:
    0 for a whole text), n_split (tokens that start inside a character). ``text_of`` gives the characters."""
    rows = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return rows.mapInArrow(_decode_task(path, pattern), "doc_id long, decoded binary, head_bytes int, tail_bytes int, n_split long")


def text_of(decoded: DataFrame) -> DataFrame:
    """With the column text: the whole characters of the decoded bytes."""
    size = F.octet_length("decoded") - F.col("head_bytes") - F.col("tail_bytes")
    return decoded.withColumn("text", F.substring("decoded", F.col("head_bytes") + 1, size).cast("string"))


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, ids, decoded: encoding and then decoding of every text in one pass, ids beside what they decode to."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    encode_, decode_ = _encode_task(path, pattern, False), _decode_task(path, pattern)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for encoded in encode_(batches):
            at = 0
            for back in decode_(iter([encoded])):
                yield back.append_column("ids", encoded.column("ids").slice(at, back.num_rows))
                at += back.num_rows
    return rows.mapInArrow(run, "doc_id long, decoded binary, head_bytes int, tail_bytes int, n_split long, ids array<int>")
