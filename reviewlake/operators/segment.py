"""Word segmentation with compounds learned from the corpus.

Learning: a run of 2 to ``max_length`` words is a compound if it occurs ``MIN_COUNT`` times and its *gain*, the
log-probability of the run less those of its words by themselves, is at least ``MIN_GAIN``. Counts are aggregates over
the corpus, combined inside each task.

Segmentation: among all ways to cut a text into words and compounds, the most probable one is the one whose
compounds, which may not overlap, have the largest total gain. A row needs only the compounds that occur in it: they are
joined by their words (no table of compounds is held whole by a task), and a best path through the row's lattice
(Viterbi) chooses among them. Gains are whole millionths, so sums are exact. Of equally good paths the one that
takes the compound that ends last is chosen, and of those that end together the shorter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.session import cut_lineage, ship_package

MIN_COUNT = 5
#: Millionths of a natural logarithm: about e^5 times as often as by chance.
MIN_GAIN = 5_000_000
MAX_LENGTH = 3
#: Words that a task handles at a time (or one row).
PIECE_WORDS = 1 << 19
#: Up to this gain, words that are too frequent for it are looked up (22,000 at most).
MOST_GAIN = 10_000_000
#: Most bits of the mask of known compounds (8 MB).
MASK_BITS = 1 << 26


def _pieces(column: pa.Array) -> Iterator[tuple[int, pa.Array, np.ndarray]]:
    """(first row, words, words of each row) of runs of rows that hold a bounded number of words."""
    size = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(size, dtype=np.int64), 0
    while at < len(column):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_WORDS, side="right")))
        yield at, column.slice(at, stop - at).flatten(), size[at:stop]
        at = stop


def _runs(words: pa.Array, size: np.ndarray, max_length: int) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray, np.ndarray]]:
    """Runs of 1 to ``max_length`` words of one row: (length, first word of each run, distinct runs joined by '_', which of
    these each run is, how often each occurs)."""
    coded = words.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    left = np.repeat(np.cumsum(size, dtype=np.int64), size) - np.arange(len(code))
    run = code.copy()                                            # the number of the run that starts at each word
    for length in range(1, max_length + 1):
        at = np.flatnonzero(left >= length)
        if length > 1:
            run[at] = run[at] * len(coded.dictionary) + code[at + length - 1]
        _, first, which, n = np.unique(run[at], return_index=True, return_inverse=True, return_counts=True)
        run[at] = which
        yield length, at, _joined(words, at[first], length), which, n


def _joined(words: pa.Array, at: np.ndarray, length: int) -> pa.Array:
    return pc.binary_join_element_wise(*[words.take(pa.array(at + i)) for i in range(length)], "_")


def _words_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w, n) of the words of each piece."""
    for batch in batches:
        for _, words, size in _pieces(batch.column("t")):
            for _, _, word, _, n in _runs(words, size, 1):
                yield pa.RecordBatch.from_arrays([word, pa.array(n, pa.int64())], ["w", "n"])


def _runs_task(max_length: int, min_gain: int, frequent: dict[str, float]):
    """(compound, length, n) of the runs of two or more words of each piece, without those whose words are too frequent for them.

    A run occurs at most as often as its rarest word, so its gain is at most what its other words lose.
    """
    names = pa.array(list(frequent), pa.string())
    loss = np.array([*frequent.values(), np.inf])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words, size in _pieces(batch.column("t")):
                of_word = loss[pc.fill_null(pc.index_in(words, value_set=names), len(names)).to_numpy(zero_copy_only=False)]
                for length, at, compound, which, n in _runs(words, size, max_length):
                    if length == 1:
                        continue
                    lost = np.sort(np.stack([of_word[at + i] for i in range(length)]), axis=0)[:-1].sum(axis=0)
                    own = np.zeros(len(n), dtype=bool)
                    own[which[lost * 1_000_000 >= min_gain - 10]] = True                       # 10: sums are rounded
                    yield pa.RecordBatch.from_arrays([compound.filter(pa.array(own)), pa.array(np.full(own.sum(), length, dtype=np.int32)),
                                                      pa.array(n[own], pa.int64())], ["compound", "length", "n"])
    return run


def _words(tokens_col: str) -> Column:
    return F.filter(F.coalesce(F.col(tokens_col), F.array().cast("array<string>")), lambda w: w.isNotNull() & (w != ""))


def learn(df: DataFrame, tokens_col: str, max_length: int = MAX_LENGTH, min_count: int = MIN_COUNT, min_gain: int = MIN_GAIN) -> DataFrame:
    """(compound, length, n, gain). Words that hold '_' are no part of a compound, so that names are unambiguous
    (punctuation is cleaned from texts before). Null and empty words are left out."""
    ship_package(df.sparkSession)
    rows = df.select(_words(tokens_col).alias("t"))
    single = cut_lineage(rows.mapInArrow(_words_task, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")), "segment-counts")
    total = F.broadcast(single.agg(F.sum("n").cast("double").alias("total")))                  # one row
    logs = cut_lineage(single.join(total).select("w", F.ln(F.col("n") / F.col("total")).alias("log")), "segment-logs")
    # At most e^(min_gain / 10^6) words are that frequent, as their shares add up to 1.
    frequent = {r.w: -r.log for r in logs.where(F.col("log") * 1_000_000 > -min_gain).collect()} if 0 < min_gain <= MOST_GAIN else {}
    counts = (rows.mapInArrow(_runs_task(max_length, min_gain, frequent), "compound string, length int, n long")
              .groupBy("compound", "length").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count))
    parts = counts.withColumn("w", F.explode(F.split("compound", "_")))
    apart = parts.join(logs, "w").groupBy("compound", "length", "n").agg(F.sum("log").alias("apart"), F.count(F.lit(1)).alias("found"))
    gain = F.round((F.ln(F.col("n") / F.col("total")) - F.col("apart")) * 1_000_000).cast("long")
    return (apart.where("found = length").join(total).withColumn("gain", gain).where(F.col("gain") >= min_gain)
            .select("compound", "length", "n", "gain"))


def best_path(n: int, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, length) of the chosen ones of the spans (start, length, gain) over n words.

    Only places where a span ends are visited, so rows one after the other can be handled as one.
    """
    ending: dict[int, list[tuple[int, int]]] = {}
    for start, length, gain in spans:
        if start + length <= n:
            ending.setdefault(start + length, []).append((length, gain))
    ends = sorted(ending)
    # Of each place: the best total up to it, the length taken there, and how many places come before what was taken.
    best, taken, before = [0], [], []
    for i, end in enumerate(ends):
        most, length_taken, places = best[i], 0, i
        for length, gain in sorted(ending[end], reverse=True):
            j = i
            while j and ends[j - 1] > end - length:
                j -= 1
            if best[j] + gain >= most:
                most, length_taken, places = best[j] + gain, length, j
        best.append(most)
        taken.append(length_taken)
        before.append(places)
    out, i = [], len(ends)
    while i:
        if taken[i - 1]:
            out.append((ends[i - 1] - taken[i - 1], taken[i - 1]))
        i = before[i - 1]
    return out[::-1]


def _segmented(tokens: pa.Array, spans: pa.Array) -> pa.Array:
    """The words of each row; the spans (at, length, gain) of the best path joined."""
    size = pc.list_value_length(tokens).to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.concatenate(([0], np.cumsum(size)))
    words = tokens.flatten()
    number = pc.fill_null(pc.list_value_length(spans), 0).to_numpy(zero_copy_only=False)
    at, length, gain = (x.to_pylist() for x in spans.flatten().flatten())
    start = (np.repeat(first[:-1], number) + np.array(at, dtype=np.int64) - 1).tolist()
    chosen = np.array(best_path(len(words), list(zip(start, length, map(int, gain), strict=True))), dtype=np.int64).reshape(-1, 2)
    stays, joins, place, made = np.ones(len(words), dtype=bool), np.zeros(len(words), dtype=bool), [], []
    for k in np.unique(chosen[:, 1]).tolist():
        own = chosen[chosen[:, 1] == k, 0]
        for i in range(1, k):
            stays[own + i] = False
        joins[own] = True
        place.append(own)
        made.append(_joined(words, own, k))
    out = words.filter(pa.array(stays))
    if made:
        made = pa.concat_arrays(made).take(pa.array(np.argsort(np.concatenate(place))))
        out = pc.replace_with_mask(out, pa.array(joins[stays]), made)
    kept = np.concatenate(([0], np.cumsum(stays)))
    return pa.ListArray.from_arrays(pa.array(kept[first].astype(np.int32)), out)


def _hashes(compounds: pa.Array, bits: int) -> np.ndarray:
    return (pd.util.hash_array(compounds.to_numpy(zero_copy_only=False), categorize=False) & np.uint64(bits - 1)).astype(np.int64)


def _mask(known: DataFrame) -> np.ndarray:
    """One bit for each hash value; those of known compounds are set. At most MASK_BITS, however many compounds there are."""
    bits = min(MASK_BITS, 1 << (64 + 16 * known.count()).bit_length())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_hashes(batch.column("compound"), bits))], ["bit"])

    cells = (known.select("compound").mapInArrow(run, "bit long").groupBy(F.shiftright("bit", 5).alias("cell"))
             .agg(F.bit_or(F.expr("shiftleft(1L, int(bit & 31))")).alias("set")).toArrow())
    mask = np.zeros(bits // 32, dtype=np.uint32)
    mask[cells.column("cell").to_numpy()] = cells.column("set").to_numpy().astype(np.uint32)
    return mask


def _found_task(max_length: int, mask: np.ndarray):
    """(_row, at, length, compound) of the runs whose bit is set: all that are known compounds, and few others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, words, size in _pieces(batch.column("_words")):
                begin = np.repeat(np.cumsum(size, dtype=np.int64) - size, size)
                of = np.repeat(batch.column("_row").to_numpy(zero_copy_only=False)[row:row + len(size)], size)
                for length, at, compound, which, _ in _runs(words, size, max_length):
                    bit = _hashes(compound, 32 * len(mask))
                    own = np.flatnonzero((mask[bit >> 5] >> (bit & 31).astype(np.uint32) & np.uint32(1))[which] == 1) if length > 1 else []
                    if len(own):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(of[at[own]]), pa.array((at[own] - begin[at[own]] + 1).astype(np.int32)),
                             pa.array(np.full(len(own), length, dtype=np.int32)), compound.take(pa.array(which[own]))],
                            ["_row", "at", "length", "compound"])
    return run


def segment(df: DataFrame, tokens_col: str, compounds: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """``df`` with the column words: its non-empty tokens, the compounds of the best path joined by '_'.

    ``compounds`` has (compound, length, gain), each compound once. Null tokens give no words. Most runs of words are no
    compound: those whose bit is not set in a mask of the known ones never leave their task.
    """
    ship_package(df.sparkSession)
    rows = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()), "segment-rows")
    known = cut_lineage(compounds.where("compound IS NOT NULL").select("compound", "gain"), "segment-compounds")
    runs = rows.select("_row", _words(tokens_col).alias("_words")).mapInArrow(
        _found_task(max_length, _mask(known)), "_row long, at int, length int, compound string")
    spans = (runs.join(known, "compound").groupBy("_row")
             .agg(F.collect_list(F.struct("at", "length", "gain")).alias("_spans")))          # at most a few for each word of the row
    words = F.arrow_udf(_segmented, T.ArrayType(T.StringType()))
    return rows.join(spans, "_row", "left").withColumn("words", words(_words(tokens_col), "_spans")).drop("_row", "_spans")
