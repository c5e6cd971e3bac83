"""Scores of texts by a weighted backoff automaton of smoothed word bigrams.

States are contexts (a word, or the start of a text); the root holds an arc for every word with
its add-one unigram log-probability. A state has an arc for each word seen after it in the learned
texts, weighted with the interpolated absolutely discounted probability, and one failure arc to
the root with its discounted share. Reading a text takes the arc of the next token if the state
has one, else the failure arc and the root's arc, adds the weights and moves to the token's state.

The model is never gathered: its counts live in buckets by hash. Texts are landed once as blocks of
bounded size in local word numbers. Each block sends its distinct words (and then its distinct
bigrams, by context) with their counts, packed, to the buckets; a bucket sums them and answers each
block, so a block gets the part of the automaton that its own texts walk. Contexts that hold more
than 1/HOT of all tokens are spread by bigram; their numbers of followers are summed apart (at
most HOT contexts). The discount is estimated from all counts of counts.

Tokens: words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, then one end per text. Words are known by
64-bit hashes. Defined results: null text is empty and has the end alone. Rows for which ``learn`` is
false or null are not learned from. When nothing is learned, every token has probability 1.
Repeated rows count, and are scored, each by itself. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlake.llm.blocks import deltas, mix64, pack, records, runs, slices, spread, unpack, words
from reviewlake.session import cut_lineage

BLOCK_BYTES = 4 << 20
#: Tokens of all texts for each bucket.
BUCKET_TOKENS = 3 << 18
HOT = 4096
#: Hashes of the end token and of the start context; no word has them but by chance.
END, START = np.uint64(0x3C79AC492BA7B653), np.uint64(0xD3833E804F4C574B)


def _land_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: ids of its rows, packed words, tokens, sizes and learn marks."""
    for block in slices(batches, "text", BLOCK_BYTES):
        w = words(block.column("text"), lower=True)
        vocabulary, number = np.unique(np.append(w.hashes(), END), return_inverse=True)
        n_rows = block.num_rows
        token = np.empty(len(w.starts) + n_rows, dtype=np.uint32)
        token[np.arange(len(w.starts)) + w.row] = number[:-1]
        token[w.first[1:] + np.arange(n_rows)] = number[-1]
        learn = block.column("learn").to_numpy(zero_copy_only=False).astype(np.uint8)
        value = pack(deltas(vocabulary), token, (w.counts + 1).astype(np.uint32), learn)
        yield pa.RecordBatch.from_arrays(
            [pa.array([block.column("doc_id").to_pylist()], pa.list_(pa.int64())),
             pa.array([len(token)], pa.int64()), pa.array([int((w.counts + 1)[learn > 0].sum())], pa.int64()),
             pa.array([value], pa.binary())], ["doc_ids", "n_tokens", "n_learned", "packed"])


class Block:
    """A landed block: vocabulary (hashes, ascending), tokens as numbers in it, sizes, learn marks."""

    def __init__(self, packed: bytes):
        v, self.token, self.size, self.learn = unpack(packed)
        self.vocabulary = np.cumsum(v, dtype=np.uint64)
        self.learned = np.repeat(self.learn > 0, self.size)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.token[self.learned], minlength=len(self.vocabulary))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (context, token) numbers, their learned counts, and the bigram of each token."""
        n = np.int64(len(self.vocabulary)) + 1
        context = np.empty(len(self.token), dtype=np.int64)
        context[1:] = self.token[:-1]
        context[np.cumsum(self.size) - self.size] = n - 1                 # the start context
        pair, of = np.unique(context * n + self.token, return_inverse=True)
        return pair // n, pair % n, np.bincount(of, weights=self.learned, minlength=len(pair)).astype(np.int64), of

    def context_hashes(self) -> np.ndarray:
        return np.append(self.vocabulary, START)


def _bigram_parts(block: Block, context: np.ndarray, token: np.ndarray, hot: np.ndarray, n_buckets: int):
    """(bucket, positions) of a block's distinct bigrams: by context, hot contexts by bigram."""
    c, t = block.context_hashes()[context], block.vocabulary[token]
    return spread(np.where(np.isin(c, hot), mix64(mix64(c) + t), mix64(c)), n_buckets)


def _sent(block: int, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([block] * len(parts), pa.int64()), pa.array([k for k, _ in parts], pa.int32()),
         pa.array([v for _, v in parts], pa.binary())], ["block", "bucket", "packed"])


def _send_words(n_buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in records(batches):
            b = Block(row["packed"])
            count = b.word_counts()
            yield _sent(row["block"], [(k, pack(deltas(b.vocabulary[own]), count[own].astype(np.uint32)))
                                       for k, own in spread(b.vocabulary, n_buckets)])
    return run


def _sum_words(n_learned: int):
    """Totals of a bucket's words to each block; words learned; hashes of hot words."""
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(v) for v in table.column("packed").to_pylist()]
        word, of = np.unique(np.concatenate([np.cumsum(p[0], dtype=np.uint64) for p in parts]), return_inverse=True)
        total = np.zeros(len(word), dtype=np.uint64)
        np.add.at(total, of, np.concatenate([p[1] for p in parts]).astype(np.uint64))
        hot = word[total > max(n_learned // HOT, 1)]
        stop = np.cumsum([len(p[0]) for p in parts])
        answers = [pack(total[of[e - len(p[0]):e]]) for e, p in zip(stop, parts, strict=True)]
        rest = len(parts) - 1
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"),
                         "packed": pa.array(answers, pa.binary()),
                         "n_types": pa.array([int((total > 0).sum())] + [0] * rest, pa.int64()),
                         "hot": pa.array([hot.view(np.int64).tolist()] + [[]] * rest, pa.list_(pa.int64()))})
    return run


def _send_bigrams(n_buckets: int, hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in records(batches):
            b = Block(row["packed"])
            context, token, count, _ = b.bigrams()
            parts = []
            for k, own in _bigram_parts(b, context, token, hot, n_buckets):
                first, length = runs(context[own])
                parts.append((k, pack(deltas(b.context_hashes()[context[own][first]]), length.astype(np.uint32),
                                      b.vocabulary[token[own]], count[own].astype(np.uint32))))
            yield _sent(row["block"], parts)
    return run


def _sum_bigrams(hot: np.ndarray):
    """Totals of a bucket's bigrams and numbers of followers of its contexts, to each block."""
    def run(table: pa.Table) -> pa.Table:
        parts = [unpack(v) for v in table.column("packed").to_pylist()]
        context = np.concatenate([np.repeat(np.cumsum(p[0], dtype=np.uint64), p[1]) for p in parts])
        follower = np.concatenate([p[2] for p in parts])
        count = np.concatenate([p[3] for p in parts]).astype(np.uint64)
        order = np.lexsort((follower, context))
        c, f = context[order], follower[order]
        new = np.ones(len(c), dtype=bool)
        new[1:] = (c[1:] != c[:-1]) | (f[1:] != f[:-1])
        bigram = np.empty(len(c), dtype=np.int64)
        bigram[order] = np.cumsum(new) - 1
        total = np.add.reduceat(count[order], np.flatnonzero(new)) if len(c) else count
        own_context = c[new]
        first, length = runs(own_context)
        followers = np.add.reduceat((total > 0).astype(np.int64), first) if len(first) else first
        each = np.repeat(followers, length)                                # of each distinct bigram's context
        answers, stop = [], np.cumsum([len(p[2]) for p in parts])
        for e, p in zip(stop, parts, strict=True):
            own = bigram[e - len(p[2]):e]
            start = np.cumsum(p[1].astype(np.int64)) - p[1]
            answers.append(pack(total[own], each[own[start]].astype(np.uint64)))
        names = own_context[first]
        is_hot = np.isin(names, hot)
        rest = len(parts) - 1
        return pa.table({
            "block": table.column("block"), "bucket": table.column("bucket"), "packed": pa.array(answers, pa.binary()),
            "once": pa.array([int((total == 1).sum())] + [0] * rest, pa.int64()),
            "twice": pa.array([int((total == 2).sum())] + [0] * rest, pa.int64()),
            "hot": pa.array([names[is_hot].view(np.int64).tolist()] + [[]] * rest, pa.list_(pa.int64())),
            "hot_followers": pa.array([followers[is_hot].tolist()] + [[]] * rest, pa.list_(pa.int64()))})
    return run


class Automaton:
    """The part of the automaton that a block walks: arcs by (state, token), failure and root weights."""

    def __init__(self, word_total: np.ndarray, n_learned: int, n_types: int, context: np.ndarray, token: np.ndarray,
                 bigram_total: np.ndarray, followers: np.ndarray, state_total: np.ndarray, discount: float):
        root = (word_total + 1.0) / (n_learned + n_types + 1.0)
        self.root = np.log10(root)
        seen = np.maximum(state_total, 1)
        share = np.where(state_total > 0, discount * followers / seen, 1.0)       # of each state's failure arc
        self.failure = np.log10(np.where(share > 0, share, 1.0))
        arc = np.maximum(bigram_total - discount, 0) / seen[context] + share[context] * root[token]
        self.arc = np.where(bigram_total > 0, np.log10(np.maximum(arc, 1e-300)), -np.inf)
        self.context, self.token = context, token

    def walk(self, bigram: np.ndarray) -> np.ndarray:
        """Weight of reading each token, given by its (state, token) number: its arc, or failure and root."""
        arc = self.arc[bigram]
        back = self.failure[self.context[bigram]] + self.root[self.token[bigram]]
        return np.where(np.isfinite(arc), arc, back)


def _answers(parts: list[tuple[int, np.ndarray]], rows: list[dict], n: int, i: int) -> np.ndarray:
    """The i-th array of the buckets' answers, put back in the block's order."""
    value = {r["bucket"]: r["packed"] for r in rows}
    out = np.zeros(n, dtype=np.float64)
    for k, own in parts:
        out[own] = unpack(value[k])[i]
    return out


def _score_task(n_buckets: int, n_learned: int, n_types: int, discount: float, hot: dict[int, int]):
    hot_names = np.array(sorted(hot), dtype=np.uint64)
    hot_followers = np.array([hot[int(x)] for x in hot_names], dtype=np.float64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in records(batches):
            b = Block(row["packed"])
            total = _answers(spread(b.vocabulary, n_buckets), row["words"], len(b.vocabulary), 0)
            context, token, _, of = b.bigrams()
            names = b.context_hashes()
            followers = np.zeros(len(names))
            bigram_total = np.zeros(len(context))
            value = {r["bucket"]: r["packed"] for r in row["bigrams"]}
            for k, own in _bigram_parts(b, context, token, hot_names, n_buckets):
                counts, n = unpack(value[k])
                bigram_total[own] = counts
                first, _ = runs(context[own])
                followers[context[own][first]] = n
            if len(hot_names):
                place = np.minimum(np.searchsorted(hot_names, names), len(hot_names) - 1)
                followers = np.where(hot_names[place] == names, hot_followers[place], followers)
            end = total[np.searchsorted(b.vocabulary, END)]
            states = np.append(total, end)                            # a text starts as often as it ends
            states[np.searchsorted(b.vocabulary, END)] = 0            # nothing follows an end
            machine = Automaton(total, n_learned, n_types, context, token, bigram_total, followers, states, discount)
            first = np.cumsum(b.size.astype(np.int64)) - b.size
            sums = lambda x, first=first: np.add.reduceat(x, first) if len(first) else first
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["doc_ids"], pa.int64()), pa.array(b.size, pa.int64()),
                 pa.array(sums((total[b.token] > 0).astype(np.int64)), pa.int64()),
                 pa.array(sums(machine.root[b.token]), pa.float64()), pa.array(sums(machine.walk(of)), pa.float64())],
                ["doc_id", "n_tokens", "n_known", "base_score", "score"])
    return run


def learn_and_score(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score): one row per row of ``docs``."""
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                      F.coalesce(learn, F.lit(False)).alias("learn"))
    blocks = cut_lineage(own.mapInArrow(_land_task, "doc_ids array<long>, n_tokens long, n_learned long, packed binary")
                         .withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    sums = blocks.agg(F.sum("n_tokens").alias("all"), F.sum("n_learned").alias("learned")).first()
    n_learned, n_buckets = sums.learned or 0, max(1, -(-(sums.all or 0) // BUCKET_TOKENS))
    sent = "block long, bucket int, packed binary"
    names = blocks.select("block", "packed")
    word = cut_lineage(names.mapInArrow(_send_words(n_buckets), sent).groupBy("bucket").applyInArrow(
        _sum_words(n_learned), sent + ", n_types long, hot array<long>"), "lm-words")
    n_types = word.agg(F.sum("n_types")).first()[0] or 0
    as_hash = lambda rows: np.array([r[0] for r in rows], dtype=np.int64).view(np.uint64)
    hot = np.append(as_hash(word.select(F.explode("hot")).collect()), START)               # at most HOT words
    bigram = cut_lineage(names.mapInArrow(_send_bigrams(n_buckets, hot), sent).groupBy("bucket").applyInArrow(
        _sum_bigrams(hot), sent + ", once long, twice long, hot array<long>, hot_followers array<long>"), "lm-bigrams")
    counts = bigram.agg(F.sum("once").alias("once"), F.sum("twice").alias("twice")).first()
    once, twice = counts.once or 0, counts.twice or 0
    discount = once / (once + 2 * twice) if once else 0.5
    discount = min(max(discount, 0.1), 0.95)
    followers = (bigram.select(F.explode(F.arrays_zip("hot", "hot_followers")).alias("h")).groupBy("h.hot")
                 .agg(F.sum("h.hot_followers").alias("n")).collect())
    hot_followers = {int(np.int64(r.hot).view(np.uint64)): int(r.n) for r in followers}
    for name in hot.tolist():
        hot_followers.setdefault(int(name), 0)
    answered = lambda x, c: x.groupBy("block").agg(F.collect_list(F.struct("bucket", "packed")).alias(c))
    met = blocks.join(answered(word, "words"), "block").join(answered(bigram, "bigrams"), "block")
    out = met.select("doc_ids", "packed", "words", "bigrams").mapInArrow(
        _score_task(n_buckets, n_learned, n_types, discount, hot_followers),
        "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return out.withColumn("train_tokens", F.lit(n_learned).cast("long"))
