"""TF-IDF postings of many long rows, kept in blocks (M1, M6 / J5 at size).

A block is a run of rows of a task. It holds each of its terms once, its postings as small numbers (term, tf), and how many of
its rows hold each term. Only terms of blocks are shuffled to find the document frequencies, not postings. Rows that are asked for are
dealt with their weights to a bounded number of groups; the blocks of a group stream past them, and the nth best scores found
so far travel from block to block. Of a block, the weights of terms that many of its rows hold are a matrix; the others are lists.

Ids must not repeat (``tfidf_terms`` sees to it). Null ids count as rows, but are neither asked for nor found.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.blocks import pack, records, releasing, unpack
from reviewlake.operators.topk import RANK_DIGITS
from reviewlake.session import cut_lineage, ship_package

#: Tokens of a block.
BLOCK_TOKENS = 1 << 22
#: Pairs of groups that the search is dealt into, if memory asks for no more; postings of rows asked for that a task holds.
GROUPS, ASKED_POSTINGS = 16, 1 << 22
#: Share of a block's rows from which a term is a column of its matrix, and the most columns.
COMMON, MOST_COMMON = 0.1, 512
#: Rows asked for that meet a block at a time.
BATCH = 64
SLACK = 1e-8


@dataclass(frozen=True)
class TermBlocks:
    """(blk, ids, body, terms) of ``n_rows`` rows; with ``unit``, weights are divided by the length of their row's vector."""

    blocks: DataFrame
    n_rows: int
    unit: bool = False

    def unit_weights(self) -> TermBlocks:
        return replace(self, unit=True)


def _strings(terms: pa.Array) -> bytes:
    terms = terms.cast(pa.large_string())
    offsets = np.frombuffer(terms.buffers()[1], dtype=np.int64)[terms.offset:terms.offset + len(terms) + 1] if len(terms) else np.zeros(1, np.int64)
    data = np.frombuffer(terms.buffers()[2], dtype=np.uint8) if len(terms) and terms.buffers()[2] is not None else np.zeros(0, np.uint8)
    return pack(np.diff(offsets).astype(np.int32), data[offsets[0]:offsets[-1]])


def _terms(value: bytes) -> pa.Array:
    sizes, data = unpack(value)
    offsets = np.append(0, np.cumsum(sizes, dtype=np.int64))
    return pa.LargeStringArray.from_buffers(len(sizes), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data)))


def _blocks_of(most: int):
    def block(ids: list, sizes: list, flats: list) -> pa.RecordBatch:
        coded = pa.concat_arrays(flats).dictionary_encode()
        flats.clear()
        n_terms = max(1, len(coded.dictionary))
        key = np.repeat(np.arange(sum(map(len, sizes))), np.concatenate(sizes))
        key *= n_terms
        key += coded.indices.to_numpy(zero_copy_only=False)
        key, tf = np.unique(key, return_counts=True)
        row, code = np.divmod(key, n_terms)
        del key
        held = np.bincount(code, minlength=len(coded.dictionary))
        by = np.argsort(-held, kind="stable")                    # frequent terms get small numbers
        code = np.argsort(by)[code]
        order = np.lexsort((code, row))
        code, tf = code[order], tf[order]
        counts = np.bincount(row, minlength=sum(map(len, sizes)))
        step = np.diff(code, prepend=0)
        first = (np.cumsum(counts) - counts)[counts > 0]
        step[first] = code[first]
        known = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays([
            pa.array([pack(pc.fill_null(known, 0).to_numpy(), known.is_valid().to_numpy(zero_copy_only=False).astype(np.uint8))], pa.binary()),
            pa.array([pack(counts.astype(np.int32), step.astype(np.int32), tf.astype(np.int32))], pa.binary()),
            pa.array([_strings(coded.dictionary.take(pa.array(by)))], pa.binary()), pa.array([pack(held[by].astype(np.int32))], pa.binary())],
            ["ids", "body", "terms", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, flats, n = [], [], [], 0
        for batch in batches:
            for part in (batch.slice(i, 512) for i in range(0, batch.num_rows, 512)):
                ids.append(part.column(0))
                sizes.append(part.column(1).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
                flats.append(part.column(1).flatten())
                n += len(flats[-1])
                if n >= most:
                    yield block(ids, sizes, flats)
                    ids, sizes, flats, n = [], [], [], 0
        if ids:
            yield block(ids, sizes, flats)
    return run


def build(df: DataFrame, id_col: str, tokens_col: str, n_rows: int) -> TermBlocks:
    """Blocks of (id, tokens)."""
    ship_package(df.sparkSession)
    tokens = F.coalesce(F.filter(tokens_col, lambda x: x.isNotNull()), F.array().cast("array<string>"))
    blocks = df.select(F.col(id_col).cast("long").alias("id"), tokens.alias("tokens")).mapInArrow(
        releasing(_blocks_of(BLOCK_TOKENS)), "ids binary, body binary, terms binary, held binary")
    return TermBlocks(cut_lineage(blocks.withColumn("blk", F.monotonically_increasing_id()), "term-blocks"), n_rows)


def _asked_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in records(batches):
        terms, held = _terms(row["terms"]), unpack(row["held"])[0]
        for i in range(0, len(held), 1 << 16):
            n = len(held[i:i + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, row["blk"])), pa.array(np.arange(i, i + n, dtype=np.int32)),
                                              terms.slice(i, n).cast(pa.string()), pa.array(held[i:i + n].astype(np.int64))],
                                             ["blk", "code", "term", "n"])


def _frequencies(table: pa.Table) -> pa.Table:
    code, df = table.column("code").to_numpy(), table.column("df").to_numpy()
    return pa.table({"blk": table.column("blk").slice(0, 1), "dfs": pa.array([pack(df[np.argsort(code)])], pa.binary())})


def _row_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for row in records(batches):
        ids, valid = unpack(row["ids"])
        at = np.flatnonzero(valid)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), row["blk"])), pa.array(at.astype(np.int32)), pa.array(ids[at])],
                                         ["blk", "at", "id"])


def _postings(row: dict, n_rows: int, unit: bool) -> tuple:
    """Ids, validity, row, term number and weight of the postings of a block."""
    ids, valid = unpack(row["ids"])
    counts, step, tf = unpack(row["body"])
    code = np.cumsum(step, dtype=np.int64)
    first = (np.cumsum(counts, dtype=np.int64) - counts)[counts > 0]
    code -= np.repeat(np.append(0, code)[first], counts[counts > 0])          # numbers start anew in every row
    at = np.repeat(np.arange(len(ids)), counts)
    weight = tf * np.log((n_rows + 1) / (unpack(row["dfs"])[0] + 1.0))[code]
    if unit:
        length = np.sqrt(np.bincount(at, weights=weight * weight, minlength=len(ids)))[at]
        weight = np.divide(weight, length, out=np.zeros_like(weight), where=length > 0)
    return ids, valid.astype(bool), at, code, weight


def _asked_rows(n_rows: int, unit: bool):
    """Adds the postings of the rows asked for of every block, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in records(batches):
            asked, n = None, 0
            if row["asked"]:
                ids, _, at, code, weight = _postings(row, n_rows, unit)
                wanted = np.zeros(len(ids), dtype=bool)
                wanted[row["asked"]] = True
                mine = wanted[at]
                known, code = np.unique(code[mine], return_inverse=True)
                n = int(mine.sum())
                asked = [pack(ids[at[mine]], code.astype(np.int32), weight[mine]), _strings(_terms(row["terms"]).take(pa.array(known)))]
            yield pa.RecordBatch.from_arrays([pa.array([row["blk"]]), *(pa.array([row[c]], pa.binary()) for c in ("ids", "body", "terms", "dfs")),
                                              pa.array([asked and asked[0]], pa.binary()), pa.array([asked and asked[1]], pa.binary()),
                                              pa.array([n], pa.int64())],
                                             ["blk", "ids", "body", "terms", "dfs", "asked", "asked_terms", "n_asked"])
    return run


class _Asked:
    """The rows asked for of a group, and their n best so far."""

    def __init__(self, rows: list[dict], n: int):
        parts = [unpack(r["asked"]) for r in rows]
        terms = [_terms(r["asked_terms"]) for r in rows]
        coded = pa.concat_arrays(terms).dictionary_encode()
        numbers, base = coded.indices.to_numpy(zero_copy_only=False), np.cumsum([0, *map(len, terms)])
        ids = np.concatenate([p[0] for p in parts])
        term = np.concatenate([numbers[base[i] + p[1]] for i, p in enumerate(parts)])
        order = np.argsort(ids, kind="stable")
        self.terms, self.n = coded.dictionary, n
        self.ids, self.row = np.unique(ids[order], return_inverse=True)
        self.term, self.weight = term[order], np.concatenate([p[2] for p in parts])[order]
        self.first = np.searchsorted(self.row, np.arange(len(self.ids) + 1))
        empty = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0)
        self.best = [empty for _ in range(0, len(self.ids), BATCH)]
        self.nth = np.full(len(self.ids), -np.inf)

    def meet(self, row: dict, n_rows: int, unit: bool) -> None:
        ids, valid, at, code, weight = _postings(row, n_rows, unit)
        number = pc.fill_null(pc.index_in(_terms(row["terms"]), value_set=self.terms), -1).to_numpy(zero_copy_only=False)[code]
        mine = (number >= 0) & valid[at]
        at, term, weight = at[mine], number[mine], weight[mine]
        count = np.bincount(term, minlength=len(self.terms))
        common = np.flatnonzero(count > COMMON * len(ids))
        common = common[np.argsort(-count[common], kind="stable")[:MOST_COMMON]]
        column = np.full(len(self.terms), -1)
        column[common] = np.arange(len(common))
        dense = column[term] >= 0
        matrix = np.zeros((len(ids), len(common)))
        matrix[at[dense], column[term[dense]]] = weight[dense]
        order = np.flatnonzero(~dense)[np.argsort(term[~dense], kind="stable")]
        lists = at[order], weight[order], np.bincount(term[order], minlength=len(self.terms))
        low = np.cumsum(lists[2]) - lists[2]
        for b, a in enumerate(range(0, len(self.ids), BATCH)):
            rows = slice(self.first[a], self.first[min(a + BATCH, len(self.ids))])
            who, asked, own = self.row[rows] - a, self.term[rows], self.weight[rows]
            scores = self._scores(who, asked, own, matrix, column, lists, low, len(self.ids[a:a + BATCH]))
            self._keep(b, a, scores, ids, lambda i, who=who, asked=asked: np.unique(at[np.isin(term, asked[who == i])]))

    @staticmethod
    def _scores(who, term, weight, matrix, column, lists, low, n) -> np.ndarray:
        dense = column[term] >= 0
        wide = np.zeros((n, matrix.shape[1]))
        wide[who[dense], column[term[dense]]] = weight[dense]
        scores = wide @ matrix.T
        who, term, weight = who[~dense], term[~dense], weight[~dense]
        size = lists[2][term]
        src = np.repeat(np.arange(len(term)), size)
        pos = np.arange(len(src)) - np.repeat(np.cumsum(size) - size - low[term], size)
        add = np.bincount(who[src] * matrix.shape[0] + lists[0][pos], weights=weight[src] * lists[1][pos], minlength=scores.size)
        return scores + add.reshape(scores.shape)

    def _keep(self, b: int, a: int, scores: np.ndarray, ids: np.ndarray, sharing) -> None:
        nth, n = self.nth[a:a + BATCH], self.n
        least = np.maximum(nth - 2 * SLACK, SLACK)
        if scores.shape[1] > n + 1:
            least = np.maximum(least, np.partition(scores, scores.shape[1] - n - 1, axis=1)[:, scores.shape[1] - n - 1] - 2 * SLACK)
        who, at = np.divmod(np.flatnonzero(scores > least[:, None]), scores.shape[1])
        few = np.flatnonzero((nth <= SLACK) & (np.bincount(who, minlength=len(scores)) <= n))
        extra = [(np.full(len(x), i), x) for i in few for x in [sharing(i)]]      # those that score 0 are listed too
        if extra:
            other = ~np.isin(who, few)
            who, at = (np.concatenate(x) for x in zip((who[other], at[other]), *extra, strict=True))
        other = ids[at] != self.ids[a + who]
        who, at = who[other], at[other]
        who, key, score = (np.concatenate(x) for x in zip(self.best[b], (who, ids[at], scores[who, at]), strict=True))
        order = np.lexsort((key, -np.round(score, RANK_DIGITS), who))
        who, key, score = who[order], key[order], score[order]
        place = np.arange(len(who)) - np.searchsorted(who, np.arange(len(scores)))[who]
        self.nth[a + who[place == n - 1]] = score[place == n - 1]
        self.best[b] = who[place < n], key[place < n], score[place < n]

    def found(self) -> Iterator[pa.RecordBatch]:
        for b, (who, key, score) in enumerate(self.best):
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[b * BATCH + who]), pa.array(key), pa.array(score)], ["id1", "id2", "score"])


def _search(n: int, n_rows: int, unit: bool):
    """For rows in order of their group, rows asked for before blocks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows, asked = None, [], None
        for row in records(batches):
            if row["grp"] != group:
                if asked is not None:
                    yield from asked.found()
                group, rows, asked = row["grp"], [], None
            if row["side"] == 0:
                rows.append(row)
            elif rows or asked is not None:
                asked = asked or _Asked(rows, n)
                rows = []
                asked.meet(row, n_rows, unit)
        if asked is not None:
            yield from asked.found()
    return run


def top_similar(w: TermBlocks, n: int, queries: DataFrame | None, id_col: str) -> DataFrame:
    """(id1, id2, score, rank) as ``sparse_topn.top_similar`` has it."""
    requests = w.blocks.select("blk", "terms", "held").mapInArrow(releasing(_asked_terms), "blk long, code int, term string, n long")
    total = requests.select("blk", "code", F.sum("n").over(Window.partitionBy("term")).alias("df"))
    dfs = total.groupBy("blk").applyInArrow(_frequencies, "blk long, dfs binary")
    ids = w.blocks.select("blk", "ids").mapInArrow(_row_ids, "blk long, at int, id long")
    if queries is not None:
        ids = ids.join(queries.select(F.col(id_col).cast("long").alias("id")).distinct(), "id", "left_semi")
    wanted = ids.groupBy("blk").agg(F.collect_list("at").alias("asked"))
    kinds = "blk long, ids binary, body binary, terms binary, dfs binary, asked binary, asked_terms binary, n_asked long"
    blocks = cut_lineage(w.blocks.drop("held").join(dfs, "blk").join(wanted, "blk", "left").mapInArrow(
        releasing(_asked_rows(w.n_rows, w.unit)), kinds), "weighted-blocks")
    size = blocks.agg(F.count(F.lit(1)).alias("n"), F.sum("n_asked").alias("asked")).first()
    bq = max(1, -(-(size.asked or 0) // ASKED_POSTINGS))
    bv = max(1, min(size.n, -(-GROUPS // bq)))

    def side(df: DataFrame, which: int, own: int, other: int, cols: list[str]) -> DataFrame:
        place = F.pmod(F.shiftright("blk", 33) + F.col("blk").bitwiseAND((1 << 33) - 1), F.lit(own).cast("long"))
        all_of = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long")))
        qb, vb = ((place, all_of), (all_of, place))[which]
        none: Column = F.lit(None).cast("binary")
        return df.select(F.lit(which).alias("side"), qb.alias("qb"), vb.alias("vb"),
                         *((F.col(c) if c in cols else none).alias(c) for c in ("ids", "body", "terms", "dfs", "asked", "asked_terms")))
    both = side(blocks.where("n_asked > 0"), 0, bq, bv, ["asked", "asked_terms"]).unionByName(
        side(blocks, 1, bv, bq, ["ids", "body", "terms", "dfs"]))
    dealt = both.withColumn("grp", (F.col("qb") * F.lit(bv) + F.col("vb")).cast("int")).drop("qb", "vb")
    found = (dealt.repartitionById(bq * bv, "grp").sortWithinPartitions("grp", "side")
             .mapInArrow(releasing(_search(n, w.n_rows, w.unit)), "id1 long, id2 long, score double"))
    by = Window.partitionBy("id1").orderBy(F.round("score", RANK_DIGITS).desc(), F.col("id2"))
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n)
