"""Exact top-k inner-product search with block-at-a-time pruning.

Vectors are kept in *document-range blocks*: runs of consecutive ids. Each block holds, for every
term (dimension), its largest and smallest weight, and a forward index (the rows themselves). For
a query, the sum over terms of query weight times the block's maximum (minimum for a negative
weight) bounds every score in the block. A query visits blocks by falling bound and stops when
the next bound is below its kth score; a bound equal to it is still visited, for ties.

The query set is met with all rows in blocks: a query batch (bounded rows) meets a shard (a
bounded number of blocks). Batches and shards are dealt into the groups of a grid whose size doesn't grow
with the rows. The task of a pair of groups keeps its batches packed and reads its shards one by one; the kth
scores found so far close blocks of the shards that follow. At most k rows per query leave a task; a window
merges the groups of shards. Nothing is broadcast, and batches are not copied for every shard.

Defined results: vectors that are null, empty or hold a null or non-finite component, and rows
with a null id, take no part. Shorter vectors count as padded with zeros. Rows that repeat a
query's id are the query's own and are no candidates for it; of several queries with one id the one
with the smallest vector asks; other repeated rows are candidates like any. Ties go to the smaller id. Fewer than k candidates: all of them. Extra columns are
ignored. Integer sums beyond 64 bits saturate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.llm.blocks import pack, records, unpack
from reviewlake.session import cut_lineage

BLOCK_ROWS = 256
SHARD_ROWS = 16 * BLOCK_ROWS
BATCH_ROWS = 1024
#: Pairs of groups that the work is dealt into when memory asks for no more.
GRID = 48
#: Batches of queries, and packed bytes of them, that a task holds.
HELD_BATCHES, HELD_BYTES = 128, 32 << 20
#: Partitions that shards and batches are packed in; beyond them a partition packs more than one, 16 at least.
RANGES, RANGE_RECORDS = 256, 16
_EXACT_FLOAT, _EXACT = 1 << 24, 1 << 53


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int = 64) -> DataFrame:
    """(id, v): floor(scale * x) of each component as a double; rows that take no part are left out."""
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
            .where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)
            .select("id", F.transform("v", lambda x: F.floor(x * F.lit(float(scale)))).alias("v")))


def _matrices(rows: int):
    """Pack consecutive rows into one record per at most ``rows`` rows: (n, dim, ids and numbers)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []

        def record() -> pa.RecordBatch:
            dim = max(map(len, vectors))
            m = np.zeros((len(ids), dim), dtype=np.int64)
            for i, v in enumerate(vectors):
                m[i, :len(v)] = v
            value = [pack(np.asarray(ids, dtype=np.int64), m.reshape(-1))]
            return pa.RecordBatch.from_arrays([pa.array([len(ids)], pa.int32()), pa.array([dim], pa.int32()),
                                               pa.array(value, pa.binary())], ["n", "dim", "rows"])

        for batch in batches:
            column = batch.column(1)
            flat = column.flatten().to_numpy(zero_copy_only=False)
            offsets = np.append(0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False)))
            for i, key in enumerate(batch.column(0).to_pylist()):
                ids.append(key)
                vectors.append(flat[offsets[i]:offsets[i + 1]])
                if len(ids) == rows:
                    yield record()
                    ids, vectors = [], []
        if ids:
            yield record()
    return run


def _padded(m: np.ndarray, dim: int) -> np.ndarray:
    return np.pad(m, ((0, 0), (0, dim - m.shape[1])))


def _kind(a: np.ndarray, b: np.ndarray) -> type:
    """In which numbers a @ b.T is exact: floats, doubles or else Python's integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return np.float32 if most < _EXACT_FLOAT else np.float64 if most < _EXACT else object


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of numbers of ``_kind``; Python's integers end as 64 bits."""
    found = a @ b.T
    return np.clip(found, -(1 << 63), (1 << 63) - 1).astype(np.int64) if found.dtype == object else found


def _merged(parts: list[tuple], n: int, k: int) -> tuple[tuple, np.ndarray]:
    """The k best of each of ``n`` queries, (query position, id, score) arrays in order, and the kth scores."""
    who, key, score = (np.concatenate(x) for x in zip(*parts, strict=True))
    by = np.lexsort((key, -score, who))
    who, key, score = who[by], key[by], score[by]
    place = np.arange(len(who)) - np.searchsorted(who, np.arange(n))[who]
    full = place == k - 1
    kth = np.full(n, -np.inf)
    kth[who[full]] = score[full]
    return tuple(x[place < k] for x in (who, key, score)), kth


def search(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int, block_rows: int,
           best: tuple | None = None) -> tuple:
    """Top k of the rows of a shard (ids ascending) and of ``best``, what shards before it gave, for each query:
    (query position, id, score) arrays."""
    kind = _kind(q, m)
    q, m = q.astype(kind), m.astype(kind)
    starts = np.arange(0, len(ids), block_rows)
    largest, smallest = np.maximum.reduceat(m, starts), np.minimum.reduceat(m, starts)
    bounds = np.clip(_products(np.maximum(q, 0), largest).astype(np.float64)
                     + _products(np.minimum(q, 0), smallest).astype(np.float64), -2.0**63, 2.0**63)
    best, kth = _merged([best or (np.zeros(0, dtype=np.int64),) * 3], len(q), k)
    order = np.argsort(-bounds, axis=1, kind="stable") if np.isneginf(kth).any() else np.broadcast_to(
        np.argsort(-bounds.max(axis=0, initial=-np.inf), kind="stable"), bounds.shape)   # with kth scores, blocks close in any order
    new, n_new = [], 0
    for rank in range(len(starts)):
        block = order[:, rank]
        open_ = np.flatnonzero(bounds[np.arange(len(q)), block] >= kth)
        for b in np.unique(block[open_]):
            own = open_[block[open_] == b]
            rows = slice(starts[b], starts[b] + block_rows)
            score = _products(q if len(own) == len(q) else q[own], m[rows])
            at, col = np.divmod(np.flatnonzero(score >= kth[own][:, None].astype(score.dtype if kind is not object else np.float64)),
                                score.shape[1])
            other = ids[rows][col] != query_ids[own][at]
            at, col = at[other], col[other]
            new.append((own[at], ids[rows][col], score[at, col].astype(np.int64)))
            n_new += len(at)
        if n_new > len(q):
            best, kth = _merged([best, *new], len(q), k)
            new, n_new = [], 0
    return _merged([best, *new], len(q), k)[0]


def _score(k: int, block_rows: int):
    """For rows in order of their group, batches of queries before shards: the k best of each query in its group."""
    def best_of(held: list[list]) -> Iterator[pa.RecordBatch]:
        for dim, packed, best in held:
            if best is not None:
                who, key, score = best
                yield pa.RecordBatch.from_arrays([pa.array(unpack(packed)[0][who]), pa.array(key), pa.array(score)],
                                                 ["query_id", "id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for row in records(batches):
            if row["grp"] != group:
                yield from best_of(held)
                group, held = row["grp"], []
            if row["side"] == 0:
                held.append([row["dim"], row["rows"], None])
                continue
            ids, flat = unpack(row["rows"])
            shard = flat.reshape(-1, row["dim"])
            for batch in held:
                qid, q = unpack(batch[1])
                dim = max(batch[0], row["dim"])
                batch[2] = search(qid, _padded(q.reshape(-1, batch[0]), dim), ids, _padded(shard, dim), k, block_rows, batch[2])
        yield from best_of(held)
    return run


def _records(rows: DataFrame, most: int, name: str) -> DataFrame:
    """(part, at, dim, rows): rows packed, with the partition of each record and its place there."""
    packed = rows.mapInArrow(_matrices(most), "n int, dim int, rows binary")
    return cut_lineage(packed.select(F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
                                     .alias("at"), "dim", "rows"), name)


def _ranges(n_records: int) -> int:
    return max(1, min(n_records, max(RANGES, -(-n_records // RANGE_RECORDS))))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 20, block_rows: int = BLOCK_ROWS,
          shard_rows: int = SHARD_ROWS, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """(query_id, rank, id, score) for (id, v) whole-number vectors and queries of distinct rows."""
    table = cut_lineage(vectors, "vectors")
    n_shards = max(1, -(-table.count() // shard_rows))
    shards = _records(table.repartitionByRange(_ranges(n_shards), "id").sortWithinPartitions("id"), shard_rows, "shards")
    queries = cut_lineage(queries.groupBy("id").agg(F.min("v").alias("v")), "queries")
    asked = _records(queries.coalesce(_ranges(n_shards // 8)), batch_rows, "query-batches")
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("rows")).alias("bytes")).first()
    groups = max(1, -(-size.n // HELD_BATCHES), -(-(size.bytes or 0) // HELD_BYTES))
    shard_groups = min(n_shards, -(-GRID // groups))

    def side(df: DataFrame, which: int, own: int, other: int) -> DataFrame:
        place = F.pmod(F.col("part") + F.col("at"), F.lit(own))
        all_of = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(other - 1).cast("long")))
        qb, vb = ((place, all_of), (all_of, place))[which]
        return df.select(F.lit(which).alias("side"), qb.alias("qb"), vb.alias("vb"), "dim", "rows")
    both = side(asked, 0, groups, shard_groups).unionByName(side(shards, 1, shard_groups, groups))
    dealt = both.withColumn("grp", (F.col("qb") * F.lit(shard_groups) + F.col("vb")).cast("int")).drop("qb", "vb")
    found = (dealt.repartitionById(groups * shard_groups, "grp").sortWithinPartitions("grp", "side")
             .mapInArrow(_score(k, block_rows), "query_id long, id long, score long"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("id"))
    return (found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
