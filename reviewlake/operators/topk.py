"""Top-n and exact nearest-neighbour search.

Exact k-NN is computed block against block: distinct vectors and distinct queries are hashed into the blocks of a grid.
For every pair of blocks one task holds the block of queries, with their k best so far, and the block of vectors
passes by in chunks. A single-precision matrix product and its error bound pass over most pairs; the others are
scored in double precision. A final window keeps the k best per query.

* A task holds one block of queries and one of vectors, whatever the data size.
* The grid has a fixed number of blocks as long as a block of queries fits the memory of a task, so what is shuffled
  grows with the rows: vectors GRID_QUERIES times at most, queries GRID / GRID_QUERIES times.
* A small query batch (the common case: a few products against the catalogue) is a single query
  block, so vectors are read once and only the query rows are replicated.
* Rows with equal vectors cost one search, and ties between them no more than k rows.
* Self-search of n distinct vectors compares n^2 pairs by definition; it is offered because the reference computes it.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions import vectors as vx
from reviewlake.operators.joins import broadcast_if_small
from reviewlake.session import cut_lineage, ship_package

RANK_DIGITS = 9          # scores are compared after rounding, so engines agree on ties
DEFAULT_BLOCK_ROWS = 2048


def top_n(df: DataFrame, score: str, n: int = 10, id_col: str = "id", ascending: bool = False) -> DataFrame:
    """Top n rows by score (id breaks ties) -> TakeOrderedAndProject."""
    s = F.round(F.col(score), RANK_DIGITS)
    return df.orderBy(s.asc() if ascending else s.desc(), F.col(id_col).asc()).limit(n)


def build_vector_table(df: DataFrame, id_col: str = "id", vec_col: str = "vec") -> DataFrame:
    """Id-keyed unit vectors (the id travels with the vector; never a position)."""
    return df.select(id_col, vx.unit(vec_col).alias(vec_col))


def row_topk(key: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row, the k smallest finite ``key`` values, ties broken by column index (vectorised).

    Columns must be in ascending id order so that the column index is the id tie-break.
    Returns (row index, column index) pairs, ordered by row then rank.
    """
    kk = min(k, key.shape[1])
    if kk == 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    kth = np.partition(key, kk - 1, axis=1)[:, kk - 1]
    r, c = np.nonzero((key <= kth[:, None]) & np.isfinite(key))
    order = np.lexsort((c, key[r, c], r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    keep = rank < kk
    return r[keep], c[keep]


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared Euclidean distances of all rows of ``a`` to all rows of ``b``."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T), 0.0)


#: Rows of a tile of queries, and of the vectors it meets at a time.
TILE_ROWS, CHUNK_ROWS = 2048, 4096
#: Pairs scored exactly at a time, and the room that a filter leaves for rounded scores.
EXACT_PAIRS, ROUND_SLACK = 1 << 15, 1e-9


def _pair_scores(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Scores of row i of ``a`` with row i of ``b``. A pair's score depends on its own two rows only, so it is the same
    however rows are dealt into blocks."""
    if metric == "l2":
        return ((a - b) ** 2).sum(axis=1)
    s = (a * b).sum(axis=1)
    if metric == "cosine":
        with np.errstate(divide="ignore", invalid="ignore"):
            s = s / (np.sqrt((a * a).sum(axis=1)) * np.sqrt((b * b).sum(axis=1)))
    return s


def _filter_side(m: np.ndarray, metric: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The rows as the filter multiplies them, and their squared lengths."""
    square = (m * m).sum(axis=1)
    if metric == "cosine":
        m = m / np.sqrt(np.where(square > 0, square, 1.0))[:, None]
        square = np.minimum(square, 1.0)
    return m.astype(dtype), square


class _Tile:
    """The k best so far of a few queries, as sorted runs (query, key, id)."""

    def __init__(self, rows: np.ndarray, k: int, metric: str):
        self.rows, self.k, self.metric, self.pending = rows, k, metric, []
        self.best = [np.empty(0, dtype=t) for t in (np.int32, np.float64, np.int64, np.float64, np.int64)]
        self.worst = np.full(len(rows), np.inf)                      # key of each query's k-th best
        self.sides: dict = {}

    def add_chunk(self, vm: np.ndarray, ids: np.ndarray, pos: np.ndarray, sides: dict) -> None:
        """Meets the rows ``vm``, whose numbers among all are ``pos``."""
        large = max(np.abs(vm).max(initial=0.0), np.abs(self.rows).max(initial=0.0)) > 1e15
        dtype = np.float64 if large else np.float32
        if dtype not in sides:
            sides[dtype] = _filter_side(vm, self.metric, dtype)
        if dtype not in self.sides:
            self.sides[dtype] = _filter_side(self.rows, self.metric, dtype)
        (q, qq), (v, vv) = self.sides[dtype], sides[dtype]
        near = q @ v.T
        room = (self.rows.shape[1] + 10) * 2 * np.finfo(dtype).eps * (np.sqrt(qq.max(initial=0.0) * vv.max(initial=0.0)) + 1e-30)
        if self.metric == "l2":                  # |q - v|^2 <= d, as q.v - |v|^2 / 2 >= (|q|^2 - d) / 2
            near -= (vv / 2).astype(dtype)[None, :]
            room += 4 * np.finfo(dtype).eps * (vv.max(initial=0.0) + qq.max(initial=0.0))
            low = (qq - self.worst) / 2
        else:
            low = -self.worst
        low = low - room - ROUND_SLACK
        if not np.isfinite(self.worst).all() and len(ids) > self.k:
            low = np.maximum(low, -np.partition(-near, self.k - 1, axis=1)[:, self.k - 1] - 2 * (room + ROUND_SLACK))
        r, c = np.nonzero(near >= np.nextafter(low.astype(dtype), dtype(-np.inf))[:, None])
        for at in range(0, len(r), EXACT_PAIRS):
            rr, cc = r[at:at + EXACT_PAIRS], c[at:at + EXACT_PAIRS]
            with np.errstate(over="ignore", invalid="ignore"):
                score = _pair_scores(self.rows[rr], vm[cc], self.metric)
                key = np.round(score if self.metric == "l2" else -score, RANK_DIGITS)
            keep = np.isfinite(key) & (key <= self.worst[rr])
            rr, cc = rr[keep], cc[keep]
            self.pending.append([rr.astype(np.int32), key[keep], ids[cc], score[keep], pos[cc]])
            if sum(len(x[0]) for x in self.pending) > max(len(self.best[0]), 1 << 17):
                self.merge()
        if not np.isfinite(self.worst).all():
            self.merge()

    def merge(self) -> None:
        if not self.pending:
            return
        r, key, ids, score, pos = (np.concatenate(x) for x in zip(self.best, *self.pending, strict=True))
        self.pending = []
        order = np.lexsort((pos, ids, key, r))
        r = r[order]
        rank = np.arange(len(r)) - np.searchsorted(r, r)
        order, r, rank = order[rank < self.k], r[rank < self.k], rank[rank < self.k]
        self.best = [r, key[order], ids[order], score[order], pos[order]]
        last = rank == self.k - 1
        self.worst[r[last]] = self.best[1][last]


class _Nearest:
    """The k best of a block of queries over vectors that pass by in chunks.

    A product of single-precision matrices only passes over pairs that its error bound excludes; all others get their score
    from the two vectors themselves. Vectors that aren't finite (and, by cosine, those of length 0) are met by none."""

    def __init__(self, asked: np.ndarray, qm: np.ndarray, k: int, metric: str):
        if metric not in ("l2", "cosine", "dot"):
            raise ValueError(metric)
        self.metric, self.k, self.n = metric, k, 0
        ok = self._usable(qm)
        self.asked, qm = asked[ok], qm[ok]
        self.tiles = [_Tile(qm[low:low + TILE_ROWS], k, metric) for low in range(0, len(qm), TILE_ROWS)]
        self.members: list[tuple[np.ndarray, np.ndarray]] = []         # ids of equal vectors, and how many each vector has

    def _usable(self, m: np.ndarray) -> np.ndarray:
        ok = np.isfinite(m).all(axis=1)
        return ok & (m != 0).any(axis=1) if self.metric == "cosine" else ok

    def add(self, vm: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Rows of vectors; ``ids`` holds ``counts[i]`` ascending ids for row i."""
        self.members.append((ids, counts))
        lowest = ids[np.cumsum(counts) - counts]
        ok = np.flatnonzero(self._usable(vm))
        for low in range(0, len(ok), CHUNK_ROWS):
            chunk, sides = ok[low:low + CHUNK_ROWS], {}
            rows = vm[chunk]
            for tile in self.tiles:
                tile.add_chunk(rows, lowest[chunk], self.n + chunk, sides)
        self.n += len(vm)

    def result(self):
        """Batches (qid, id, score): of each query the k best ids."""
        if not self.members:
            return
        ids, counts = (np.concatenate(x) for x in zip(*self.members, strict=True))
        start = np.cumsum(counts) - counts
        for i, tile in enumerate(self.tiles):
            tile.merge()
            r, key, _lowest, score, pos = tile.best
            n = counts[pos]
            at = np.repeat(np.arange(len(r)), n)
            own = ids[start[pos][at] + np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)]
            order = np.lexsort((own, key[at], r[at]))
            at, own = at[order], own[order]
            keep = np.arange(len(at)) - np.searchsorted(r[at], r[at]) < self.k
            at, own = at[keep], own[keep]
            yield pa.RecordBatch.from_arrays([pa.array(self.asked[i * TILE_ROWS + r[at]]), pa.array(own), pa.array(score[at])],
                                             ["qid", "id", "score"])


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column as a matrix; a null component becomes NaN."""
    sizes = np.diff(column.offsets.to_numpy())
    if len(sizes) and (sizes != sizes[0]).any():
        raise ValueError("vectors of different lengths")
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(sizes), int(sizes[0]) if len(sizes) else 0)


def _group_topk(k: int, metric: str):
    """The k best of a block of queries (side 0) among a block of vectors (side 1)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        q, v = pdf[pdf["side"] == 0], pdf[pdf["side"] == 1]
        if q.empty or v.empty:
            return pd.DataFrame({"qid": np.empty(0, np.int64), "id": np.empty(0, np.int64), "score": np.empty(0)})
        best = _Nearest(q["rid"].to_numpy(dtype=np.int64), np.stack(q["vec"].to_numpy()).astype(np.float64), k, metric)
        for low in range(0, len(v), CHUNK_ROWS):
            part = v.iloc[low:low + CHUNK_ROWS]
            ids = part["ids"].to_list()
            best.add(np.stack(part["vec"].to_numpy()).astype(np.float64), np.concatenate(ids).astype(np.int64), np.array([len(i) for i in ids]))
        return pa.Table.from_batches(best.result(), pa.schema([("qid", pa.int64()), ("id", pa.int64()), ("score", pa.float64())])).to_pandas()
    return run


#: Blocks of queries, and all pairs of blocks, that a search is dealt into as long as a block of queries has at most
#: ``BLOCK_VALUES`` components, or results. Blocks of vectors have the same bound.
GRID_QUERIES, GRID, BLOCK_VALUES = 16, 32, 1 << 23
#: Partitions of a search with more groups than that hold several.
MAX_PARTS = 4096
#: Stands for a null id, which sorts first.
NO_ID = -(1 << 63)


def knn(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "l2", id_col: str = "id",
        qid_col: str = "qid", vec_col: str = "vec", block_rows: int = DEFAULT_BLOCK_ROWS,
        materialize: bool = True, partition_col: str | None = None) -> DataFrame:
    """The k best vectors per query -> (qid, id, score, rank).

    ``l2``: squared Euclidean distance, ascending. ``cosine`` / ``dot``: similarity, descending.
    Ties are broken by id. Rows without a vector take no part. Row counts (cheap actions) size the blocks. With ``materialize``
    the inputs are written once to the shared folder, so counting and block replication do not
    recompute their upstream plans. With ``partition_col`` a query only meets vectors of the same
    partition value (e.g. its probed clusters), blocked per partition value.
    """
    pc = [partition_col] if partition_col else []
    ship_package(vectors.sparkSession)

    def side(df: DataFrame, key: str, name: str) -> DataFrame:
        rows = df.select(*pc, F.coalesce(F.col(key).cast("long"), F.lit(NO_ID)).alias(name), vx.as_double(vec_col).alias("vec")).where("vec IS NOT NULL")
        return cut_lineage(rows, f"knn-{name}s") if materialize else rows
    own = side(vectors, id_col, "id")
    asked = own.withColumnRenamed("id", "qid") if vectors is queries else side(queries, qid_col, "qid")

    # Equal vectors are searched, and searched for, once: only the k smallest of their ids can be among k best.
    equal = Window.partitionBy(*pc, "vec").orderBy("id")
    v = own.withColumn("_place", F.row_number().over(equal)).where(F.col("_place") <= k)
    v = cut_lineage(v.groupBy(*pc, "vec").agg(F.array_sort(F.collect_list("id")).alias("ids")), "knn-distinct")
    q = cut_lineage(asked.select(*pc, "vec").distinct().withColumn("rid", F.monotonically_increasing_id()), "knn-asked")
    size = F.max(F.size("vec")).alias("_dim")
    n = F.count(F.lit(1))
    counts = (v.groupBy(*pc).agg(n.alias("_nv")).join(q.groupBy(*pc).agg(n.alias("_nq"), size), pc, "inner") if pc else
              v.agg(n.alias("_nv")).join(q.agg(n.alias("_nq"), size)))
    full = F.ceil(F.col("_nq") * F.greatest(F.col("_dim"), F.lit(k)) / BLOCK_VALUES)
    counts = counts.withColumn("_bq", F.greatest(F.lit(1), F.least(F.ceil(F.col("_nq") / block_rows), F.lit(GRID_QUERIES)), full).cast("long"))
    counts = counts.withColumn("_bv", F.greatest(F.lit(1), F.least(F.ceil(F.col("_nv") / block_rows), F.ceil(F.lit(GRID) / F.col("_bq"))),
        F.ceil(F.col("_nv") * F.col("_dim") / BLOCK_VALUES)).cast("long"))
    groups = F.sum(F.col("_bq") * F.col("_bv"))
    before = Window.orderBy(*pc).rowsBetween(Window.unboundedPreceding, -1) if pc else None          # one row per partition value
    grid = cut_lineage(counts.withColumn("_from", F.coalesce(groups.over(before), F.lit(0)) if pc else F.lit(0)).select(
        *pc, "_bq", "_bv", F.col("_from").cast("long")), "knn-grid")
    total = grid.agg(groups.alias("n")).first()["n"] or 1
    parts = min(int(total), MAX_PARTS)

    def block(key: str, blocks: str):
        return F.pmod(F.xxhash64(key), F.col(blocks))
    if pc:
        grid = broadcast_if_small(grid)
        v, q_rows = v.join(grid, pc), q.join(grid, pc)
    else:
        row = {name: F.lit(value) for name, value in grid.first().asDict().items()}
        v, q_rows = v.withColumns(row), q.withColumns(row)
    v = v.withColumns({"vb": block("vec", "_bv"), "qb": F.explode(F.expr("sequence(0L, _bq - 1)"))})
    q_rows = q_rows.withColumns({"qb": block("rid", "_bq"), "vb": F.explode(F.expr("sequence(0L, _bv - 1)"))})
    grp = (F.col("_from") + F.col("qb") * F.col("_bv") + F.col("vb")).alias("grp")
    both = q_rows.select(grp, F.lit(0).alias("side"), "rid", F.lit(None).cast("array<long>").alias("ids"), "vec").unionByName(
        v.select(grp, F.lit(1).alias("side"), F.lit(None).cast("long").alias("rid"), "ids", "vec"))
    partial = both.repartition(parts, "grp").groupBy("grp").applyInPandas(_group_topk(k, metric), "qid long, id long, score double")

    rk = F.round("score", RANK_DIGITS)

    def best(of: str) -> Window:
        return Window.partitionBy(of).orderBy(rk.asc() if metric == "l2" else rk.desc(), F.col("id").asc())
    found = partial.withColumnRenamed("qid", "rid").withColumn("rank", F.row_number().over(best("rid"))).where(F.col("rank") <= k)
    out = asked.join(q, [*pc, "vec"]).select("qid", "rid").join(found, "rid").select("qid", "id", "score", "rank")
    if not asked.groupBy("qid").agg(n.alias("n")).where("n > 1").isEmpty():                 # rows of one qid are one query
        out = out.withColumn("rank", F.row_number().over(best("qid"))).where(F.col("rank") <= k)
    null = F.lit(NO_ID)
    return out.select(F.nullif("qid", null).alias(qid_col), F.nullif("id", null).alias(id_col), "score", "rank")


#: A query matrix of at most this size is sent to every task; more queries are searched in several batches.
BATCH_MAX_BYTES = 32 << 20


def _batch_topk(shared, k: int, metric: str):
    """Running top k of every query over the vectors of one task."""
    def run(batches):
        best = _Nearest(*shared.value, k, metric)
        for batch in batches:
            if batch.num_rows:
                best.add(_matrix(batch.column("vec")), batch.column("id").to_numpy(zero_copy_only=False), np.ones(batch.num_rows, dtype=np.int64))
        yield from best.result()
    return run


def knn_batch(vectors: DataFrame, queries: DataFrame, k: int, metric: str = "l2", id_col: str = "id",
              qid_col: str = "qid", vec_col: str = "vec", max_bytes: int = BATCH_MAX_BYTES) -> DataFrame:
    """T2 / T3 for a table of queries: the vector table is read where it lies and each task keeps its own k
    best; only these are shuffled. A batch of queries of at most ``max_bytes`` is sent to the tasks at a time; more queries
    take several passes of the same kernel, so results don't depend on the number of queries."""
    spark = vectors.sparkSession
    ship_package(spark)
    null = F.lit(NO_ID)
    own = queries.select(F.coalesce(F.col(qid_col).cast("long"), null).alias("qid"), vx.as_double(vec_col).alias("vec")).where("vec IS NOT NULL")
    vectors = vectors.select(F.coalesce(F.col(id_col).cast("long"), null).alias("id"), vx.as_double(vec_col).alias("vec")).where("vec IS NOT NULL")
    size = own.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vec")).alias("dim")).first()
    batches = max(1, math.ceil(size.n * (size.dim or 0) * 8 / max_bytes))
    if batches > 1:
        own, vectors = cut_lineage(own, "knn-queries"), cut_lineage(vectors, "knn-vectors")
    parts = []
    for b in range(batches):
        rows = (own.where(F.pmod(F.xxhash64("qid"), F.lit(batches)) == b) if batches > 1 else own).collect()
        matrix = np.array([r["vec"] for r in rows], dtype=np.float64).reshape(len(rows), size.dim or 0)
        shared = spark.sparkContext.broadcast((np.array([r["qid"] for r in rows], dtype=np.int64), matrix))
        parts.append(vectors.mapInArrow(_batch_topk(shared, k, metric), "qid long, id long, score double"))
    found = reduce(DataFrame.unionByName, parts)
    rk = F.round("score", RANK_DIGITS)
    w = Window.partitionBy("qid").orderBy(rk.asc() if metric == "l2" else rk.desc(), F.col("id").asc())
    out = found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return out.select(F.nullif("qid", null).alias(qid_col), F.nullif("id", null).alias(id_col), "score", "rank")
