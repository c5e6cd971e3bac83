"""Exact nearest-neighbour search through clusters.

The index keeps, beside every vector, its cluster and its distance to the cluster's centre, sorted by
both. By the triangle inequality a vector x of cluster c is no nearer to a query q than
``|d(q, c) - d(x, c)|``, so a run of rows of one cluster whose distances lie in [low, high] can be
passed over when ``max(d(q, c) - high, low - d(q, c))`` exceeds the distance of the k-th best vector
known. The search has two steps, both over the index where it lies:

1. every query meets the clusters nearest to it; its k-th distance there is an upper bound;
2. every query meets all other clusters whose radius the bound doesn't rule out, run by run.

No vector that could be among the k best is left out, whatever the data; clusters only save work. Each
answer says how many vectors were compared (``scanned``). A hot cluster is many runs in many tasks.

Only bounded things pass through the driver: centres (at most ``MAX_CLUSTERS``), their radii and one
batch of queries at a time. The centres are fitted on at most ``FIT_ROWS`` vectors, chosen by hash; every
vector is indexed. Vectors that are null or hold null or non-finite numbers take no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlake.functions import vectors as vx
from reviewlake.operators.topk import RANK_DIGITS, row_topk, squared_distances
from reviewlake.session import cut_lineage, ship_package

MAX_CLUSTERS = 1024
FIT_ROWS = 100_000
#: Rows of one cluster that share a bound; rows are read in order of their distance to the centre.
RUN_ROWS = 256
#: Bytes of a batch's query vectors and of their distances to all centres.
BATCH_BYTES = 32 << 20
#: Clusters that a query meets in the first step.
FIRST_CLUSTERS = 2
#: Distances are compared with this much to spare, far above rounding errors of unit vectors.
SLACK = 1e-6


@dataclass
class TwoLevelIndex:
    """Rows (cluster, dist, id, vec) sorted by cluster and distance; centres with their radii."""

    rows: DataFrame
    centres: np.ndarray
    radius: np.ndarray


def _finite(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    v = vx.as_double(vec_col)
    good = F.forall(v, lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    return df.where(F.col(vec_col).isNotNull() & good).select(F.col(id_col).cast("long").alias("id"), v.alias("vec"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _assign_task(centres):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = centres.value
        for batch in batches:
            vm = _matrix(batch.column("vec"))
            near = np.empty(len(vm), dtype=np.int32)
            for low in range(0, len(vm), 1024):
                near[low:low + 1024] = squared_distances(vm[low:low + 1024], c).argmin(axis=1)
            dist = np.sqrt(((vm - c[near]) ** 2).sum(axis=1)) if len(vm) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(dist), *batch.columns], ["cluster", "dist", "id", "vec"])
    return run


def build(vectors: DataFrame, n_clusters: int | None = None, fit_rows: int = FIT_ROWS, seed: int = 42,
          id_col: str = "id", vec_col: str = "vec") -> TwoLevelIndex:
    """The index of all vectors: about the square root of their number of clusters, ``MAX_CLUSTERS`` at most."""
    from pyspark.ml.functions import array_to_vector

    spark = vectors.sparkSession
    ship_package(spark)
    rows = cut_lineage(_finite(vectors, id_col, vec_col), "two-level-vectors")
    n = rows.count()
    k = min(n, n_clusters or max(2, min(MAX_CLUSTERS, math.isqrt(n))))
    schema = "cluster int, dist double, id long, vec array<double>"
    if not n:
        return TwoLevelIndex(spark.createDataFrame([], schema), np.zeros((0, 0)), np.zeros(0))
    sample = rows if n <= fit_rows else rows.orderBy(F.xxhash64("id")).limit(fit_rows)
    fitted = KMeans(k=k, seed=seed).fit(sample.select(array_to_vector("vec").alias("features")))
    centres = np.asarray(fitted.clusterCenters(), dtype=np.float64)
    assigned = cut_lineage(rows.mapInArrow(_assign_task(spark.sparkContext.broadcast(centres)), schema), "two-level-assigned")
    ordered = cut_lineage(assigned.repartitionByRange("cluster", "dist", "id").sortWithinPartitions("cluster", "dist", "id"), "two-level")
    radius = np.zeros(len(centres))
    for r in assigned.groupBy("cluster").agg(F.max("dist").alias("radius")).collect():      # at most one row per centre
        radius[r.cluster] = r.radius
    return TwoLevelIndex(ordered, centres, radius)


class _Best:
    """The k nearest vectors known of every query, as rows of arrays: ranked distance, id, distance."""

    def __init__(self, n: int, k: int):
        self.key = np.full((n, k), np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.scanned = np.zeros(n, dtype=np.int64)
        self.k = k

    def add(self, which: np.ndarray, ids: np.ndarray, distance: np.ndarray) -> None:
        """Distances of the queries ``which`` to the vectors ``ids`` (ascending)."""
        rounded = np.round(distance, RANK_DIGITS)
        r, c = row_topk(np.where(rounded <= self.key[which, -1:], rounded, np.inf), self.k)
        self.scanned[which] += len(ids)
        if not len(r):
            return
        some, first = np.unique(r, return_index=True)
        place = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
        slot = np.searchsorted(some, r)
        key, own = np.full((len(some), self.k), np.inf), np.full((len(some), self.k), np.iinfo(np.int64).max)
        key[slot, place], own[slot, place] = rounded[r, c], ids[c]
        at = which[some]
        key, own = np.concatenate([self.key[at], key], axis=1), np.concatenate([self.id[at], own], axis=1)
        order = np.lexsort((own, key), axis=1)[:, :self.k]
        self.key[at], self.id[at] = np.take_along_axis(key, order, 1), np.take_along_axis(own, order, 1)


def _search_task(shared, k: int):
    """Best k of every query among the rows of one task; rows with a null id say how many were compared."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        qids, qm, to_centre, meets, bound = shared.value
        best = _Best(len(qids), k)
        for batch in batches:
            cluster = batch.column("cluster").to_numpy(zero_copy_only=False)
            dist = batch.column("dist").to_numpy(zero_copy_only=False)
            ids = batch.column("id").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero(np.diff(cluster)) + 1
            for start, stop in zip([0, *edges], [*edges, len(cluster)], strict=True):
                for low in range(start, stop, RUN_ROWS):
                    high = min(stop, low + RUN_ROWS)
                    c = cluster[low]
                    gap = np.maximum(to_centre[:, c] - dist[low:high].max(), dist[low:high].min() - to_centre[:, c])
                    known = np.minimum(bound, np.sqrt(best.key[:, -1]))
                    which = np.flatnonzero(meets[:, c] & (gap <= known + SLACK))
                    if len(which):
                        order = low + np.argsort(ids[low:high], kind="stable")
                        vm = _matrix(batch.column("vec").slice(low, high - low))[order - low]
                        best.add(which, ids[order], squared_distances(qm[which], vm))
        r, c = np.nonzero(np.isfinite(best.key))
        met = np.flatnonzero(best.scanned)
        yield pa.RecordBatch.from_arrays([
            pa.array(np.concatenate([qids[r], qids[met]])),
            pa.array(np.concatenate([best.id[r, c], met]), mask=np.concatenate([np.zeros(len(r), bool), np.ones(len(met), bool)])),
            pa.array(np.concatenate([best.key[r, c], best.scanned[met]]).astype(np.float64))], ["qid", "id", "score"])
    return run


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("qid").orderBy(F.round("score", RANK_DIGITS), "id")
    return found.where("id IS NOT NULL").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _search_batch(index: TwoLevelIndex, rows: list, k: int, first: int) -> DataFrame:
    spark = index.rows.sparkSession
    schema = "qid long, id long, score double"
    qids = np.array([r.qid for r in rows], dtype=np.int64)
    qm = np.array([r.vec for r in rows], dtype=np.float64)
    to_centre = np.sqrt(squared_distances(qm, index.centres))
    nearest = np.zeros(to_centre.shape, dtype=bool)
    np.put_along_axis(nearest, np.argsort(to_centre, axis=1)[:, :first], True, axis=1)

    def step(meets: np.ndarray, bound: np.ndarray) -> DataFrame:
        wanted = [int(c) for c in np.flatnonzero(meets.any(axis=0))]
        shared = spark.sparkContext.broadcast((qids, qm, to_centre, meets, bound))
        return index.rows.where(F.col("cluster").isin(wanted)).mapInArrow(_search_task(shared, k), schema)

    begun = cut_lineage(step(nearest, np.full(len(qids), np.inf)), "two-level-first")
    kth = {r.qid: r.score for r in _ranked(begun, k).where(F.col("rank") == k).select("qid", "score").collect()}   # a batch's queries
    bound = np.array([math.sqrt(kth[q]) if q in kth else np.inf for q in qids.tolist()])
    # Nothing in a cluster is nearer than the distance to its centre less its radius.
    left = ~nearest & (to_centre - index.radius[None, :] <= bound[:, None] + SLACK)
    return begun.unionByName(step(left, bound)) if left.any() else begun


def search(index: TwoLevelIndex, queries: DataFrame, k: int, id_col: str = "qid", vec_col: str = "vec",
           first_clusters: int = FIRST_CLUSTERS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """(qid, id, score, rank, scanned): the k nearest vectors of every query by squared distance, exactly.

    Ties go to the smaller id. ``scanned``: vectors whose distance to the query was worked out. Queries
    with one id and several vectors are not told apart. Batches of bounded size are searched in turn.
    """
    spark = index.rows.sparkSession
    ship_package(spark)
    own = cut_lineage(_finite(queries, id_col, vec_col).withColumnRenamed("id", "qid"), "two-level-queries")
    n = own.count()
    if not n or not len(index.centres):
        return spark.createDataFrame([], "qid long, id long, score double, rank int, scanned long")
    rows_of_batch = max(1, batch_bytes // (8 * sum(index.centres.shape)))
    batches = math.ceil(n / rows_of_batch)
    found = None
    for b in range(batches):
        rows = (own if batches == 1 else own.where(F.pmod(F.xxhash64("qid"), F.lit(batches)) == b)).collect()
        if rows:
            part = _search_batch(index, rows, k, first_clusters)
            found = part if found is None else found.unionByName(part)
    found = cut_lineage(found, "two-level-found") if batches > 1 else found
    scanned = found.where("id IS NULL").groupBy("qid").agg(F.sum("score").cast("long").alias("scanned"))
    return _ranked(found, k).join(scanned, "qid").select("qid", "id", "score", "rank", "scanned")
