"""M2: principal components of sparse rows by a randomised range finder.

Rows are postings ``(id, term, weight)`` with weights of at least 0; every term counts, and no table of terms is held by a task
or the driver. With A the matrix of rows and terms, less the mean row:

1. Y = A W for random numbers W that depend on the term alone, so W is no table;
2. Q, an orthonormal basis of Y's columns, from the small matrix Y'Y (a Cholesky factor);
3. ``power_steps`` times: Z = A'Q, Y = A Z, and Q anew, which turns the basis towards the large components;
4. B = Q'A is Z' again; the eigenvectors of the small matrix Z'Z give the components.

Products with A are joins with the postings and weighted vector sums, which are combined inside each task. The mean row is never
formed: the columns of Q sum to 0, so A'Q needs none, and A Z is centred by its own column means. Only matrices of
``k + oversample`` rows and columns come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlake.session import cut_lineage, ship_package

OVERSAMPLE, POWER_STEPS = 10, 3


def _random(size: int, seed: int):
    """``size`` normal numbers for each term, from its hash."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = [np.random.default_rng([seed, h & ((1 << 64) - 1)]).standard_normal(size) for h in batch.column("hash").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("term"), pa.array(numbers, pa.list_(pa.float64()))], ["term", "v"])
    return run


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def _gram_task(size: int):
    """Rows (i, row i of X'X) of one task, X with a last column of ones."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            x = np.hstack([_matrix(batch.column("v"), size), np.ones((batch.num_rows, 1))])
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "g"])
    return run


def _gram(vectors: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """X'X, the column sums and the number of rows."""
    parts = vectors.select("v").mapInArrow(_gram_task(size), "i int, g array<double>")
    rows = parts.groupBy("i").agg(Summarizer.sum(array_to_vector("g")).alias("g")).collect()          # size + 1 rows
    total = np.zeros((size + 1, size + 1))
    for r in rows:
        total[r.i] = r.g.toArray()
    return total[:size, :size], total[size, :size], round(total[size, size])


def _times(vectors: DataFrame, minus: np.ndarray, by: np.ndarray, key: str) -> DataFrame:
    """(v - minus) times a small matrix, for every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = (_matrix(batch.column("v"), len(minus)) - minus) @ by
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(list(out), pa.list_(pa.float64()))], [key, "v"])
    kind = dict(vectors.dtypes)[key]
    return vectors.select(key, "v").mapInArrow(run, f"`{key}` {kind}, v array<double>")


def _product(postings: DataFrame, vectors: DataFrame, over: str, to: str) -> DataFrame:
    """(to, v): sums of weight times the vector of ``over``, for each ``to``."""
    met = postings.join(vectors.select(over, array_to_vector("v").alias("x")), over)
    return met.groupBy(to).agg(vector_to_array(Summarizer.sum(F.col("x"), F.col("weight"))).alias("v"))


def components(rows: DataFrame, postings: DataFrame, k: int, id_col: str = "id", oversample: int = OVERSAMPLE,
               power_steps: int = POWER_STEPS, seed: int = 42) -> tuple[DataFrame, np.ndarray]:
    """((id, pca_features array of k numbers) for every id of ``rows``, variances of the components).

    ``postings``: (id, term, weight), one row per id and term. An id without postings is a row of zeros. Fewer components
    come back where the data have fewer. Components are centred; their signs are fixed by the largest coefficient in the basis.
    """
    ship_package(rows.sparkSession)
    ids = cut_lineage(rows.select(F.col(id_col).alias("id")).distinct(), "pca-ids")
    a = cut_lineage(postings.where("weight > 0").select(F.col(id_col).alias("id"), "term", "weight"), "pca-postings")
    n, n_terms = ids.count(), a.select("term").distinct().count()
    size = min(k + oversample, n - 1, n_terms)
    if size < 1:
        return ids.select(F.col("id").alias(id_col), F.array().cast("array<double>").alias("pca_features")), np.zeros(0)
    terms = a.groupBy("term").agg(F.xxhash64("term").alias("hash"))
    z = cut_lineage(terms.mapInArrow(_random(size, seed), f"term {dict(a.dtypes)['term']}, v array<double>"), "pca-random")

    def basis(z: DataFrame) -> DataFrame:
        """Orthonormal, centred columns that span A Z."""
        y = ids.join(_product(a, z, "term", "id"), "id", "left").select("id", F.coalesce("v", F.array_repeat(F.lit(0.0), size)).alias("v"))
        y = cut_lineage(y, "pca-y")
        for _ in range(2):                                    # a second time for the rounding errors of the first
            gram, sums, rows_ = _gram(y, size)
            centred = gram - np.outer(sums, sums) / rows_
            values, vectors = np.linalg.eigh(centred)
            keep = values > max(values[-1], 0) * 1e-13
            by = np.where(keep, vectors / np.sqrt(np.where(keep, values, 1)), 0)      # directions without extent become zero
            y = cut_lineage(_times(y, sums / rows_, by, "id"), "pca-q")
        return y

    q = basis(z)
    for _ in range(power_steps):
        q = basis(cut_lineage(_product(a, q, "id", "term"), "pca-z"))
    z = cut_lineage(_product(a, q, "id", "term"), "pca-z")
    squares, turn = np.linalg.eigh(_gram(z, size)[0])
    order = np.argsort(squares)[::-1][:k]
    order = order[squares[order] > max(squares.max(), 0) * 1e-12]
    turn = turn[:, order]
    turn = turn * np.sign(turn[np.abs(turn).argmax(axis=0), np.arange(turn.shape[1])])
    scores = _times(q, np.zeros(size), turn * np.sqrt(squares[order]), "id")
    return scores.select(F.col("id").alias(id_col), F.col("v").alias("pca_features")), squares[order] / max(1, n - 1)
