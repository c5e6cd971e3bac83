"""Keyed-table scans and lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlake.operators.joins import broadcast_if_small


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Full scan of one Parquet table (``{base}/{name}.parquet``)."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def scan(df: DataFrame, columns: Sequence[str] | None = None, key: str | None = None,
         start=None, limit: int | None = None) -> DataFrame:
    """Projected scan, optional key range start and first-n rows in key order.

    The projection and the range predicate reach the Parquet reader (ReadSchema / PushedFilters);
    ``orderBy + limit`` becomes a TakeOrderedAndProject (per-task top-n, then a single merge).
    """
    out = df
    if start is not None:
        out = out.filter(F.col(key) >= F.lit(start))
    if columns:
        cols = list(columns) + ([key] if key and key not in columns else [])
        out = out.select(*cols)
    if limit is not None:
        out = out.orderBy(F.col(key).asc()).limit(limit)
        if columns and key not in columns:
            out = out.select(*columns)
    return out


def lookup(df: DataFrame, keys: DataFrame, key: str, max_broadcast_rows: int | None = None) -> DataFrame:
    """Point / batch lookup = semi-join on the key.

    With ``max_broadcast_rows`` (for key lists that are cheap to count, e.g. an in-memory batch)
    the keys are broadcast after a bounded count; otherwise AQE picks the strategy at runtime."""
    k = keys.select(key).distinct()
    if max_broadcast_rows is not None:
        k = broadcast_if_small(k, max_broadcast_rows)
    return df.join(k, on=key, how="left_semi")


def from_rows(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType | str) -> DataFrame:
    """Small in-memory rows with an explicit schema (fixtures and query batches only)."""
    return spark.createDataFrame(list(rows), schema=schema)
