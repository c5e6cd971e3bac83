"""Sinks (K8, K9, K11-K13, K15): appends, messages, CSV export, typed conformance, overwrite."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """K8: append without a key (a re-run appends again, as the source pipeline did)."""
    df.write.mode("append").format(fmt).save(path)


def overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Drop and recreate."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def to_message(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """K9: one JSON message per row, nulls kept as ``null``."""
    cols = list(cols or df.columns)
    return df.select(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}).alias("value"))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, every field quoted (re-read with ``multiLine`` for embedded newlines)."""
    (df.write.mode("overwrite").option("header", True).option("quoteAll", True).option("escape", '"')
     .csv(path))


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """Enforce a document mapping: every field of ``schema`` present, ``try_cast`` to its type (a
    value that does not fit becomes NULL instead of failing the job); extra columns but ``keep`` dropped."""
    cols = []
    for f in schema.fields:
        if f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep)


def conform_rejects(df: DataFrame, schema: T.StructType) -> DataFrame:
    """K12 report: per field, how many non-null input values did not fit the mapping type."""
    aggs = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name)
            for f in schema.fields if f.name in df.columns]
    return df.agg(*aggs)


def save_model(model, path: str) -> None:
    """Save an ML model / pipeline, overwriting."""
    model.write().overwrite().save(path)
