"""Vector maths on ``array<float|double>`` columns as native higher-order functions (V1-V4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_double(v) -> Column:
    return F.transform(_c(v), lambda x: x.cast("double"))


def _sum(arr: Column) -> Column:
    return F.aggregate(arr, F.lit(0.0).cast("double"), lambda acc, x: acc + x)


def norm(v) -> Column:
    return F.sqrt(_sum(F.transform(as_double(v), lambda x: x * x)))


def unit(v) -> Column:
    """V1: L2-normalise; a zero vector stays zero.

    The norm is bound once per row through a one-element outer ``transform``: referencing the norm
    expression directly inside the element lambda would recompute it for every element."""
    d = as_double(v)
    return F.transform(F.array(norm(v)), lambda n: F.transform(
        d, lambda x: F.when(n > 0, x / n).otherwise(F.lit(0.0)))).getItem(0)


def dot(a, b) -> Column:
    """V2: raw dot product."""
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def cosine(a, b) -> Column:
    """V3: cosine similarity; null when either vector is zero."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def sq_l2(a, b) -> Column:
    """V4: squared Euclidean distance."""
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def round_array(v, digits: int = 6) -> Column:
    return F.transform(_c(v), lambda x: F.round(x, digits))
