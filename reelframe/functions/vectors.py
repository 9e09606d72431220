"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a: Column | str, b: Column | str) -> Column:
    products = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column | str) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine of two vectors; 0 when either is the zero vector."""
    scale = norm(a) * norm(b)
    return F.when(scale == 0, F.lit(0.0)).otherwise(dot(a, b) / scale)


def squared_l2(a: Column | str, b: Column | str) -> Column:
    """Squared Euclidean distance."""
    gaps = F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") - y.cast("double"))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x * x)
