"""Similarity of sparse vectors held as ``map<key, double>`` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def _shared(a: Column, b: Column) -> Column:
    return F.array_intersect(F.map_keys(a), F.map_keys(b))


def dot(a: str | Column, b: str | Column) -> Column:
    """Sum of products over the shared keys."""
    a, b = _col(a), _col(b)
    return _sum(F.transform(_shared(a, b), lambda k: F.element_at(a, k) * F.element_at(b, k)))


def norm(a: str | Column) -> Column:
    """Euclidean length over all keys."""
    return F.sqrt(_sum(F.transform(F.map_values(_col(a)), lambda w: w * w)))


def cosine(a: str | Column, b: str | Column) -> Column:
    """Dot product over both full lengths; null when one vector has no length."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def pearson(a: str | Column, b: str | Column) -> Column:
    """Correlation over the shared keys; 0 without shared keys or without variance."""
    a, b = _col(a), _col(b)
    keys = _shared(a, b)
    n = F.size(keys)
    xs = F.transform(keys, lambda k: F.element_at(a, k))
    ys = F.transform(keys, lambda k: F.element_at(b, k))
    sx, sy = _sum(xs), _sum(ys)
    sxx = _sum(F.transform(xs, lambda x: x * x))
    syy = _sum(F.transform(ys, lambda y: y * y))
    sxy = _sum(F.zip_with(xs, ys, lambda x, y: x * y))
    den = F.sqrt(F.abs(sxx - F.try_divide(sx * sx, n)) * F.abs(syy - F.try_divide(sy * sy, n)))
    ratio = F.try_divide(sxy - F.try_divide(sx * sy, n), den)
    return F.when(n == 0, F.lit(0.0)).otherwise(F.coalesce(ratio, F.lit(0.0)))
