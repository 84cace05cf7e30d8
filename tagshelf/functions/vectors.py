"""Expressions over vectors held as ``array<double>``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def vector_literal(values: Sequence[float]) -> Column:
    """A constant vector."""
    return F.array(*[F.lit(float(v)) for v in values])


def dot(a: str | Column, b: str | Column) -> Column:
    """Inner product of two vectors of one length."""
    products = F.zip_with(a, b, lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(a: str | Column) -> Column:
    """Euclidean length."""
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda total, x: total + x * x))


def cosine(a: str | Column, b: str | Column,
           norm_a: str | Column | None = None, norm_b: str | Column | None = None) -> Column:
    """Cosine similarity; 0.0 where either vector has length zero.

    Pass stored lengths to save recomputing them for every row.
    """
    left = norm(a) if norm_a is None else _column(norm_a)
    right = norm(b) if norm_b is None else _column(norm_b)
    return F.when((left == 0) | (right == 0), F.lit(0.0)).otherwise(dot(a, b) / (left * right))


def percent_text(similarity: str | Column) -> Column:
    """A similarity as shown to people: hundredfold, two decimals."""
    return F.format_string("%.2f", _column(similarity) * 100)


def _column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c
