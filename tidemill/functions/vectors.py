"""Vector arithmetic on array columns, without leaving the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: str | Column, b: str | Column) -> Column:
    """Dot product of two arrays of equal length, added up in doubles."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def sigmoid(z: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-z))
