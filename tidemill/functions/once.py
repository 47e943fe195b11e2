"""Expressions that are costly enough to be worked out a single time per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add columns whose value is computed exactly once per row.

    The optimizer copies a plain column's expression into each filter and
    projection that uses it: a parsed JSON text would be parsed again for every
    field and every condition. A generator of one row is not copied.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
