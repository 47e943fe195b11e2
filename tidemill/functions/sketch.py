"""Quantiles from summaries that are stored and merged by later runs.

A KLL sketch of ``k`` keeps a few thousand values of a column of any length. Sketches of
parts (days, files, runs) merge into the sketch of the whole, so a new part costs only
itself. The rank of a quantile is off by at most ``rank_error(k)`` of the rows, at
99% confidence; up to ``k`` values it is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SKETCH = "sketch"


def rank_error(k: int) -> float:
    """The published bound of a KLL sketch on the normalised rank of one quantile."""
    return 2.296 / k**0.9021


def sketches(df: DataFrame, by: list[str], value: str, k: int = 400) -> DataFrame:
    """One sketch of ``value`` per group; nulls are left out. Each task sketches its own part first."""
    return df.filter(F.col(value).isNotNull()).groupBy(*by).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), k).alias(SKETCH))


def merged(stored: DataFrame, by: list[str]) -> DataFrame:
    """Sketches of parts as one per group."""
    return stored.groupBy(*by).agg(F.kll_merge_agg_double(SKETCH).alias(SKETCH))


def quantile(share: float) -> Column:
    return F.kll_sketch_get_quantile_double(SKETCH, F.lit(share))


def count() -> Column:
    """How many values the sketch stands for."""
    return F.kll_sketch_get_n_double(SKETCH)
