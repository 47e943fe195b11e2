"""Keep one row, or the first few rows, per key; and the first rows of a table.

Ranking with an upper limit is planned by Spark as a limit before and after
the shuffle, so each task sends at most ``n`` rows of a key. A key that holds
a large share of the table costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key; ``order`` should leave no ties."""
    return top_per_key(df, keys, order, 1).drop("_place")


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str = "_place") -> DataFrame:
    """The first ``n`` rows of every key, numbered from 1."""
    place = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("long"))


def ranked_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """Rows ranked up to ``n`` in their key; tied rows share a rank and are all kept."""
    place = F.rank().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, place).filter(F.col(name) <= n).withColumn(name, F.col(name).cast("long"))


def first_rows(df: DataFrame, key: str, n: int, buckets: int = 10_000) -> DataFrame:
    """The ``n`` rows with the smallest ``key``, a unique whole number.

    A plain sort with a large limit would send up to ``n`` rows of every task
    to one. Here a histogram of the key narrows down where the n-th row lies,
    bucket by bucket, and only rows up to there are read and sorted. Each
    round collects at most ``buckets`` counts.
    """
    ends = df.agg(F.min(key).alias("lo"), F.max(key).alias("hi")).first()
    if ends.lo is None:
        return df
    lo, hi, before = ends.lo, ends.hi, 0
    while hi > lo:
        width = (hi - lo) // buckets + 1
        bucket = F.expr(f"(`{key}` - {lo}L) div {width}L")  # whole numbers: doubles would blur large keys
        counts = df.filter(F.col(key).between(lo, hi)).groupBy(bucket.alias("b")).agg(F.count("*").alias("n")).collect()
        found = None
        for b, rows in sorted((r.b, r.n) for r in counts):
            if before + rows >= n:
                found = (b, rows)
                break
            before += rows
        if found is None:  # fewer than n rows in all
            return df
        lo, hi = lo + found[0] * width, min(hi, lo + (found[0] + 1) * width - 1)
        if found[1] <= max(n, buckets):
            break
    return df.filter(F.col(key) <= hi).orderBy(key).limit(n)
