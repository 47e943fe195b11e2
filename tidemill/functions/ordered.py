"""Whole-table numbering and running values without a one-task window.

The rows are split into ordered blocks. Work inside a block is a window over
that block only; what crosses blocks is one small row per block, and the
number of blocks is bounded by the shuffle partitions (or by the calendar,
when the caller names a block column).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

BLOCK = "_block"


def range_blocks(df: DataFrame, *order: str) -> DataFrame:
    """Split by sampled ranges of ``order``, so the blocks are even in rows.

    The split is checkpointed: ranges are drawn from a sample, and every
    later read has to see the same ones.
    """
    return (
        df.repartitionByRange(*[F.col(c) for c in order])
        .withColumn(BLOCK, F.spark_partition_id())
        .checkpoint()
    )


def _ahead(blocked: DataFrame, block: str, values: dict[str, Column]) -> DataFrame:
    """For each block, the totals of all blocks before it (one row per block)."""
    before = W.orderBy(block).rowsBetween(W.unboundedPreceding, -1)
    return (
        blocked.groupBy(block)
        .agg(*[v.alias(n) for n, v in values.items()])
        .select(block, *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_ahead_{n}") for n in values])
    )


def running_total(df: DataFrame, block: str, order: str | list[str], values: dict[str, Column]) -> DataFrame:
    """Running sums along ``order``.

    ``block`` must rise with ``order``, which must be unique, or peers would
    be cut. ``values`` maps each new column to the amount it adds up. ``df``
    is computed once and checkpointed, as its rows are read twice. Blocks of
    ``range_blocks`` are as few as the shuffle partitions; other blocks carry
    no hint, as nothing bounds their number.
    """
    held = df.withColumns({f"_v_{n}": v for n, v in values.items()}).checkpoint()
    ahead = _ahead(held, block, {n: F.sum(f"_v_{n}") for n in values})
    local = W.partitionBy(block).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return held.join(F.broadcast(ahead) if block == BLOCK else ahead, block).select(  # one row per block
        *df.columns,
        *[(F.sum(f"_v_{n}").over(local) + F.col(f"_ahead_{n}")).alias(n) for n in values],
    )


def numbered(df: DataFrame, *order: str, name: str = "position") -> DataFrame:
    """Number rows 0, 1, 2 … in the order of ``order`` (unique together)."""
    blocked = range_blocks(df, *order)
    ahead = _ahead(blocked, BLOCK, {"rows": F.count(F.lit(1))})
    local = W.partitionBy(BLOCK).orderBy(*order)
    return blocked.join(F.broadcast(ahead), BLOCK).select(  # one row per block
        *df.columns,
        (F.row_number().over(local) - 1 + F.col("_ahead_rows")).cast("long").alias(name),
    )


def last_known(df: DataFrame, order: list[str], value: str, name: str) -> DataFrame:
    """For every row, the largest ``value`` seen at or before it along ``order``.

    ``value`` must not fall along ``order``; rows without one carry null.
    """
    blocked = range_blocks(df, *order)
    ahead = W.orderBy(BLOCK).rowsBetween(W.unboundedPreceding, -1)
    carry = (
        blocked.groupBy(BLOCK)
        .agg(F.max(value).alias("_top"))
        .select(BLOCK, F.max("_top").over(ahead).alias("_carry"))
    )
    local = W.partitionBy(BLOCK).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return blocked.join(F.broadcast(carry), BLOCK).select(  # one row per block
        *df.columns,
        F.coalesce(F.max(value).over(local), F.col("_carry")).alias(name),
    )
