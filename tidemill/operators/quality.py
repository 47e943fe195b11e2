"""Data-quality rules that warn, drop or stop, and tests that return violations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.money import total
from tidemill.session import stored


class ExpectationFailed(AssertionError):
    """A rule that must hold was violated."""


def holds(rule: str | Column) -> Column:
    """A rule as true or false; an unknown (null) outcome is a violation."""
    cond = F.expr(rule) if isinstance(rule, str) else rule
    return F.coalesce(cond, F.lit(False))


def expect(df: DataFrame, rules: dict[str, str | Column]) -> DataFrame:
    """Warn: one row per rule with rows seen, passed and failed, from a single pass.

    The rows themselves are not touched.
    """
    counts = df.agg(
        F.count("*").alias("rows"),
        *[F.count(F.when(~holds(r), 1)).alias(f"failed_{i}") for i, r in enumerate(rules.values())],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(name).alias("rule"),
                F.col("rows"),
                (F.col("rows") - F.col(f"failed_{i}")).alias("passed"),
                F.col(f"failed_{i}").alias("failed"),
            )
            for i, name in enumerate(rules)
        ]
    )
    return counts.select(F.inline(lines))


def expect_or_drop(df: DataFrame, rules: dict[str, str | Column]) -> tuple[DataFrame, DataFrame]:
    """Drop: the rows that satisfy every rule, and the report on all rows."""
    kept = df
    for rule in rules.values():
        kept = kept.filter(holds(rule))
    return kept, expect(df, rules)


def expect_or_fail(df: DataFrame, rules: dict[str, str | Column]) -> DataFrame:
    """Stop: raise if a rule has violations, else return the rows."""
    broken = expect(df, rules).filter("failed > 0").collect()  # one row per rule
    if broken:
        raise ExpectationFailed(", ".join(f"{r.rule}: {r.failed} of {r.rows} rows" for r in broken))
    return df


def unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once; rows with a null in the key are not looked at."""
    return df.dropna(subset=columns).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def accepted_values(df: DataFrame, column: str, values: list) -> DataFrame:
    """Values outside the list, and how often each occurs."""
    return (
        df.filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n"))
    )


def relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Foreign keys without a parent row, and how many rows carry each.

    The child is counted per key before the join, so a frequent key is one row.
    """
    keys = df.dropna(subset=[column]).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    return keys.join(parent.select(F.col(parent_column).alias("value")), "value", "left_anti")


#: Bits of a bitmap of ``bitmap_construct_agg``, and the bytes they take.
_BITS, _BITMAP_BYTES = 32_768, 4_096


def key_bitmaps(keys: DataFrame, column: str) -> DataFrame:
    """The distinct whole numbers of a column as bitmaps: ``bucket`` and ``bits``, merged from each task's own.

    Their size follows the keys: 4 KB for every range of 32,768 numbers that holds any.
    """
    key = F.col(column).cast("long")
    return keys.filter(key.isNotNull()).groupBy(F.bitmap_bucket_number(key).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(key)).alias("bits"))


def orphans_by_bitmap(df: DataFrame, column: str, parent: DataFrame, parent_column: str, most_bytes: int = 64 << 20) -> DataFrame:
    """As ``relationships``, for whole-number keys, without shuffling the child.

    The parent's keys are sent to all tasks as bitmaps and every child row is looked
    up where it stands; only orphans are counted and shuffled. Bitmaps are exact, so no
    key has to be checked again. If they take more than ``most_bytes``, as
    with few keys scattered over a wide range, the child is counted by key instead.
    """
    maps = stored(key_bitmaps(parent, parent_column), "key-bitmaps")
    if maps.count() * _BITMAP_BYTES > most_bytes:
        return relationships(df, column, parent, parent_column)
    key = F.col(column).cast("long")
    place = F.bitmap_bit_position(key)
    byte = F.conv(F.hex(F.substring("bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    there = F.col("bits").isNotNull() & (byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (place % 8).cast("int"))) != 0)
    looked_up = df.filter(key.isNotNull()).join(F.broadcast(maps), F.bitmap_bucket_number(key) == F.col("bucket"), "left")  # most_bytes at most
    return looked_up.filter(~there).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))


def singular(violations: DataFrame) -> DataFrame:
    """Any query that must return no rows; raises with a few of them if it does."""
    seen = violations.limit(5).collect()
    if seen:
        raise ExpectationFailed(f"rows found: {seen}")
    return violations


def total_drift(df: DataFrame, columns: list[str], target: float) -> DataFrame:
    """Per column its total and how far that is from the target."""
    totals = df.agg(*[total(c).alias(f"t{i}") for i, c in enumerate(columns)])
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"t{i}").alias("total")) for i, c in enumerate(columns)])
    return totals.select(F.inline(lines)).withColumn("drift", F.abs(F.col("total") - F.lit(target)))


def total_off_target(df: DataFrame, column: str, target: float, tolerance: float) -> DataFrame:
    """One row if the column's total is off its target by more than the tolerance, else none."""
    return (
        df.agg(total(column).alias("total"))
        .withColumn("drift", F.abs(F.col("total") - F.lit(target)))
        .filter(F.col("drift") > tolerance)
    )


def freshness(df: DataFrame, ts_col: str, as_of: datetime, warn_hours: float, error_hours: float) -> DataFrame:
    """Age of the newest row at ``as_of``, and whether that is late."""
    age = (F.lit(as_of).cast("timestamp_ntz").cast("timestamp").cast("double")
           - F.col("newest").cast("timestamp").cast("double")) / 3600
    return (
        df.agg(F.max(ts_col).alias("newest"))
        .withColumn("age_hours", F.round(age, 3))
        .withColumn(
            "status",
            F.when(F.col("age_hours") > error_hours, "error")
            .when(F.col("age_hours") > warn_hours, "warn")
            .otherwise("pass"),
        )
    )
