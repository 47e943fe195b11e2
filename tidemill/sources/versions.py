"""Versions of a table as rows: what a version changes is appended, readers take the newest per key.

Every row carries the version that wrote it, what wrote it and when. The state
at a version or a time is a filter and the first row per key; the history is a
group-by. Nothing is rewritten, so an update costs the rows it changes.

Appends are ordinary parquet writes with one writer at a time. Rows are never
taken away; a table that has to lose rows keeps a column that says so.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.latest import first_per_key

VERSION, OPERATION, WRITTEN_AT = "_version", "_operation", "_written_at"
META = [VERSION, OPERATION, WRITTEN_AT]


def append(rows: DataFrame, path: str, version: int, operation: str = "WRITE", at: datetime | None = None) -> None:
    """Add rows as one version; ``at`` is when it counts as written (now by default)."""
    stamped = rows.withColumns({
        VERSION: F.lit(version).cast("long"),
        OPERATION: F.lit(operation),
        WRITTEN_AT: F.lit(at or datetime.now(timezone.utc)).cast("timestamp"),
    })
    stamped.write.mode("append").parquet(path)


def newest_version(spark: SparkSession, path: str) -> int:
    """The highest version so far; the scan reads one column, mostly its statistics."""
    return spark.read.parquet(path).agg(F.max(VERSION).alias("v")).first().v


def as_of(spark: SparkSession, path: str, key: list[str], version: int | None = None, at: datetime | None = None) -> DataFrame:
    """The rows of one version, or of the newest version at a time; else the current rows."""
    rows = spark.read.parquet(path)
    if version is not None:
        rows = rows.filter(F.col(VERSION) <= version)
    if at is not None:
        rows = rows.filter(F.col(WRITTEN_AT) <= F.lit(at))
    return first_per_key(rows, key, [F.desc(VERSION)]).drop(*META)


def update_where(spark: SparkSession, path: str, key: list[str], predicate: Column, assignments: dict[str, Column], at: datetime | None = None) -> int:
    """Set columns where ``predicate`` holds, as a new version of the rows it changes."""
    if set(assignments) & set(key):
        raise ValueError("the key cannot be updated")
    version = newest_version(spark, path) + 1
    current = as_of(spark, path, key)
    kinds = dict(current.dtypes)
    changed = current.filter(predicate).select(
        *[(assignments[c].cast(kinds[c]) if c in assignments else F.col(c)).alias(c) for c in current.columns]
    )
    append(changed, path, version, "UPDATE", at)
    return version


def history(spark: SparkSession, path: str) -> DataFrame:
    """One row per version that wrote rows: when, what, how many."""
    return (
        spark.read.parquet(path)
        .groupBy(F.col(VERSION).alias("version"), F.col(OPERATION).alias("operation"))
        .agg(F.min(WRITTEN_AT).alias("committed_at"), F.count("*").alias("rows_written"))
        .orderBy("version")
    )


def diff_counts(spark: SparkSession, path: str, key: list[str], old: int, new: int, column: str) -> DataFrame:
    """How often each value of a column occurs in two versions, from one scan.

    Per key the newest value up to each version is kept, with partial results
    before the shuffle; only the key, the column and the version are read.
    """
    rows = spark.read.parquet(path).filter(F.col(VERSION) <= max(old, new))

    def newest(version: int) -> Column:
        place = F.when(F.col(VERSION) <= version, F.col(VERSION))
        return F.struct(F.max_by(column, place).alias("value"), F.max(place).isNotNull().alias("there"), F.lit(version == old).alias("old"))

    sides = rows.groupBy(*key).agg(F.array(newest(old), newest(new)).alias("_sides")).select(F.inline("_sides")).filter("there")
    return sides.groupBy("value").agg(
        F.count(F.when(F.col("old"), 1)).alias("old_rows"),
        F.count(F.when(~F.col("old"), 1)).alias("new_rows"),
    )
