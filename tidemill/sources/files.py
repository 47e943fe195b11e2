"""Reading and writing table files in several formats and layouts."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.text import safe_name
from tidemill.session import work_path

MONTH = "order_month"


def roundtrip(df: DataFrame, fmt: str, name: str, **options: str) -> DataFrame:
    """Write in one format and read back.

    CSV returns with inferred types, as a reader without a schema would see
    them; the other formats keep their own.
    """
    path = work_path(df.sparkSession, f"{name}-{fmt}")
    spark = df.sparkSession
    if fmt == "csv":
        df.write.options(header="true", **options).csv(path)
        return spark.read.options(header="true", inferSchema="true", **options).csv(path)
    df.write.format(fmt).options(**options).save(path)
    return spark.read.format(fmt).options(**options).load(path)


def has_format(spark: SparkSession, fmt: str) -> bool:
    """Whether a format's package is on the classpath (avro and kafka are optional)."""
    try:
        spark.read.format(fmt).load()
    except Exception as err:  # the reader complains about missing paths when the format exists
        text = str(err)
        return "Failed to find" not in text and "DATA_SOURCE_NOT_FOUND" not in text and "AVRO" not in text.upper()
    return True


def format_counts(df: DataFrame, formats: list[str], name: str) -> DataFrame:
    """Rows that each format gives back."""
    out = None
    for fmt in formats:
        counted = roundtrip(df, fmt, name).agg(F.count("*").alias("rows")).select(F.lit(fmt).alias("format"), "rows")
        out = counted if out is None else out.unionByName(counted)
    return out


def write_partitioned(df: DataFrame, path: str, columns: list[str]) -> None:
    """Write one folder per value of ``columns``.

    The rebalance hint gathers a value's rows into few files, and lets
    adaptive execution split a value that holds much of the table.
    """
    df.hint("rebalance", *columns).write.partitionBy(*columns).mode("overwrite").parquet(path)


def write_by_month(df: DataFrame, path: str, date_col: str) -> None:
    """Partition by the month of a date column; readers only name the date."""
    month = F.date_format(date_col, "yyyy-MM")
    write_partitioned(df.withColumn(MONTH, month), path, [MONTH])


def read_month_range(spark: SparkSession, path: str, date_col: str, lo: date, hi: date) -> DataFrame:
    """Rows with ``lo <= date <= hi``; months outside the range are not opened."""
    rows = spark.read.option("basePath", path).schema(
        spark.read.parquet(path).drop(MONTH).schema.add(MONTH, "string")
    ).parquet(path)
    when = F.col(date_col)
    return (
        rows.filter(F.col(MONTH).between(lo.strftime("%Y-%m"), hi.strftime("%Y-%m")))
        .filter((when >= F.lit(lo)) & (when < F.lit(hi + timedelta(days=1))))
        .drop(MONTH)
    )


def file_inventory(spark: SparkSession, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """Name and size of every file; file contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", pattern)
        .load(folder)
    )
    return files.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.col("length").alias("size_bytes"))


def export_csv(df: DataFrame, folder: str, name: str, drop: list[str], files: int | None = None) -> str:
    """A versioned CSV export ``<name>_v<timestamp>.csv`` without the metadata columns.

    The caller says into how many files; by default each task writes its own.
    """
    path = f"{folder.rstrip('/')}/{name}_v{datetime.now():%Y%m%d_%H%M%S_%f}.csv"
    rows = df.drop(*drop)
    if files is not None:
        rows = rows.repartition(files)
    rows.write.mode("overwrite").option("header", "true").csv(path)
    return path


def decimals_as_doubles(df: DataFrame) -> DataFrame:
    """Decimal columns as doubles, for readers that calculate and plot."""
    return df.select(
        *[F.col(c).cast("double").alias(c) if kind.startswith("decimal") else F.col(c) for c, kind in df.dtypes]
    )


def capture_raw(df: DataFrame, source_file: str, source_sheet: str) -> DataFrame:
    """Every column as text under a space-free name, plus where and when it came from."""
    return df.select(
        *[F.col(f"`{c}`").cast("string").alias(safe_name(c)) for c in df.columns],
        F.lit(source_file).alias("_source_file"),
        F.lit(source_sheet).alias("_source_sheet"),
        F.current_timestamp().alias("_ingested_at"),
    )
