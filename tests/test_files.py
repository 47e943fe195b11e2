from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.plans import relational
from tidemill.session import work_path
from tidemill.sources import files, reports


def test_title_block_in_split_files(spark):
    """Several files, of which the larger ones are read in several splits."""
    path = work_path(spark, "report")
    df = spark.range(5000).select(F.col("id").cast("string").alias("Id"), F.concat(F.lit("a, "), F.col("id")).alias("Name"))
    reports.write_report(df.repartition(3), path, ["Report", "x,y", "", "Id,Name"])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        got = reports.read_report(spark, path, ["Id", "Name"])
        assert got.rdd.getNumPartitions() > 3
        assert rows(got) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert rows(reports.read_report(spark, path, ["Id", "Name"])) == rows(df)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_guesses_types_and_parquet_keeps_them(spark, tables):
    df = relational.working_orders(tables)
    assert files.roundtrip(df, "parquet", "t").schema.simpleString() == df.schema.simpleString()
    assert dict(files.roundtrip(df, "csv", "t").dtypes)["order_id"] == "int"


def test_avro_if_installed(spark, tables):
    if not files.has_format(spark, "avro"):
        pytest.skip("the avro package is not on the classpath")
    df = relational.working_orders(tables)
    assert rows(files.roundtrip(df, "avro", "t")) == rows(df)


def test_formats_are_told_apart(spark):
    assert files.has_format(spark, "parquet") and files.has_format(spark, "csv")
    assert not files.has_format(spark, "no-such-format")


def test_months_outside_the_range_are_not_opened(spark, tables):
    path = work_path(spark, "months")
    files.write_by_month(tables.orders, path, "o_orderdate")
    lo, hi = date(1996, 3, 15), date(1996, 5, 2)
    got = files.read_month_range(spark, path, "o_orderdate", lo, hi)
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in text
    assert "GreaterThanOrEqual(o_orderdate" in text
    day = F.to_date("o_orderdate")
    assert rows(got.select("o_orderkey")) == rows(tables.orders.filter((day >= lo) & (day <= hi)).select("o_orderkey"))
    assert got.columns == tables.orders.columns


def test_versioned_export(spark, tables):
    folder = work_path(spark, "export")
    df = tables.nation.withColumn("_ingested_at", F.current_timestamp())
    one = files.export_csv(df, folder, "nations", ["_ingested_at"])
    two = files.export_csv(df, folder, "nations", ["_ingested_at"], files=3)
    assert one != two and "/nations_v20" in one
    for path in (one, two):
        assert spark.read.csv(path, header=True).count() == 25
        assert "_ingested_at" not in spark.read.csv(path, header=True).columns
    assert files.file_inventory(spark, one, "part-*.csv").count() == 1
    assert files.file_inventory(spark, two, "part-*.csv").count() == 3


def test_inventory_sizes(spark, tables):
    got = {r.file_name: r.size_bytes for r in files.file_inventory(spark, tables.folder).collect()}
    assert len(got) == 14 and all(n > 0 for n in got.values()) and "orders.parquet" in got


def test_frames_from_rows(spark):
    guessed = spark.createDataFrame([("Ann", 95), ("Bob", 87)], ["name", "score"])
    assert guessed.dtypes == [("name", "string"), ("score", "bigint")]
    exact = spark.createDataFrame([("W", 100, 9.99)], "product string, quantity int, price double")
    assert exact.dtypes == [("product", "string"), ("quantity", "int"), ("price", "double")]
    assert spark.createDataFrame(guessed.toPandas()).count() == 2
