from __future__ import annotations

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.session import work_path
from tidemill.sources import managed, versions


@pytest.fixture
def path(spark):
    return work_path(spark, "test")


def table(spark, n=40):
    return spark.range(n).select("id", F.concat(F.lit("p"), F.col("id") % 5).alias("p"), (F.col("id") * 1.5).alias("v"))


def day(n):
    return datetime(2024, 1, n, tzinfo=timezone.utc)


def test_update_keeps_old_versions(spark, path):
    df = table(spark)
    versions.append(df, path, 0, at=day(1))
    assert versions.update_where(spark, path, ["id"], F.col("p") == "p1", {"p": F.lit("x"), "v": F.col("v") + 1}, at=day(3)) == 1
    assert rows(versions.as_of(spark, path, ["id"], version=0)) == rows(df)
    assert rows(versions.as_of(spark, path, ["id"], at=day(2))) == rows(df)
    now = versions.as_of(spark, path, ["id"])
    assert now.count() == 40 and now.filter("p = 'x'").count() == 8
    assert rows(now.filter("p <> 'x'")) == rows(df.filter("p <> 'p1'"))
    # a second change finds the rows as the first one left them
    assert versions.update_where(spark, path, ["id"], F.col("p") == "x", {"p": F.lit("y")}) == 2
    assert versions.as_of(spark, path, ["id"]).filter("p = 'y'").count() == 8
    assert rows(versions.history(spark, path).select("version", "operation", "rows_written")) == [
        (0, "WRITE", 40), (1, "UPDATE", 8), (2, "UPDATE", 8),
    ]
    assert rows(versions.diff_counts(spark, path, ["id"], 0, 2, "p").filter("old_rows <> new_rows")) == [("p1", 8, 0), ("y", 0, 8)]


def test_update_without_a_match(spark, path):
    versions.append(table(spark), path, 0)
    assert versions.update_where(spark, path, ["id"], F.col("p") == "none", {"v": F.lit(0.0)}) == 1
    assert rows(versions.as_of(spark, path, ["id"])) == rows(table(spark))
    with pytest.raises(ValueError, match="key"):
        versions.update_where(spark, path, ["id"], F.lit(True), {"id": F.lit(1)})


def test_nothing_before_the_first_write(spark, path):
    versions.append(table(spark), path, 0, at=day(5))
    assert versions.as_of(spark, path, ["id"], at=day(4)).count() == 0


def test_a_hot_key_is_one_row_per_task(spark, path):
    for v in range(6):
        versions.append(spark.range(300).select((F.col("id") % 3).alias("id"), F.lit(v).alias("v")), path, v)
    now = versions.as_of(spark, path, ["id"])
    assert now._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(now) == [(0, 5), (1, 5), (2, 5)]


def test_append_is_checked_before_writing(spark, path):
    schema = table(spark).schema
    managed.append_enforced(table(spark), path, schema)
    bad = spark.createDataFrame([("x", "p1", 1.0)], "id string, p string, v double")
    with pytest.raises(managed.SchemaMismatch, match="column id is string, table has bigint"):
        managed.append_enforced(bad, path, schema)
    with pytest.raises(managed.SchemaMismatch, match="missing column v"):
        managed.append_enforced(table(spark).drop("v"), path, schema)
    assert spark.read.parquet(path).count() == 40


def test_named_tables(spark, path):
    df = managed.create_or_replace(table(spark), "t_named", ["p"], path)
    assert df.count() == 40
    assert managed.tables_in(spark, "default").filter("tableName = 't_named'").count() == 1
    assert managed.describe(spark, "t_named").filter("col_name = 'Provider'").first().data_type == "parquet"
    assert spark.sql("SHOW CATALOGS").count() >= 1
    managed.drop(spark, "t_named")
    assert not spark.catalog.tableExists("t_named")
