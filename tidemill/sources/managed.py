"""Named tables: create, append under a fixed schema, list, drop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class SchemaMismatch(ValueError):
    """The rows do not fit the table; nothing was written."""


def create_or_replace(df: DataFrame, table: str, partition_by: list[str] | None = None, path: str | None = None) -> DataFrame:
    """Replace a table by the rows of ``df`` and return it.

    With ``path`` the files live there, so the table works where the default
    warehouse folder is not shared.
    """
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = df.hint("rebalance", *partition_by).write.mode("overwrite").format("parquet").partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return df.sparkSession.table(table)


def mismatches(given: T.StructType, wanted: T.StructType) -> list[str]:
    """Columns that are missing, unknown or of another type."""
    have = {f.name: f.dataType for f in given}
    need = {f.name: f.dataType for f in wanted}
    out = [f"missing column {n}" for n in need if n not in have]
    out += [f"unknown column {n}" for n in have if n not in need]
    out += [
        f"column {n} is {have[n].simpleString()}, table has {need[n].simpleString()}"
        for n in need
        if n in have and have[n] != need[n]
    ]
    return out


def append_enforced(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append only if the schema fits; checked before any row is written."""
    found = mismatches(df.schema, schema)
    if found:
        raise SchemaMismatch("; ".join(found))
    df.select(*schema.names).write.mode("append").parquet(path)


def tables_in(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {table}")


def drop(spark: SparkSession, table: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {table}")
