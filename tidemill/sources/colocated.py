"""Tables laid out for their joins: bucketed by key, or in folders that a join can leave out.

Two tables in the same number of buckets by the key they are joined on are joined
bucket by bucket: no row is shuffled. A fact table in folders by a dimension's
key is read only in the folders that the filtered dimension leaves (dynamic pruning).
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame

from tidemill.session import work_path


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` in buckets by ``key``, sorted within them, and return the table.

    Rows are dealt out by the buckets' own hash first, so each bucket is one file
    rather than one from every task.
    """
    table = f"{name}_{uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", work_path(df.sparkSession, table)).saveAsTable(table)
    return df.sparkSession.table(table)


def foldered(df: DataFrame, name: str, by: str) -> DataFrame:
    """Write ``df`` in one folder per value of ``by`` and read it back."""
    path = work_path(df.sparkSession, name)
    df.hint("rebalance", by).write.partitionBy(by).parquet(path)
    return df.sparkSession.read.parquet(path)
