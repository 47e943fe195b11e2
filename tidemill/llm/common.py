"""What the operators of this package share: inputs, identities, spans."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.session import shared_folder, stored

#: Bytes handed to Python at once: texts may be long, so batches are bounded by size.
BATCH_BYTES = "4m"
#: Stands for a missing id: it counts as larger than any other.
NO_ID = (1 << 63) - 1

SPAN = "array<struct<a:long,b:long>>"


def prepared(spark: SparkSession) -> SparkSession:
    """Small batches towards Python, and the cluster's shared folder for checkpoints."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    shared_folder(spark)
    return spark


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores put before it until no column has it."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def besides(df: DataFrame, result: str) -> list[Column]:
    """All columns of ``df``, but for one that has the result's name: the result replaces it."""
    return [col(c) for c in df.columns if c.lower() != result.lower()]


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc``, ``sig`` and ``text`` (UTF-8 bytes) of every row, null texts as empty.

    ``doc`` and ``sig`` together tell rows apart, but for exact repetitions of
    a row, which any operator here treats alike.
    """
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return docs.select(identity(docs, id_col).alias("doc"), F.xxhash64(text).alias("sig"), text.cast("binary").alias("text"))


def identity(docs: DataFrame, id_col: str = "doc_id") -> Column:
    return F.coalesce(col(id_col).cast("long"), F.lit(NO_ID))


def parts_for(df: DataFrame, amount: Column, each: int) -> tuple[int, int]:
    """The sum of ``amount``, and into how many parts of ``each`` it goes."""
    total = df.agg(F.coalesce(F.sum(amount), F.lit(0)).alias("n")).first().n
    return total, max(1, -(-total // each))


def merged(spans) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the union of half-open spans, rising."""
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.array([s["a"] for s in spans], np.int64)
    b = np.array([s["b"] for s in spans], np.int64)
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    new = np.ones(len(a), bool)
    new[1:] = a[1:] > b[:-1]
    first = np.flatnonzero(new)
    return a[first], b[np.append(first[1:] - 1, len(a) - 1)]


def ranges(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values."""
    step = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


__all__ = ["BATCH_BYTES", "NO_ID", "SPAN", "besides", "col", "identity", "merged", "parts_for", "prepared", "ranges", "stored", "texts_of", "unused"]
