"""Text reports whose header sits below a block of title lines."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


TITLE_LINES = 4
CSV_OPTIONS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def write_report(df: DataFrame, path: str, title: list[str]) -> None:
    """Write delimited text files; each starts with the title lines and a header."""
    head = [*title, ",".join(df.columns)]
    lines = df.select(F.to_csv(F.struct(*df.columns), CSV_OPTIONS).alias("value"))

    def with_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield pd.DataFrame({"value": head})
        yield from batches

    lines.mapInPandas(with_head, "value string").write.text(path)


def read_report(spark: SparkSession, path: str, columns: list[str], title_lines: int = TITLE_LINES) -> DataFrame:
    """The data lines of every report under ``path``, all columns as text.

    Files are split as usual, so one may be of any size. Only the split that
    starts a file holds its title; those lines are left out while the split
    streams by, in one pass and without a shuffle.
    """
    head = title_lines + 1  # the header line ends the block

    def below_head(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}  # lines met so far per file that starts in this task
        for batch in batches:
            starts = batch["at"] == 0
            place = batch.groupby("file").cumcount() + batch["file"].map(seen).fillna(0)
            for file, n in batch.loc[starts, "file"].value_counts().items():
                seen[file] = seen.get(file, 0) + n
            yield batch.loc[~starts | (place >= head), ["value"]]

    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at")
    )
    schema = ", ".join(f"`{c}` string" for c in columns)
    body = lines.mapInPandas(below_head, "value string")
    return body.select(F.from_csv("value", schema, CSV_OPTIONS).alias("r")).select("r.*")
