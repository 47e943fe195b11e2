"""Access to the source tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Tables:
    """The parquet tables under one folder, opened on first use."""

    spark: SparkSession
    folder: str

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def stream(self, name: str, schema: T.StructType | None = None, files_per_batch: int | None = None) -> DataFrame:
        """The same table as a file stream.

        A glob is passed because the source accepts it for a single file as
        well as for a folder of part files.
        """
        reader = self.spark.readStream.schema(schema or getattr(self, name).schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(f"{self.folder.rstrip('/')}/{name}.parque[t]")
