"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str = "local[*]", app: str = "tidemill", partitions: int | None = None) -> SparkSession:
    """A session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="run-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def prepare(spark: SparkSession) -> None:
    """Let checkpoints go to the shared folder where one is known; jobs without any need none."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.master.startswith("local"):
        shared_folder(spark)


def remove_work(spark: SparkSession) -> None:
    """Remove what the jobs of this session's folder have stored. Only call it when no result is read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/tidemill")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path for one run's output; runs never share or overwrite one."""
    return f"{shared_folder(spark).rstrip('/')}/tidemill/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and continue from the files.

    Used where a result feeds several branches: each branch then scans the
    stored rows, and a lost executor costs a re-read, not a recomputation.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
