"""Rules counted while a table is written: no pass of their own.

The counts are observed metrics, added up by the tasks that write. A task's
counts are taken when its output is, so a task that is tried again counts once.
What the rules do to the rows:

``warn``  the rows are written, violations are counted;
``drop``  rows that violate are left out, and counted;
``fail``  violations withhold the whole result: rows go to a place of their own first,
          which becomes the table only if every such rule holds.

An unknown (null) outcome is a violation. Counts are of the rows that arrive, before
any are dropped. A table without rows has a report of zeros.
"""

from __future__ import annotations

from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemill.operators.quality import ExpectationFailed, holds

ACTIONS = ("warn", "drop", "fail")
REPORT = "rule string, action string, rows long, passed long, failed long"


@dataclass(frozen=True)
class Rule:
    name: str
    condition: str | Column
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")


@dataclass
class Written:
    """What a write did. ``broken`` names the fail rules that withheld it; then there is no table."""

    path: str
    rows: int
    kept: int
    failed: list[tuple[Rule, int]]
    broken: list[str]

    def report(self, spark: SparkSession) -> DataFrame:
        """One row per rule; the counts are already on the driver."""
        lines = [(r.name, r.action, self.rows, self.rows - n, n) for r, n in self.failed]
        return spark.createDataFrame(lines, REPORT)

    def table(self, spark: SparkSession) -> DataFrame:
        if self.broken:
            raise ExpectationFailed(f"{self.path} was withheld: {', '.join(self.broken)}")
        return spark.read.parquet(self.path)


def write_observed(df: DataFrame, path: str, rules: list[Rule], partition_by: list[str] | None = None) -> Written:
    """Write ``df`` to ``path`` and apply the rules on the way."""
    observation = Observation(f"rules-{uuid4().hex}")
    violated = [F.count(F.when(~holds(r.condition), 1)).alias(f"failed_{i}") for i, r in enumerate(rules)]
    kept = F.lit(True)
    for rule in rules:
        if rule.action == "drop":
            kept = kept & holds(rule.condition)
    watched = df.observe(observation, F.count(F.lit(1)).alias("rows"), F.count(F.when(kept, 1)).alias("kept"), *violated)
    unchecked = f"{path.rstrip('/')}.unchecked-{uuid4().hex}"
    writer = watched.filter(kept).write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(unchecked)
    counts = observation.get
    failed = [(r, counts.get(f"failed_{i}", 0)) for i, r in enumerate(rules)]
    broken = [r.name for r, n in failed if n and r.action == "fail"]
    if broken:
        _file_system(df.sparkSession, unchecked, lambda fs, place: fs.delete(place, True))
    else:
        _publish(df.sparkSession, unchecked, path)
    return Written(path, counts.get("rows", 0), counts.get("kept", 0), failed, broken)


def _file_system(spark: SparkSession, path: str, work):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return work(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place)


def _publish(spark: SparkSession, unchecked: str, path: str) -> None:
    """Give the checked folder its name; a table that is already there is not replaced."""
    to = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)

    def rename(fs, place) -> bool:
        return not fs.exists(to) and fs.rename(place, to)

    if not _file_system(spark, unchecked, rename):
        raise FileExistsError(path)
