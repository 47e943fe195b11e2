"""Sensor readings as a stream: parse, filter, running means, windows, alerts.

Every transformation works on a batch DataFrame too. Queries run with
``availableNow``: they take all that has arrived, then stop, and the next
start goes on from the checkpoint.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions.latest import first_per_key
from tidemill.functions.once import evaluated_once
from tidemill.sources.keyed import KeyedTable

READING_SCHEMA = (
    "reading_id long, student string, sensor_id string, temperature_c double, humidity_pct double, timestamp string"
)
# Reports of batches that a run keeps; a few kilobytes each in the driver.
KEPT_REPORTS, MOST_REPORTS = "spark.sql.streaming.numRecentProgressUpdates", 100_000
# How the files of a checkpoint are written.
CHECKPOINT_FILES = "spark.sql.streaming.checkpointFileManagerClass"
BY_FILE_SYSTEM = "org.apache.spark.sql.execution.streaming.checkpointing.FileSystemBasedCheckpointFileManager"
READING_FIELDS = ["reading_id", "student", "sensor_id", "temperature_c", "humidity_pct"]


# --- sources and sinks ---------------------------------------------------------

def topic_source(spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None,
                 **options: str) -> DataFrame:
    """Keyed messages of a Kafka topic from the earliest offset on.

    Needs the Kafka package on the classpath. Offsets are kept in each
    query's checkpoint, so every checkpoint is a consumer group of its own.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def folder_source(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same messages as parquet files in a folder."""
    reader = spark.readStream.schema("key string, value string")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def to_messages(df: DataFrame, key: Column, fields: list[str]) -> DataFrame:
    """Rows as keyed JSON. A fixed key always meets the same partition of a topic, in order."""
    return df.select(key.alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def start_to_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str) -> StreamingQuery:
    """Send keyed messages on to another topic. Needs the Kafka package."""
    return (
        messages.select("key", "value").writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def start_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Start a query that appends what is there to parquet files, exactly once, and stops."""
    return (
        df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start(path)
    )


def ended(queries: Iterable[StreamingQuery], at_once: int | None = None) -> Iterator[StreamingQuery]:
    """Queries that run side by side, each when it has ended; if one fails the others are stopped.

    With ``at_once`` no more are taken from ``queries`` while so many run, so an iterator can start them in turn.
    """
    running = deque()
    try:
        for query in queries:
            running.append(query)
            if len(running) == at_once:
                running[0].awaitTermination()
                yield running.popleft()
        while running:
            running[0].awaitTermination()
            yield running.popleft()
    finally:
        for query in running:
            if query.isActive:
                query.stop()


def run_to_files(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is there to parquet files, exactly once, then stop."""
    [query] = ended([start_to_files(df, path, checkpoint)])
    return query


def run_batches(df: DataFrame, checkpoint: str, mode: str, write: Callable[[DataFrame, int], None]) -> StreamingQuery:
    """Hand each micro-batch to ``write``, then stop."""
    query = (
        df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
        .foreachBatch(write).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


class Interrupted(RuntimeError):
    """A run that ends on purpose before its input does."""


def interrupt_after(write: Callable[[DataFrame, int], None], batches: int, written: bool = False) -> Callable[[DataFrame, int], None]:
    """A sink that takes ``batches`` batches and stops the query at the next one.

    With ``written`` it stops after writing that batch, but before the query
    has noted it as done: a restart brings the batch again.
    """
    taken = []

    def take(batch: DataFrame, batch_id: int) -> None:
        if len(taken) < batches or written:
            write(batch, batch_id)
        if len(taken) == batches:
            raise Interrupted(f"stopped at batch {batch_id}")
        taken.append(batch_id)

    return take


def run_interrupted(df: DataFrame, checkpoint: str, mode: str, write: Callable[[DataFrame, int], None]) -> None:
    """Run into a sink of ``interrupt_after``; any other failure is raised."""
    try:
        run_batches(df, checkpoint, mode, write)
    except StreamingQueryException as err:
        if Interrupted.__name__ not in str(err):
            raise


class BatchLog:
    """Batches that brought rows, per run of a query.

    They are counted from the reports on each batch that a listener would be handed, read when the
    run has ended: to call a Python listener costs a fifth of a second a batch, one after the other.
    """

    def of(self, query: StreamingQuery, wait_s: float = 60) -> dict[int, int]:
        """The batches of a run that has ended, with their numbers of rows."""
        if query.isActive and not query.awaitTermination(wait_s):
            raise TimeoutError(f"query {query.id} has not ended")
        reports = query.recentProgress
        if len(reports) >= MOST_REPORTS:
            raise RuntimeError(f"query {query.id} has {len(reports)} batches; earlier ones may be forgotten")
        return {r.batchId: r.numInputRows for r in reports if r.numInputRows}


@contextmanager
def batch_log(spark: SparkSession):
    """Keep the reports of all batches of the queries that are started inside."""
    before = spark.conf.get(KEPT_REPORTS)
    spark.conf.set(KEPT_REPORTS, MOST_REPORTS)
    try:
        yield BatchLog()
    finally:
        spark.conf.set(KEPT_REPORTS, before)


@contextmanager
def quick_checkpoints(spark: SparkSession, path: str):
    """Checkpoints under ``path`` cost less, if it is on a local disk, for the queries that are started inside.

    There Spark's own choice starts processes (``chmod`` and several ``readlink``) for each of a batch's four files; this way needs no ``readlink``. Both
    write a file aside and rename it, but this one looks beforehand whether there is one: no two runs may share a checkpoint at the same time.
    """
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    before = spark.conf.get(CHECKPOINT_FILES, None)
    if before is None and folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getScheme() == "file":
        spark.conf.set(CHECKPOINT_FILES, BY_FILE_SYSTEM)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CHECKPOINT_FILES)


BATCH = "batch_id"


def append_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Append every micro-batch under its number; a batch costs its own rows only."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn(BATCH, F.lit(batch_id).cast("long")).write.mode("append").parquet(path)

    return write


def table_sink(table: KeyedTable) -> Callable[[DataFrame, int], None]:
    """Put every micro-batch into a table by key, which can be compacted between runs.

    The batch number is the version: a batch that comes again replaces itself, or
    is left out if a base already holds it.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id > table.upto():
            table.put(batch, batch_id)

    return write


def newest(spark: SparkSession, path: str, key: list[str]) -> DataFrame:
    """The newest row per key of an appended stream; a batch that came twice changes nothing."""
    rows = spark.read.parquet(path)
    return first_per_key(rows, key, [F.desc(BATCH)]).drop(BATCH)


# --- transformations -------------------------------------------------------------

def _parsed(messages: DataFrame) -> DataFrame:
    reading = F.from_json("value", f"{READING_SCHEMA}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    parsed = evaluated_once(messages, {"_r": reading}).select("key", "value", "_r.*")
    return evaluated_once(parsed, {"at": F.try_to_timestamp("timestamp")})


def _readable() -> Column:
    return F.col("value").isNotNull() & F.col("_bad").isNull() & F.col("at").isNotNull()


def readings(messages: DataFrame) -> DataFrame:
    """Messages that are readable and have a readable time, as ``at``."""
    return _parsed(messages).filter(_readable()).select(*READING_FIELDS, "at")


def unreadable(messages: DataFrame) -> DataFrame:
    """The others, as they came."""
    return _parsed(messages).filter(~_readable()).select("key", "value")


def for_tag(rows: DataFrame, student: str | None) -> DataFrame:
    """Readings of one tag; all of them without a tag."""
    return rows if student is None else rows.filter(F.col("student") == student)


def tag_counts(rows: DataFrame, student: str | None) -> DataFrame:
    """Messages shown and skipped under a tag filter."""
    shown = F.lit(True) if student is None else F.coalesce(F.col("student") == student, F.lit(False))
    return rows.agg(
        F.count(F.when(shown, 1)).alias("messages"), F.count(F.when(~shown, 1)).alias("skipped")
    )


def _mean_temperature() -> Column:
    """Added as decimals of nine places, so the mean does not depend on the order of the readings.

    A reading that is no finite number below 10 to the 11th has no such decimal and is left out of the mean.
    """
    exact = F.col("temperature_c").try_cast("decimal(20,9)")
    return F.sum(exact).cast("double") / F.nullif(F.count(exact), F.lit(0))


def running_mean(rows: DataFrame) -> DataFrame:
    """Readings and mean temperature per sensor since the start.

    The state is a sum and a count per sensor, whatever the length of the
    stream, and each task adds up its own part before the shuffle.
    """
    return rows.groupBy("sensor_id").agg(
        F.count("temperature_c").alias("readings"),
        _mean_temperature().alias("avg_temperature"),
    )


def tumbling_mean(rows: DataFrame, window: str = "1 day", watermark: str = "1 hour") -> DataFrame:
    """Mean per sensor and time window.

    A window is given out once the watermark has passed its end and its state
    is dropped; rows that come later than that are not counted.
    """
    return (
        rows.withWatermark("at", watermark)
        .groupBy(F.window("at", window), "sensor_id")
        .agg(
            F.count("temperature_c").alias("readings"),
            _mean_temperature().alias("avg_temperature"),
        )
        .select(
            F.col("window.start").cast("timestamp_ntz").alias("window_start"), "sensor_id", "readings", "avg_temperature"
        )
    )


def alerts(rows: DataFrame, threshold: float) -> DataFrame:
    """Readings above a temperature as messages for a second topic."""
    hot = rows.filter(F.col("temperature_c") > threshold)
    return to_messages(
        hot, F.concat_ws("-", "student", "sensor_id"), ["reading_id", "student", "sensor_id", "temperature_c"]
    )


def dedup(rows: DataFrame, key: str = "reading_id", watermark: str = "1 hour") -> DataFrame:
    """Each key once, among copies whose event times lie within the watermark."""
    return rows.withWatermark("at", watermark).dropDuplicatesWithinWatermark([key])
