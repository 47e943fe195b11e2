from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.plans import derived
from tidemill.session import work_path
from tidemill.streaming import sensors


@pytest.fixture
def path(spark):
    return work_path(spark, "stream-test")


def put(spark, path, *readings):
    """Readings (id, sensor, temperature, time) or raw text, as one message file."""
    out = []
    for r in readings:
        if isinstance(r, str):
            out.append(("k", r))
            continue
        i, sensor, temp, at = r
        body = {"reading_id": i, "student": f"s{i % 2}", "sensor_id": sensor, "temperature_c": temp, "humidity_pct": 40.0,
                "timestamp": f"2024-01-{at}Z"}
        out.append((f"s{i % 2}-{sensor}", json.dumps(body)))
    spark.createDataFrame(out, "key string, value string").coalesce(1).write.mode("append").parquet(f"{path}/in")


def test_every_message_is_read_or_set_aside(spark, tables):
    messages = derived.sensor_messages(tables.events, replays=True)
    good, bad = sensors.readings(messages).count(), sensors.unreadable(messages).count()
    assert bad > 0 and good + bad == messages.count()


def test_a_reading_without_a_time_is_set_aside(spark, path):
    put(spark, path, (1, "a", 20.0, "01T00:00:00"), (2, "a", 21.0, "99T00:00:00"), "{broken")
    messages = spark.read.parquet(f"{path}/in")
    assert rows(sensors.readings(messages).select("reading_id")) == [(1,)]
    assert sensors.unreadable(messages).count() == 2


def test_a_batch_that_comes_twice_changes_nothing(spark, path):
    write = sensors.append_sink(f"{path}/state")
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    for batch, number in ((first, 0), (first.withColumn("n", F.lit(2)), 1), (first.withColumn("n", F.lit(2)), 1), (first.limit(0), 2)):
        write(batch, number)
    assert rows(sensors.newest(spark, f"{path}/state", ["k"])) == [("a", 2), ("b", 2)]


def test_a_key_keeps_its_order(spark):
    """Messages of one key stay in one partition, in the order they came."""
    df = spark.range(1000).select(F.col("id"), (F.col("id") % 7).cast("string").alias("k")).coalesce(1)
    sent = sensors.to_messages(df, F.col("k"), ["id"]).repartition(4, "key").withColumn("p", F.spark_partition_id()).collect()
    seen = {}
    for r in sent:
        seen.setdefault(r.key, []).append((r.p, json.loads(r.value)["id"]))
    assert all(len({p for p, _ in v}) == 1 and [i for _, i in v] == sorted(i for _, i in v) for v in seen.values())


def test_restart_goes_on_from_the_checkpoint(spark, path):
    def run():
        rows_in = sensors.readings(sensors.folder_source(spark, f"{path}/in", files_per_trigger=1))
        sensors.run_batches(sensors.running_mean(rows_in), f"{path}/cp", "update", sensors.append_sink(f"{path}/state"))
        return rows(sensors.newest(spark, f"{path}/state", ["sensor_id"]))

    put(spark, path, (1, "a", 20.0, "01T00:00:00"), (2, "b", 30.0, "01T00:00:01"), "{broken")
    assert run() == [("a", 1, 20.0), ("b", 1, 30.0)]
    assert run() == [("a", 1, 20.0), ("b", 1, 30.0)]
    put(spark, path, (3, "a", 22.0, "01T00:00:02"))
    put(spark, path, (4, "c", 25.0, "01T00:00:03"), (5, "a", 24.0, "01T00:00:04"))
    assert run() == [("a", 3, 22.0), ("b", 1, 30.0), ("c", 1, 25.0)]


def test_files_sink_writes_once(spark, path):
    put(spark, path, (1, "a", 34.5, "01T00:00:00"), (2, "b", 30.0, "01T00:00:01"))
    for _ in range(2):
        hot = sensors.alerts(sensors.readings(sensors.folder_source(spark, f"{path}/in")), 33.0)
        sensors.run_to_files(hot, f"{path}/out", f"{path}/cp")
    got = spark.read.parquet(f"{path}/out").collect()
    assert len(got) == 1 and got[0].key == "s1-a" and json.loads(got[0].value)["temperature_c"] == 34.5


def test_late_rows_are_left_out(spark, path):
    def run():
        rows_in = sensors.readings(sensors.folder_source(spark, f"{path}/in", files_per_trigger=1))
        sensors.run_to_files(sensors.tumbling_mean(rows_in, "1 day", "1 hour"), f"{path}/out", f"{path}/cp")
        return rows(spark.read.parquet(f"{path}/out").select(F.dayofmonth("window_start"), "sensor_id", "readings"))

    put(spark, path, (1, "a", 20.0, "01T10:00:00"), (2, "a", 22.0, "01T11:00:00"))
    put(spark, path, (3, "a", 20.0, "02T10:00:00"))
    assert run() == [(1, "a", 2)]
    put(spark, path, (4, "a", 20.0, "01T12:00:00"), (5, "a", 20.0, "03T10:00:00"))
    assert run() == [(1, "a", 2), (2, "a", 1)]


def test_windows_equal_a_batch_over_the_closed_days(spark, tables):
    batch = sensors.readings(derived.sensor_messages(tables.events))
    stop = batch.agg(F.max("at") - F.expr("interval 1 hour")).first()[0]
    want = sensors.tumbling_mean(batch).filter(F.col("window_start") + F.expr("interval 1 day") <= F.lit(stop).cast("timestamp_ntz"))
    path = work_path(spark, "stream-test")
    stream = sensors.tumbling_mean(sensors.readings(derived.sensor_messages(tables.stream("events"))))
    sensors.run_to_files(stream, f"{path}/out", f"{path}/cp")
    assert rows(spark.read.parquet(f"{path}/out")) == rows(want)


def test_copies_are_taken_once(spark, path):
    put(spark, path, (1, "a", 20.0, "01T10:00:00"), (1, "a", 20.0, "01T10:00:00"))
    put(spark, path, (1, "a", 20.0, "01T10:00:00"), (2, "a", 21.0, "01T10:01:00"))
    once = sensors.dedup(sensors.readings(sensors.folder_source(spark, f"{path}/in", files_per_trigger=1)))
    sensors.run_to_files(once, f"{path}/out", f"{path}/cp")
    assert rows(spark.read.parquet(f"{path}/out").select("reading_id")) == [(1,), (2,)]


def test_tag_filter(spark, tables):
    all_rows = sensors.readings(derived.sensor_messages(tables.events))
    one = sensors.for_tag(all_rows, "s1").count()
    counts = sensors.tag_counts(all_rows, "s1").first()
    assert counts.messages == one and counts.messages + counts.skipped == all_rows.count()
    assert sensors.tag_counts(all_rows, None).first().skipped == 0
    assert sensors.for_tag(all_rows, None).count() == all_rows.count()


def test_kafka_source_needs_its_package(spark):
    with pytest.raises(Exception, match="kafka|Kafka"):
        sensors.topic_source(spark, "localhost:1", "readings")
    rate = spark.readStream.format("rate").load().selectExpr("'k' AS key", "'v' AS value")
    with pytest.raises(Exception, match="kafka|Kafka"):
        sensors.start_to_topic(rate, "localhost:1", "alerts", work_path(spark, "cp"))
