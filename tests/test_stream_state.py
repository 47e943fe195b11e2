"""Interrupted runs, gaps per key, batches by a listener."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.plans import derived, registry
from tidemill.plans.registry import JOBS
from tidemill.session import work_path
from tidemill.streaming import gaps, sensors


@pytest.fixture
def path(spark):
    return work_path(spark, "stream-state")


def numbers_in(spark, path, pieces):
    """One file per list of numbers."""
    for piece in pieces:
        spark.createDataFrame([(n,) for n in piece], "n long").coalesce(1).write.mode("append").parquet(f"{path}/in")
    return spark.readStream.schema("n long").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")


@pytest.mark.parametrize("written", [False, True])
def test_an_interrupted_run_is_taken_up(spark, path, written):
    came = numbers_in(spark, path, [[1, 2], [3], [4, 5], [6]])
    append = sensors.append_sink(f"{path}/state")
    sensors.run_interrupted(came, f"{path}/cp", "append", sensors.interrupt_after(append, 2, written))
    assert rows(spark.read.parquet(f"{path}/state").select("n")) == [(n,) for n in range(1, 6 if written else 4)]
    sensors.run_batches(came, f"{path}/cp", "append", append)
    state = spark.read.parquet(f"{path}/state")
    assert rows(state.select("n").distinct()) == [(n,) for n in range(1, 7)]
    assert state.count() == (8 if written else 6)  # the batch that was written, but not noted, came again


def test_running_state_survives_the_interruption(spark, path):
    total = numbers_in(spark, path, [[1, 2], [3], [4], [5]]).groupBy((F.col("n") % 2).alias("odd")).agg(F.sum("n").alias("s"))
    append = sensors.append_sink(f"{path}/state")
    sensors.run_interrupted(total, f"{path}/cp", "update", sensors.interrupt_after(append, 2, written=True))
    sensors.run_batches(total, f"{path}/cp", "update", append)
    assert rows(sensors.newest(spark, f"{path}/state", ["odd"])) == [(0, 6), (1, 9)]


def test_other_failures_are_raised(spark, path):
    def broken(batch, batch_id):
        raise KeyError("no such thing")

    with pytest.raises(Exception, match="no such thing"):
        sensors.run_interrupted(numbers_in(spark, path, [[1]]), f"{path}/cp", "append", broken)


def test_an_interruption_beyond_the_end(spark, path):
    came = numbers_in(spark, path, [[1], [2]])
    sensors.run_interrupted(came, f"{path}/cp", "append", sensors.interrupt_after(sensors.append_sink(f"{path}/state"), 9))
    assert rows(spark.read.parquet(f"{path}/state").select("n")) == [(1,), (2,)]


def test_batch_log(spark, path):
    with sensors.batch_log(spark) as log:
        one = log.of(sensors.run_to_files(numbers_in(spark, path, [[1, 2, 3], [4]]), f"{path}/out", f"{path}/cp"))
        again = log.of(sensors.run_to_files(numbers_in(spark, path, [[5, 6]]), f"{path}/out", f"{path}/cp"))
    assert one == {0: 3, 1: 1}
    assert again == {2: 2}  # the same query, its next run


@pytest.mark.parametrize("messages", [0, 10, 45])
def test_batches_of_queries_side_by_side(spark, path, messages, monkeypatch):
    """Files of ten are dealt to queries that run at the same time; no listener is called for every batch."""
    events = spark.range(101 * messages).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id")
    events.write.parquet(f"{path}/events.parquet")
    started, start = [], sensors.start_to_files

    def counted(*args):
        started.append(start(*args))
        return started[-1]

    monkeypatch.setattr(sensors, "start_to_files", counted)
    got = rows(JOBS["stream_batches"](spark, path))
    files = -(-messages // 10)
    assert got == [(messages, files, min(10, messages) or None, messages // 10)] and len(started) == files
    assert not any(q.isActive for q in started)


def test_long_streams_are_dealt_to_more_queries(spark, path, monkeypatch):
    """A query takes a bounded number of files, so its logs stay short; as many run at once as before."""
    events = spark.range(101 * 45).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id")
    events.write.parquet(f"{path}/events.parquet")
    monkeypatch.setattr(registry, "STREAM_LANES", 2)
    monkeypatch.setattr(registry, "LANE_FILES", 2, raising=False)
    started, active, chosen, start = [], [], [], sensors.start_to_files

    def counted(*args):
        active.append(sum(q.isActive for q in started))
        chosen.append(spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", ""))
        started.append(start(*args))
        return started[-1]

    monkeypatch.setattr(sensors, "start_to_files", counted)
    assert rows(JOBS["stream_batches"](spark, path)) == [(45, 5, 10, 4)]
    assert sorted(len([p for p in q.recentProgress if p.numInputRows]) for q in started) == [1, 2, 2]
    assert max(active) < 2 and all("FileSystemBased" in c for c in chosen)
    assert not spark.conf.get("spark.sql.streaming.checkpointFileManagerClass", "")


def test_events_of_batches_are_parsed_once(spark, path, monkeypatch):
    events = spark.range(101 * 12).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' AS ts", "id % 7 AS user_id")
    events.write.parquet(f"{path}/events.parquet")
    seen, unreadable = spark.sparkContext.accumulator(0), sensors.unreadable

    @F.udf("string")
    def told(value):
        seen.add(1)
        return value

    monkeypatch.setattr(sensors, "unreadable", lambda messages: unreadable(messages.withColumn("value", told("value"))))
    assert rows(JOBS["stream_batches"](spark, path)) == [(12, 2, 10, 1)]
    assert seen.value == 101 * 12


def test_quick_checkpoints(spark, path):
    """A run that was interrupted under one way is taken up under the other; a way chosen by the user stays."""
    came = numbers_in(spark, path, [[1, 2], [3], [4, 5]])
    append = sensors.append_sink(f"{path}/state")
    with sensors.quick_checkpoints(spark, path):
        sensors.run_interrupted(came, f"{path}/cp", "append", sensors.interrupt_after(append, 1))
    sensors.run_batches(came, f"{path}/cp", "append", append)
    assert rows(spark.read.parquet(f"{path}/state").select("n")) == [(n,) for n in range(1, 6)]
    own = "org.apache.spark.sql.execution.streaming.checkpointing.FileContextBasedCheckpointFileManager"
    spark.conf.set(sensors.CHECKPOINT_FILES, own)
    try:
        with sensors.quick_checkpoints(spark, path):
            assert spark.conf.get(sensors.CHECKPOINT_FILES) == own
        assert spark.conf.get(sensors.CHECKPOINT_FILES) == own
    finally:
        spark.conf.unset(sensors.CHECKPOINT_FILES)


def test_a_failure_stops_the_queries_beside_it():
    """Those that run are stopped, those that wait are not started."""
    class Query:
        isActive = True

        def __init__(self, fails):
            self.fails = fails

        def awaitTermination(self):
            if self.fails:
                raise KeyError("broken")
            self.isActive = False

        def stop(self):
            self.isActive = False

    queries, taken = [Query(i == 1) for i in range(5)], []
    with pytest.raises(KeyError):
        list(sensors.ended((taken.append(q) or q for q in queries), 2))
    assert taken == queries[:3] and not any(q.isActive for q in taken)


def test_batch_log_is_whole_and_cheap(spark, path):
    """More batches than a query keeps reports of by itself."""
    spark.range(120).coalesce(1).write.option("maxRecordsPerFile", 1).parquet(f"{path}/in")
    came = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
    kept = spark.conf.get(sensors.KEPT_REPORTS)
    with sensors.batch_log(spark) as log:
        done = log.of(sensors.run_to_files(came, f"{path}/out", f"{path}/cp"))
    assert done == dict.fromkeys(range(120), 1) and spark.conf.get(sensors.KEPT_REPORTS) == kept


def test_readings_with_many_decimals(spark):
    values = [21.37, 21.372, -0.001, 20.0, None, float("nan"), 1e300]
    got = sensors.running_mean(spark.createDataFrame([("a", v) for v in values], "sensor_id string, temperature_c double")).first()
    assert got.readings == 6 and got.avg_temperature == 62.741 / 4


def test_mean_of_two_decimals_in_any_order(spark, tables):
    good = sensors.readings(derived.sensor_messages(tables.events))
    assert good.filter(F.col("temperature_c") * 10 != F.rint(F.col("temperature_c") * 10)).count() > 100
    assert rows(sensors.running_mean(good)) == rows(sensors.running_mean(good.repartition(13, "reading_id")))


# --- gaps --------------------------------------------------------------------


def plain_gaps(batches):
    """Highest, missing numbers, late and copies of one key, from all numbers seen before."""
    seen, late, copies = set(), 0, 0
    for batch in batches:
        for n in sorted(batch):
            copies += n in seen
            late += n not in seen and n < max(seen, default=0)
            seen.add(n)
    return max(seen), sorted(set(range(1, max(seen))) - seen), late, copies


@pytest.mark.parametrize("seed", range(20))
def test_take(seed):
    rng = random.Random(seed)
    batches = [[rng.randrange(1, 40) for _ in range(rng.randrange(1, 12))] for _ in range(4)]
    highest, open_gaps, late, copies = 0, [], 0, 0
    for batch in batches:
        for n in sorted(batch):
            highest, open_gaps, what = gaps.take(n, highest, open_gaps)
            late, copies = late + (what == "late"), copies + (what == "copy")
    missing = [n for a, b in open_gaps for n in range(a, b + 1)]
    assert (highest, missing, late, copies) == plain_gaps(batches)
    assert open_gaps == sorted(open_gaps) and all(a <= b for a, b in open_gaps)


def put(spark, path, messages):
    frame = spark.createDataFrame([(k, n, datetime(2024, 1, day)) for k, n, day in messages], "key string, number long, at timestamp")
    frame.coalesce(1).write.mode("append").parquet(f"{path}/in")


def run(spark, path, **options):
    with gaps.keyed_state(spark):
        came = spark.readStream.schema("key string, number long, at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{path}/in")
        sensors.run_batches(gaps.gaps(came, **options), f"{path}/cp", "update", sensors.append_sink(f"{path}/state"))
    state = sensors.newest(spark, f"{path}/state", ["key"]).collect()
    return {r.key: (r.highest, [tuple(g) for g in r.gaps], r.late, r.copies, r.closed) for r in state}


def test_gaps_late_numbers_and_timers(spark, path):
    put(spark, path, [("a", 1, 1), ("a", 5, 1), ("b", 2, 1)])
    put(spark, path, [("a", 3, 1), ("a", 3, 1), ("b", 1, 1)])
    assert run(spark, path) == {"a": (5, [(2, 2), (4, 4)], 1, 1, False), "b": (2, [], 1, 0, False)}
    put(spark, path, [("c", 1, 9)])
    put(spark, path, [("c", 2, 9)])
    got = run(spark, path, idle=timedelta(days=1))
    assert got == {"a": (5, [(2, 2), (4, 4)], 1, 1, True), "b": (2, [], 1, 0, True), "c": (2, [], 0, 0, False)}
    put(spark, path, [("a", 2, 10)])  # the key was forgotten: it begins anew
    assert run(spark, path)["a"] == (2, [(1, 1)], 0, 0, False)


def test_the_order_of_rows_does_not_matter(spark, tables):
    sent = derived.numbered_messages(tables)
    want = JOBS["stream_gaps"](spark, tables.folder)
    lost = sent.filter("part = 0").groupBy("key").agg(F.count("*").alias("n"))
    joined = want.join(lost, "key", "left").filter(F.col("missing") > F.coalesce("n", F.lit(0)))
    assert want.count() > 10 and joined.isEmpty()
