from __future__ import annotations

from datetime import datetime
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import quality, scoring
from tidemill.plans.datasets import Project, merge_rows
from tidemill.session import shared_folder, work_path


def test_each_dataset_is_built_once_in_order(spark):
    p, order = Project(spark), []
    p.source("raw", spark.range(10))

    @p.dataset("table")
    def top(p):
        out = p.ref("left").join(p.ref("right"), "id")
        order.append("top")
        return out

    @p.dataset("view")
    def left(p):
        order.append("left")
        return p.ref("raw").filter("id > 2")

    @p.dataset("ephemeral")
    def right(p):
        order.append("right")
        return p.ref("left").filter("id < 6")

    built = p.run()
    assert order == ["left", "right", "top"]
    assert rows(built["top"]) == [(3,), (4,), (5,)]
    assert spark.table("left").count() == 7
    assert not spark.catalog.tableExists("right")
    assert rows(p.lineage()) == [("left", "raw"), ("right", "left"), ("top", "left"), ("top", "right")]


def test_cycles_and_unknown_names(spark):
    p = Project(spark)

    @p.dataset()
    def a(p):
        return p.ref("b")

    @p.dataset()
    def b(p):
        return p.ref("a")

    with pytest.raises(ValueError, match="cycle: a -> b -> a"):
        p.run("a")
    with pytest.raises(KeyError, match="nothing"):
        p.ref("nothing")
    with pytest.raises(ValueError, match="kind"):
        p.dataset("cube")
    with pytest.raises(ValueError, match="cursor"):
        p.dataset("incremental")


def test_incremental_takes_only_new_rows(spark):
    folder = work_path(spark, "inc")

    def run(df):
        p = Project(spark, folder)
        p.source("raw", df)

        @p.dataset("incremental", cursor="id")
        def facts(p):
            return p.ref("raw")

        return p.ref("facts")

    assert run(spark.range(5)).count() == 5
    assert run(spark.range(5)).count() == 5
    assert rows(run(spark.range(3, 9))) == [(i,) for i in range(9)]


def test_incremental_refuses_what_it_would_lose(spark):
    folder = work_path(spark, "inc")

    def run(data):
        p = Project(spark, folder)
        p.source("raw", spark.createDataFrame(data, "id long, v string"))

        @p.dataset("incremental", cursor="id")
        def facts(p):
            return p.ref("raw")

        return p.ref("facts")

    assert run([(1, "a"), (5, "b")]).count() == 2
    with pytest.raises(ValueError, match="arrived late"):
        run([(1, "a"), (3, "late"), (5, "b")])
    with pytest.raises(ValueError, match="without id"):
        run([(None, "x")])
    assert run([(5, "b"), (6, "c")]).count() == 3


def test_incremental_merge_by_key(spark):
    folder = work_path(spark, "merge")

    def run(data):
        p = Project(spark, folder)
        p.source("raw", spark.createDataFrame(data, "id long, at int, v string"))

        @p.dataset("incremental", key=["id"])
        def facts(p):
            return p.ref("raw")

        return rows(p.ref("facts"))

    assert run([(1, 5, "a"), (2, None, "b")]) == [(1, 5, "a"), (2, None, "b")]
    # a change, an old cursor, a null cursor, a row as it was, and one twice
    merged = run([(1, 5, "changed"), (3, 1, "late"), (4, None, "null"), (2, None, "b"), (3, 1, "later")])
    assert merged == [(1, 5, "changed"), (2, None, "b"), (3, 1, "late"), (4, None, "null")]
    assert run([(1, 5, "changed"), (2, None, None)]) == [(1, 5, "changed"), (2, None, None), (3, 1, "late"), (4, None, "null")]
    stored = spark.read.parquet(f"{folder}/facts").groupBy("_run").count()
    assert rows(stored) == [(0, 2), (1, 3), (2, 1)]  # rows that did not change are not written again


def test_quality_tests(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "d"), (2, None)], "k int, v string")
    assert rows(quality.unique(df, ["k"])) == [(1, 2)]
    assert quality.not_null(df, "k").count() == 2
    assert rows(quality.accepted_values(df, "v", ["a", "b"])) == [("c", 1), ("d", 1)]
    parent = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.relationships(df, "k", parent, "id")) == [(2, 1)]
    # an unknown outcome counts as a violation
    assert rows(quality.expect(df, {"small": F.col("k") < 2})) == [("small", 5, 2, 3)]


def test_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 6),)], "ts timestamp_ntz")
    for hour, status in ((12, "pass"), (19, "warn"), (23, "error")):
        row = quality.freshness(df, "ts", datetime(2024, 1, 1, hour), 8, 16).first()
        assert (row.age_hours, row.status) == (hour - 6.0, status)


def test_scores_agree(spark, tables):
    from tidemill.plans.derived import scoring_input

    both = scoring.score_builtin(scoring_input(tables)).withColumnRenamed("p_buy", "b")
    both = both.withColumn("v", scoring.probability_in_batches("age", "income_k"))
    assert both.filter(F.abs(F.col("b") - F.col("v")) > 1e-12).count() == 0
    for n in (1, 3):
        assert scoring.score_by_partitions(scoring_input(tables), n).first().partitions_used == n


def test_work_lies_in_the_shared_folder(spark):
    assert work_path(spark, "x").startswith(shared_folder(spark).rstrip("/"))
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named


# --- side by side ------------------------------------------------------------------

def test_side_by_side_builds_in_order_of_need(spark):
    p = Project(spark)
    p.source("raw", spark.range(10))

    @p.dataset("table")
    def top(p):
        return p.ref("left").join(p.ref("right"), "id")

    @p.dataset("table")
    def left(p):
        return p.ref("raw").filter("id > 2")

    @p.dataset("ephemeral")
    def right(p):
        return p.ref("left").filter("id < 6")

    out = p.run_side_by_side("top", threads=2)
    assert {n: o.state for n, o in out.items()} == {"top": "built", "left": "built", "right": "built"}
    assert rows(out["top"].rows) == [(3,), (4,), (5,)]
    assert rows(p.lineage()) == [("left", "raw"), ("right", "left"), ("top", "left"), ("top", "right")]
    assert p.run()["top"] is out["top"].rows  # what is built stays built


def test_side_by_side_runs_at_the_same_time(spark):
    """Two datasets that wait for each other's start both end."""
    p, both = Project(spark), Barrier(2, timeout=60)

    @p.dataset("view")
    def one(p):
        both.wait()
        return spark.range(1)

    @p.dataset("view")
    def two(p):
        both.wait()
        return spark.range(2)

    assert {o.state for o in p.run_side_by_side().values()} == {"built"}


def test_a_failure_stops_only_what_needs_it(spark):
    p = Project(spark)

    @p.dataset("table")
    def fine(p):
        return spark.range(3)

    @p.dataset("table")
    def broken(p):
        return p.ref("fine").select(F.raise_error(F.lit("no good")).alias("x"))

    @p.dataset("table")
    def reader(p):
        return p.ref("broken")

    @p.dataset("table")
    def reader_of_reader(p):
        return p.ref("fine").join(p.ref("reader"))

    @p.dataset("view")
    def beside(p):
        return p.ref("fine").filter("id > 0")

    out = p.run_side_by_side(threads=3)
    assert {n: (o.state, o.reason if o.state == "skipped" else None) for n, o in out.items()} == {
        "fine": ("built", None), "beside": ("built", None), "broken": ("failed", None), "reader": ("skipped", "broken"), "reader_of_reader": ("skipped", "reader"),
    }
    assert "no good" in out["broken"].reason and out["beside"].rows.count() == 2


def test_side_by_side_cycles_and_unknown_names(spark):
    p = Project(spark)

    @p.dataset()
    def a(p):
        return p.ref("b")

    @p.dataset()
    def b(p):
        return p.ref("a")

    @p.dataset()
    def c(p):
        return p.ref("nothing")

    with pytest.raises(ValueError, match="cycle among a, b"):
        p.run_side_by_side("a")
    with pytest.raises(KeyError, match="nothing"):
        p.run_side_by_side("nothing")
    assert p.run_side_by_side("c")["c"].state == "failed"


def test_merge_by_key_appends_what_changed(spark):
    """Late, changed and null-valued rows are added; equal ones are not; null keys are keys."""
    path = work_path(spark, "merge")
    schema = "k int, v double, s string"
    first = spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (None, 3.0, None)], schema)
    merge_rows(first, path, ["k"])
    out = merge_rows(spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (None, 3.0, "x"), (4, None, None)], schema), path, ["k"])
    assert rows(out) == rows(spark.createDataFrame([(1, 1.0, "a"), (2, 2.0, "b"), (None, 3.0, "x"), (4, None, None)], schema))
    stored = spark.read.parquet(path)
    assert rows(stored.filter("_run = 1").drop("_run")) == rows(spark.createDataFrame([(2, 2.0, "b"), (None, 3.0, "x"), (4, None, None)], schema))
    assert rows(merge_rows(first, path, ["k"])) == rows(spark.createDataFrame([(1, 1.0, "a"), (2, None, "b"), (None, 3.0, None), (4, None, None)], schema))
