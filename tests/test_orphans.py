from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import quality
from tidemill.plans.registry import JOBS

KEYS = [0, 1, 2, 7, 8, 9, 32_766, 32_767, 32_768, 32_769, 65_536, -1, -2, -32_768, -32_769, 5_000_000_000, 2**62, -(2**62), None]


@pytest.mark.parametrize("most_bytes", [64 << 20, 0])
def test_as_anti_join(spark, most_bytes):
    parent = spark.createDataFrame([(k,) for k in KEYS[::2] * 2], "p long")
    child = spark.createDataFrame([(k, i) for i, k in enumerate(KEYS * 3 + [3, 32_770])], "c long, i int")
    got = rows(quality.orphans_by_bitmap(child, "c", parent, "p", most_bytes))
    assert got == rows(quality.relationships(child, "c", parent, "p")) and len(got) > 8


def test_every_bit(spark):
    parent = spark.range(-40_000, 40_000).filter("id % 3 = 0")
    child = spark.range(-50_000, 50_000)
    got = quality.orphans_by_bitmap(child, "id", parent, "id")
    assert got.count() == child.join(parent, "id", "left_anti").count() and got.filter("value % 3 = 0 AND abs(value) < 39999").isEmpty()


def test_no_parents_no_children(spark):
    some = spark.range(3)
    assert rows(quality.orphans_by_bitmap(some, "id", some.limit(0), "id")) == [(0, 1), (1, 1), (2, 1)]
    assert quality.orphans_by_bitmap(some.limit(0), "id", some, "id").count() == 0


def test_only_orphans_are_shuffled(spark, tables):
    plan = JOBS["dq_orphans"](spark, tables.folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan


def test_bitmaps_follow_the_keys(spark):
    assert quality.key_bitmaps(spark.range(32_768 * 3), "id").count() <= 4
    assert quality.key_bitmaps(spark.range(0, 10**9, 10**8), "id").count() == 10
    assert quality.key_bitmaps(spark.range(0, 5).select(F.lit(None).cast("long").alias("id")), "id").count() == 0
