from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import auction, interval_join
from tidemill.operators.interval_join import newest_window
from tidemill.operators.interval_join import interval_join as joined
from tidemill.plans.registry import JOBS


def brute(points, windows):
    return sorted((p, at, w, a, b) for p, at in points for w, a, b in windows if at is not None and (a is None or at >= a) and (b is None or at < b))


@pytest.mark.parametrize("seed", range(6))
def test_as_all_pairs(spark, seed):
    rng = random.Random(seed)
    far = rng.choice([20, 1000, 1 << 50])
    points = [(i, rng.choice([None, rng.randrange(-far, far), rng.randrange(-far, far), 0])) for i in range(60)]
    windows = [(i, rng.choice([None, rng.randrange(-far, far)]), rng.choice([None, rng.randrange(-far, far)])) for i in range(25)] + [(99, 5, 5), (98, 0, 1), (97, 3, -3)]
    p, w = spark.createDataFrame(points, "p int, at long"), spark.createDataFrame(windows, "w int, first long, after long")
    got = rows(joined(p, w, "at").select("p", "at", "w", "first", "after"))
    assert got == sorted(brute(points, windows), key=repr)


@pytest.mark.parametrize("share", [1, 2, 1000])
def test_hot_bins(spark, monkeypatch, share):
    """However many bins count as hot, the rows are the same."""
    monkeypatch.setattr(interval_join, "HOT_SHARE", share)
    points = [(i, 100 if i % 3 == 0 else i) for i in range(300)]
    windows = [(i, i * 7, i * 9 + 1) for i in range(40)]
    p, w = spark.createDataFrame(points, "p int, at long"), spark.createDataFrame(windows, "w int, first long, after long")
    assert rows(joined(p, w, "at").select("p", "at", "w", "first", "after")) == sorted(brute(points, windows), key=repr)


def test_with_keys(spark):
    p = spark.createDataFrame([("a", 1, 5), ("b", 2, 5), (None, 3, 5)], "k string, p int, at long")
    w = spark.createDataFrame([("a", 1, 0, 9), ("b", 2, 6, 9), ("b", 3, None, None)], "k string, w int, first long, after long")
    assert rows(joined(p, w, "at", keys=["k"]).select("p", "w")) == [(1, 1), (2, 3)]


def test_the_window_that_begins_last_counts(spark):
    p = spark.createDataFrame([(1, 10), (2, 30), (3, 99), (4, None), (5, -5)], "p int, at long")
    windows = [(None, 0, 1.0), (None, None, 2.0), (5, 40, 3.0), (8, 20, 4.0), (8, None, 5.0), (8, 20, 6.0)]
    w = spark.createDataFrame(windows, "first long, after long, value double")
    assert rows(newest_window(p, w, ["p"], "at", ["value"])) == [(1, 4.0), (2, 5.0), (3, 5.0), (5, 1.0)]


def test_without_windows_or_points(spark):
    p = spark.createDataFrame([(1, 10)], "p int, at long")
    w = spark.createDataFrame([(1, 0, 20)], "w int, first long, after long")
    assert joined(p, w.limit(0), "at").count() == 0 and joined(p, w.limit(0), "at").columns == joined(p, w, "at").columns
    assert joined(p.limit(0), w, "at").count() == 0


def test_no_nested_loop(spark, tables):
    plan = JOBS["auction_windows"](spark, tables.folder)._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_same_scores_from_tables(spark, tables):
    """With the hours of the day as windows, tables score as the fixed values do."""
    from tidemill.plans import derived

    good, _ = auction.parse_opportunities(derived.opportunity_messages(tables.events))
    days = tables.events.select(F.to_date("ts").alias("day")).distinct()
    columns = ["opportunity_id", "advertiser_id", "bid_amount", "relevance", "time_bonus", "device_bonus", "score"]
    from_tables = auction.score_from_tables(good, *auction.lookup_tables(spark), auction.daily_windows(days))
    assert rows(from_tables.select(*columns)) == rows(auction.score_bids(good).select(*columns))
