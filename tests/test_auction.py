"""The auction on hand-made opportunities."""

import json

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import auction

# The sample opportunity.
SAMPLE = {
    "opportunity_id": "test-001",
    "timestamp": "2025-03-10T20:15:00Z",
    "user_id": "u_12345",
    "content_category": "sports",
    "device_type": "mobile",
    "region": "southeast",
    "bids": [
        {"advertiser_id": "adv_001", "bid_amount": 3.50, "category": "sportswear"},
        {"advertiser_id": "adv_002", "bid_amount": 4.20, "category": "fast_food"},
        {"advertiser_id": "adv_003", "bid_amount": 2.85, "category": "sportswear"},
    ],
}


def opportunities(spark, *items):
    texts = [(f"msg-{i}", x if isinstance(x, str) or x is None else json.dumps(x)) for i, x in enumerate(items)]
    return auction.parse_opportunities(spark.createDataFrame(texts, "message_id string, body string"))


def scores(spark, **change):
    good, _ = opportunities(spark, {**SAMPLE, **change})
    return {r.advertiser_id: r.score for r in auction.score_bids(good).collect()}


def test_scores(spark):
    got = scores(spark)
    assert got["adv_001"] == pytest.approx(6.7375)
    assert got["adv_002"] == pytest.approx(5.775)


def test_outside_the_windows(spark):
    assert scores(spark, timestamp="2025-03-10T15:00:00Z")["adv_001"] == pytest.approx(5.39)


def test_desktop(spark):
    assert scores(spark, device_type="desktop")["adv_001"] == pytest.approx(6.125)


@pytest.mark.parametrize("text", ["soon", "", None, "2025-13-45T20:00:00Z"])
def test_time_that_cannot_be_read(spark, text):
    assert scores(spark, timestamp=text)["adv_001"] == pytest.approx(5.39)


@pytest.mark.parametrize("hour, bonus", [(5, 1.0), (6, 1.2), (8, 1.2), (9, 1.0), (12, 1.15), (14, 1.0), (19, 1.25), (22, 1.25), (23, 1.0)])
def test_window_ends(spark, hour, bonus):
    assert scores(spark, timestamp=f"2025-03-10T{hour:02d}:59:59Z")["adv_002"] == pytest.approx(4.2 * bonus * 1.1)


def test_unknown_device(spark):
    assert scores(spark, device_type="tv")["adv_002"] == pytest.approx(5.25)


def test_winner_and_margin(spark):
    good, _ = opportunities(spark, SAMPLE)
    won = auction.pick_winners(good).first()
    assert won.winning_advertiser_id == "adv_001"
    assert won.winning_score == pytest.approx(6.7375)
    assert won.score_margin == pytest.approx(0.9625)


def test_no_valid_bid_gives_no_result(spark):
    bad = [
        {"advertiser_id": "a", "category": "auto"},
        {"advertiser_id": "b", "bid_amount": 0, "category": "auto"},
        {"advertiser_id": "c", "bid_amount": -1.0, "category": "auto"},
    ]
    good, failed = opportunities(spark, {**SAMPLE, "bids": []}, {**SAMPLE, "bids": bad}, {**SAMPLE, "bids": None})
    assert good.count() == 3 and failed.count() == 0
    assert auction.pick_winners(good).count() == 0


def test_ties_and_single_bids(spark):
    tie = [{"advertiser_id": a, "bid_amount": 2.0, "category": "auto"} for a in ("z", "b", "m")]
    good, _ = opportunities(spark, {**SAMPLE, "bids": tie}, {**SAMPLE, "opportunity_id": "one", "bids": tie[:1]})
    won = {r.opportunity_id: r for r in auction.pick_winners(good).collect()}
    assert won["test-001"].winning_advertiser_id == "b" and won["test-001"].score_margin == 0
    assert won["one"].score_margin == won["one"].winning_score


def test_bad_messages_do_not_stop_the_batch(spark):
    good, failed = opportunities(spark, SAMPLE, "{oops", None, {"content_category": "sports"}, {**SAMPLE, "opportunity_id": "test-002"})
    assert [r.opportunity_id for r in good.orderBy("message_id").collect()] == ["test-001", "test-002"]
    assert rows(failed.select("message_id", "reason")) == [
        ("msg-1", "not a readable message"), ("msg-2", "empty message"), ("msg-3", "no opportunity_id"),
    ]
    out = auction.processed(auction.pick_winners(good))
    assert out.count() == 2
    assert out.columns == ["opportunity_id", "content_category", "winning_advertiser_id", "winning_bid_amount",
                           "winning_score", "score_margin", "processed_at"]
    assert out.filter(F.try_to_timestamp("processed_at").isNull()).count() == 0
