"""Quality-adjusted ad auction over messages that carry an array of bids.

An opportunity and its bids are one row, so scoring and picking the winner
are array expressions on that row: no explode, no shuffle, and no hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.once import evaluated_once
from tidemill.operators.interval_join import newest_window

# The scoring tables. A pair or device that is not listed counts 1.0.
RELEVANCE = {
    ("sports", "sportswear"): 1.4,
    ("sports", "energy_drink"): 1.3,
    ("finance", "fintech"): 1.5,
    ("finance", "insurance"): 1.3,
    ("entertainment", "streaming"): 1.4,
    ("entertainment", "gaming"): 1.3,
    ("lifestyle", "beauty"): 1.3,
    ("lifestyle", "travel"): 1.2,
}
# first hour, hour after the last, bonus
TIME_BONUS = [(6, 9, 1.20), (12, 14, 1.15), (19, 23, 1.25)]
DEVICE_BONUS = {"mobile": 1.1, "desktop": 1.0}

MESSAGE_SCHEMA = (
    "opportunity_id string, timestamp string, user_id string, content_category string, device_type string,"
    " region string, bids array<struct<advertiser_id: string, bid_amount: double, category: string>>"
)
_FIELDS = ["opportunity_id", "timestamp", "user_id", "content_category", "device_type", "region", "bids"]


def parse_opportunities(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good opportunities, and the messages to retry with the reason they failed.

    Every message lands in exactly one of the two.
    """
    body = F.from_json("body", f"{MESSAGE_SCHEMA}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    parsed = evaluated_once(messages, {"_o": body}).select("message_id", "body", "_o.*")
    reason = (
        F.when(F.col("body").isNull(), "empty message")
        .when(F.col("_bad").isNotNull(), "not a readable message")
        .when(F.col("opportunity_id").isNull(), "no opportunity_id")
    )
    marked = parsed.withColumn("reason", reason)
    good = marked.filter(F.col("reason").isNull()).select("message_id", *_FIELDS)
    return good, marked.filter(F.col("reason").isNotNull()).select("message_id", "reason", "body")


def relevance(content: Column, category: Column) -> Column:
    table = F.create_map(*[x for (a, b), m in RELEVANCE.items() for x in (F.lit(f"{a}/{b}"), F.lit(m))])
    return F.coalesce(F.try_element_at(table, F.concat_ws("/", content, category)), F.lit(1.0))


def message_hour(timestamp: Column) -> Column:
    """The hour as written in the message; null if the text is not a time."""
    return F.when(
        F.try_to_timestamp(timestamp).isNotNull(), F.regexp_extract(timestamp, r"[T ](\d{2}):", 1).try_cast("int")
    )


def time_bonus(hour: Column) -> Column:
    """The bonus of the window that holds the hour, 1.0 outside all of them and for null."""
    bonus = F.lit(1.0)
    for first, after, value in TIME_BONUS:
        bonus = F.when((hour >= first) & (hour < after), F.lit(value)).otherwise(bonus)
    return bonus


def device_bonus(device: Column) -> Column:
    bonus = F.lit(1.0)
    for name, value in DEVICE_BONUS.items():
        bonus = F.when(device == name, F.lit(value)).otherwise(bonus)
    return bonus


def _valid(bid: Column) -> Column:
    return bid["bid_amount"] > 0


def with_scores(opportunities: DataFrame) -> DataFrame:
    """Opportunities with a valid bid, and ``scored``: those bids with their score.

    A bid is valid if it has a positive amount.
    """
    timed = evaluated_once(opportunities.filter(F.exists("bids", _valid)), {"_hour": message_hour(F.col("timestamp"))})
    base = evaluated_once(
        timed, {"time_bonus": time_bonus(F.col("_hour")), "device_bonus": device_bonus(F.col("device_type"))}
    )

    def score(bid: Column) -> Column:
        fit = relevance(F.col("content_category"), bid["category"])
        return F.struct(
            bid["advertiser_id"].alias("advertiser_id"),
            bid["bid_amount"].alias("bid_amount"),
            fit.alias("relevance"),
            (bid["bid_amount"] * fit * F.col("time_bonus") * F.col("device_bonus")).alias("score"),
        )

    return evaluated_once(base, {"scored": F.transform(F.filter("bids", _valid), score)})


def score_bids(opportunities: DataFrame) -> DataFrame:
    """One row per valid bid with its factors and score."""
    return (
        with_scores(opportunities)
        .select("opportunity_id", "time_bonus", "device_bonus", F.inline("scored"))
        .select("opportunity_id", "advertiser_id", "bid_amount", "relevance", "time_bonus", "device_bonus", "score")
    )


def lookup_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The fixed values as tables: relevance by content and category, bonus by device."""
    fit = spark.createDataFrame([(a, b, m) for (a, b), m in RELEVANCE.items()], "content_category string, category string, relevance double")
    devices = spark.createDataFrame(list(DEVICE_BONUS.items()), "device_type string, device_bonus double")
    return fit, devices


def daily_windows(days: DataFrame) -> DataFrame:
    """The bonuses by hour on every ``day``, as windows from ``first`` to ``after`` in microseconds."""
    hours = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.lit(x).alias("time_bonus")) for a, b, x in TIME_BONUS])
    start = F.col("day").cast("timestamp")
    moment = lambda h: F.unix_micros(start + F.make_dt_interval(hours=F.col(h)))
    return days.select("day", F.inline(hours)).select(moment("a").alias("first"), moment("b").alias("after"), "time_bonus")


def score_from_tables(opportunities: DataFrame, relevance: DataFrame, devices: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per valid bid with its factors and score, all factors from tables; 1.0 where a table has no row.

    Of windows that hold a message's time the one that begins last counts.
    """
    valid = opportunities.filter(F.exists("bids", _valid))
    timed = evaluated_once(valid, {"_at": F.unix_micros(F.try_to_timestamp("timestamp"))})
    bonus = newest_window(timed, windows, ["message_id"], "_at", ["time_bonus"])
    bids = timed.withColumn("_bid", F.explode(F.filter("bids", _valid))).select("message_id", "opportunity_id", "content_category", "device_type", "_bid.*")
    known = bids.join(bonus, "message_id", "left").join(devices, "device_type", "left").join(relevance, ["content_category", "category"], "left")
    factors = {c: F.coalesce(c, F.lit(1.0)) for c in ("relevance", "time_bonus", "device_bonus")}
    score = F.col("bid_amount") * F.col("relevance") * F.col("time_bonus") * F.col("device_bonus")
    return known.withColumns(factors).select("opportunity_id", "advertiser_id", "bid_amount", *factors, score.alias("score"))


def pick_winners(opportunities: DataFrame) -> DataFrame:
    """The result record of every opportunity with a valid bid.

    Highest score wins, equal scores by advertiser name. The margin is the
    distance to second place, or the whole score of a lone bid.
    """
    # negated score first, so the natural order of structs is best bid first
    ranked = F.sort_array(
        F.transform("scored", lambda b: F.struct((-b["score"]).alias("minus"), b["advertiser_id"], b["bid_amount"]))
    )
    best = evaluated_once(with_scores(opportunities), {"_r": ranked})
    first, second = F.col("_r")[0], F.get(F.col("_r"), F.lit(1))
    return best.select(
        "opportunity_id",
        "content_category",
        first["advertiser_id"].alias("winning_advertiser_id"),
        first["bid_amount"].alias("winning_bid_amount"),
        (-first["minus"]).alias("winning_score"),
        (-first["minus"] - F.coalesce(-second["minus"], F.lit(0.0))).alias("score_margin"),
        F.col("timestamp"),
    )


def processed(winners: DataFrame, at: Column | None = None) -> DataFrame:
    """Result records with the time of processing in place of the message time."""
    at = F.current_timestamp() if at is None else at
    return winners.select(
        *[c for c in winners.columns if c != "timestamp"],
        F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("processed_at"),
    )


def win_counts(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Auctions won per advertiser, overall or within other columns."""
    return results.groupBy(*(by or []), "winning_advertiser_id").agg(F.count("*").alias("wins"))


def latency(results: DataFrame, started: str, finished: str, by: str) -> DataFrame:
    """Seconds from message to result, and results per second, per group."""

    def millis(c: str) -> Column:
        return F.unix_millis(F.try_to_timestamp(F.col(c)))

    timed = evaluated_once(results.select(by, started, finished), {"_from": millis(started), "_to": millis(finished)})
    taken = F.col("_to") - F.col("_from")
    span = (F.max("_to") - F.min("_from")) / 1000
    return timed.groupBy(by).agg(
        F.count("*").alias("results"),
        F.round(F.avg(taken) / 1000, 6).alias("avg_latency_s"),
        F.round(F.max(taken) / 1000, 3).alias("max_latency_s"),
        F.round(F.count("*") / F.nullif(span, F.lit(0.0)), 9).alias("results_per_s"),
    )
