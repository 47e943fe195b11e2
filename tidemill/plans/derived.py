"""Inputs that the tables do not hold directly, derived from whole tables.

All recipes are integer arithmetic on a key, so they are repeatable in any
engine and grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.ordered import numbered
from tidemill.tables import Tables

# Names that the derived rows carry.
DEPARTMENTS = ["Engineering", "Marketing", "Sales", "Operations", "Finance"]
CONTENT_BY_EVENT = {
    "click": "sports",
    "view": "finance",
    "purchase": "entertainment",
    "signup": "lifestyle",
}
BID_CATEGORIES = [
    "sportswear", "energy_drink", "fintech", "insurance", "streaming",
    "gaming", "beauty", "travel", "fast_food", "auto",
]


def _text(c: Column) -> Column:
    return c.cast("string")


def _cents_text(cents: Column, comma: Column) -> Column:
    """123456 as ``1234.56``, or ``1,234.56`` where ``comma`` holds."""
    whole = F.floor(cents / 100)
    grouped = F.concat(_text(F.floor(whole / 1000)), F.lit(","), F.lpad(_text(whole % 1000), 3, "0"))
    head = F.when(comma & (whole >= 1000), grouped).otherwise(_text(whole))
    return F.concat(head, F.lit("."), F.lpad(_text(cents % 100), 2, "0"))


def dirty_holdings(t: Tables) -> DataFrame:
    """Holdings text as a report gives it, one row per part with the usual defects."""
    k = F.col("p_partkey")
    blank_row = k % 50 == 0
    ticker = F.when(k % 53 == 0, F.lit("nan")).otherwise(
        F.concat(
            F.when(k % 5 == 0, F.lit("NYSE:")).otherwise(F.lit("")),
            F.lit("TK"), _text(k),
            F.when(k % 7 == 0, F.lit("  ")).otherwise(F.lit("")),
        )
    )
    # a second copy of a row has fewer shares
    held = F.when(F.col("_copy") == 2, 50 + k % 900).otherwise(100 + k % 900)
    shares = F.when(k % 61 == 0, F.lit("unknown")).otherwise(F.concat(F.when(k % 11 == 0, F.lit("'")).otherwise(F.lit("")), _text(held)))
    cost = F.concat(
        F.when(k % 3 == 0, F.lit("$")).otherwise(F.lit("")),
        _cents_text(1000 + (k * 7919) % 200000, k % 2 == 0),
    )
    columns = {
        "Ticker": ticker,
        "Company Name": F.col("p_name"),
        "Shares Held": shares,
        "Cost Basis": cost,
        "Sector": F.col("p_type"),
        "Account": F.when(k % 4 == 0, F.lit("ALT")).otherwise(F.lit("MAIN")),
    }
    copies = F.when(k % 20 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.part.withColumn("_copy", F.explode(copies)).select(
        *[F.when(~blank_row, c).alias(name) for name, c in columns.items()]
    )


def dirty_prices(t: Tables) -> DataFrame:
    """Vendor-style price text, one row per part."""
    k = F.col("p_partkey")
    close = F.when(k % 25 == 0, F.lit("N/A")).otherwise(
        F.concat(
            F.when(k % 3 == 0, F.lit("$")).otherwise(F.lit("")),
            _cents_text(1000 + (k * 104729) % 200000, k % 2 == 0),
        )
    )
    change = F.when(k % 13 == 0, F.lit("-")).otherwise(
        F.concat(
            F.when(k % 2 == 0, F.lit("-")).otherwise(F.lit("")),
            _text(k % 5), F.lit("."), _text(k % 10),
        )
    )
    copies = F.when(k % 30 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return t.part.withColumn("_copy", F.explode(copies)).select(
        F.concat(F.lit("TK"), _text(k), F.when(k % 9 == 0, F.lit(" ")).otherwise(F.lit(""))).alias("Symbol"),
        F.when(k % 2 == 0, F.lit("2024-03-15")).otherwise(F.lit("03/15/2024")).alias("Date"),
        close.alias("Close"),
        _text(1000000 + (k * 1009) % 50000000 - F.when(F.col("_copy") == 2, 7).otherwise(0)).alias("Volume"),
        change.alias("Change Pct"),
    )


def price_history(prices: DataFrame) -> DataFrame:
    """Clean prices of two days: the given one, and the day before at half the price."""
    earlier = prices.withColumns(
        {"Date": F.date_sub("Date", 1), "Close": F.round(F.col("Close") / 2, 2)}
    )
    return prices.unionByName(earlier)


def employees(t: Tables) -> DataFrame:
    """A staff table, one row per customer."""
    k = F.col("c_custkey")
    names = F.array(*[F.lit(d) for d in DEPARTMENTS])
    return t.customer.select(
        k.alias("id"),
        F.element_at(names, (k % 5 + 1).cast("int")).alias("department"),
        ((4000000 + (k * 7919) % 8000000) / 100).alias("salary"),
        F.date_add(F.lit("2015-01-01").cast("date"), ((k * 31) % 3650).cast("int")).alias("hire_date"),
        F.when(k % 10 >= 3, F.lit("Active")).otherwise(F.lit("Inactive")).alias("status"),
    )


def opportunity_messages(events: DataFrame) -> DataFrame:
    """One ad opportunity per event as JSON text; every 97th is not JSON. Batch or stream."""
    k = F.col("event_id")
    content = F.lit("other")
    for event, name in CONTENT_BY_EVENT.items():
        content = F.when(F.col("event_type") == event, name).otherwise(content)
    categories = F.array(*[F.lit(c) for c in BID_CATEGORIES])

    def bid(i: Column) -> Column:
        cents = 100 + (k * 37 + i * 101) % 900
        return F.struct(
            F.concat(F.lit("adv_"), F.lpad(_text((k * 7 + i * 11) % 20), 2, "0")).alias("advertiser_id"),
            F.when((k + i) % 19 != 0, cents / 100).alias("bid_amount"),
            F.element_at(categories, (1 + (k * 7 + i * 3) % 10).cast("int")).alias("category"),
        )

    bids = F.when(k % 4 > 0, F.transform(F.sequence(F.lit(0).cast("long"), k % 4 - 1), bid)).otherwise(
        F.array().cast("array<struct<advertiser_id:string,bid_amount:double,category:string>>")
    )
    message = F.to_json(
        F.struct(
            F.concat(F.lit("opp-"), _text(k)).alias("opportunity_id"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
            F.concat(F.lit("u_"), _text(F.col("user_id"))).alias("user_id"),
            content.alias("content_category"),
            F.when(F.floor(k / 4) % 2 == 0, F.lit("mobile")).otherwise(F.lit("desktop")).alias("device_type"),
            F.concat(F.lit("region-"), _text(F.col("user_id") % 4)).alias("region"),
            bids.alias("bids"),
        )
    )
    body = F.concat(F.when(k % 97 == 0, F.lit("not json ")).otherwise(F.lit("")), message)
    return events.select(F.concat(F.lit("msg-"), _text(k)).alias("message_id"), body.alias("body"))


def interactions(t: Tables) -> DataFrame:
    """User, item and kind of every event; the item sits in a JSON field."""
    item = F.get_json_object("props", "$.k").cast("long")
    return t.events.select("event_id", "user_id", item.alias("item_id"), "event_type")


def sensor_messages(events: DataFrame, replays: bool = False) -> DataFrame:
    """Keyed JSON readings, one per event; every 101st is broken.

    Works on a batch or a streaming ``events``. With ``replays`` every 40th
    message comes twice.
    """
    k = F.col("event_id")
    student = F.concat(F.lit("s"), _text(F.col("user_id") % 3))
    sensor = F.concat(F.lit("sensor-0"), _text(1 + F.col("user_id") % 6))
    reading = F.to_json(
        F.struct(
            k.alias("reading_id"),
            student.alias("student"),
            sensor.alias("sensor_id"),
            ((1800 + k % 1711) / 100).alias("temperature_c"),
            ((300 + k % 601) / 10).alias("humidity_pct"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        )
    )
    value = F.concat(F.when(k % 101 == 0, F.lit("broken ")).otherwise(F.lit("")), reading)
    out = events
    if replays:
        out = out.withColumn(
            "_copy", F.explode(F.when(k % 40 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        )
    return out.select(F.concat_ws("-", student, sensor).alias("key"), value.alias("value"))


def numbered_messages(t: Tables) -> DataFrame:
    """Every event as a message of its user, numbered from 1, and the ``part`` it is sent in.

    Every 50th is lost (part 0), some come in a second part only (2), and every
    40th is sent again in a third (3).
    """
    k = F.col("event_id")
    placed = numbered(t.events.select("user_id", "event_id", "ts"), "user_id", "event_id")
    begins = placed.groupBy("user_id").agg(F.min("position").alias("begin"))
    first = F.when(k % 50 == 7, 0).when(k % 10 == 3, 2).otherwise(1)
    parts = F.when(k % 40 == 0, F.array(first, F.lit(3))).otherwise(F.array(first))
    return placed.join(begins, "user_id").select(
        F.concat(F.lit("u_"), _text(F.col("user_id"))).alias("key"),
        (F.col("position") - F.col("begin") + 1).alias("number"),
        F.col("ts").cast("timestamp").alias("at"),
        F.explode(parts).alias("part"),
    )


def scoring_input(t: Tables) -> DataFrame:
    """Age and income per customer."""
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey",
        (18 + k % 47).cast("int").alias("age"),
        (20 + k % 131).cast("double").alias("income_k"),
    )
