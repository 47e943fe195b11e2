"""Raw text (bronze) to clean rows (silver) to a valued portfolio (gold)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.latest import first_per_key
from tidemill.functions.money import total
from tidemill.functions.once import evaluated_once
from tidemill.functions.text import (
    NO_CHANGE_MARK,
    NO_PRICE_MARK,
    bare_ticker,
    digits_only,
    is_blank,
    mixed_date,
    money_text,
)
from tidemill.operators.quality import expect_or_drop
from tidemill.session import stored

PROCESSED_AT = "_processed_at"
BRONZE_METADATA = ["_source_file", "_source_sheet", "_ingested_at"]


def _all_but(df: DataFrame, keys: list[str]) -> list[Column]:
    """Every other column as a tie-break, so the row kept does not depend on row order."""
    return [F.col(c) for c in df.columns if c not in keys]


def typed_holdings(bronze: DataFrame) -> DataFrame:
    """Every holding with its types; what cannot be read is null."""
    # the shares are used in conditions and as a column
    read = evaluated_once(bronze, {"_shares": digits_only(F.col("Shares_Held"))})
    return read.select(
        F.when(~is_blank(F.col("Ticker")), bare_ticker(F.col("Ticker"))).alias("Ticker"),
        "Company_Name",
        F.col("_shares").alias("Shares_Held"),
        money_text(F.col("Cost_Basis")).alias("Cost_Basis"),
        "Sector",
        "Account",
    )


def cleaned_holdings(bronze: DataFrame) -> DataFrame:
    """Typed holdings, one row per ticker: the output that the drop rules look at.

    Of several rows one with readable shares stays, if there is any.
    """
    typed = typed_holdings(bronze)
    return first_per_key(typed, ["Ticker"], [F.col("Shares_Held").isNull(), *_all_but(typed, ["Ticker"])])


# The rules and their names.
HOLDING_RULES = {"valid_ticker": "Ticker IS NOT NULL AND Ticker <> 'nan'", "has_shares": "Shares_Held IS NOT NULL"}


def silver_holdings(bronze: DataFrame) -> DataFrame:
    """Cleaned holdings that satisfy every rule: rows without a ticker or readable shares are gone."""
    return expect_or_drop(cleaned_holdings(bronze), HOLDING_RULES)[0]


def silver_prices(bronze: DataFrame) -> DataFrame:
    """Typed prices, one row per symbol and date; rows without a price are gone."""
    raw = bronze.filter(~is_blank(F.col("Symbol")))
    # the price is both a condition and a column
    priced = evaluated_once(raw, {"_close": money_text(F.col("Close"), NO_PRICE_MARK)}).filter("_close IS NOT NULL")
    clean = priced.select(
        F.trim("Symbol").alias("Symbol"),
        mixed_date(F.col("Date")).alias("Date"),
        F.col("_close").alias("Close"),
        digits_only(F.col("Volume")).alias("Volume"),
        money_text(F.col("Change_Pct"), NO_CHANGE_MARK).alias("Change_Pct"),
    )
    return first_per_key(clean, ["Symbol", "Date"], _all_but(clean, ["Symbol", "Date"]))


def with_processed_at(silver: DataFrame) -> DataFrame:
    """When the rows were cleaned; an export leaves the column out again."""
    return silver.withColumn(PROCESSED_AT, F.current_timestamp())


def market_values(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Market value, cost and profit of every position, without its weight."""
    return holdings.join(prices, F.col("Ticker") == F.col("Symbol")).select(
        "Ticker",
        "Company_Name",
        "Sector",
        "Shares_Held",
        "Cost_Basis",
        F.col("Close").alias("Current_Price"),
        F.col("Change_Pct").alias("Daily_Change_Pct"),
        F.col("Date").alias("Price_Date"),
        F.round(F.col("Shares_Held") * F.col("Close"), 2).alias("Market_Value"),
        F.round(F.col("Shares_Held") * F.col("Cost_Basis"), 2).alias("Cost_Value"),
    ).withColumn("Unrealized_PnL", F.round(F.col("Market_Value") - F.col("Cost_Value"), 2))


def gold_portfolio(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """Market value, cost, profit and weight of every position.

    The join is on the ticker alone: a symbol with prices on several dates
    gives one row per date. See ``gold_portfolio_latest`` for one row. The
    joined rows are stored, as their total is needed before their weights.
    """
    positions = stored(market_values(holdings, prices), "positions")
    return positions.withColumn("Weight_Pct", share_of_total(positions, "Market_Value"))


def gold_portfolio_latest(holdings: DataFrame, prices: DataFrame) -> DataFrame:
    """The same with only the newest price of each symbol."""
    newest = first_per_key(prices, ["Symbol"], [F.desc_nulls_last("Date")])
    return gold_portfolio(holdings, newest)


def share_of_total(df: DataFrame, value: str) -> Column:
    """``value`` in percent of its total over ``df``; the total is a scalar subquery."""
    whole = df.agg(total(value).alias("whole")).scalar()
    return F.round(F.col(value) / F.nullif(whole, F.lit(0.0)) * 100, 2)


def gold_sector_allocation(portfolio: DataFrame) -> DataFrame:
    """Value, shares, profit and share of the portfolio per sector."""
    sectors = portfolio.groupBy("Sector").agg(
        total("Market_Value").alias("Sector_Value"),
        F.sum("Shares_Held").alias("Total_Shares"),
        total("Unrealized_PnL").alias("Sector_PnL"),
    )
    return sectors.withColumn("Allocation_Pct", share_of_total(sectors, "Sector_Value")).orderBy(
        F.desc("Sector_Value")
    )


def top_gainers(portfolio: DataFrame) -> DataFrame:
    return portfolio.filter(F.col("Unrealized_PnL") > 0).orderBy(F.desc("Unrealized_PnL"), "Ticker")


def layer_funnel(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer, in the order given."""
    out = None
    for place, (name, rows) in enumerate(layers.items(), start=1):
        counted = rows.agg(F.count("*").alias("rows")).select(
            F.lit(place).cast("long").alias("layer_no"), F.lit(name).alias("layer"), "rows"
        )
        out = counted if out is None else out.unionByName(counted)
    return out.orderBy("layer_no")
