"""The portfolio layers on a small report with every known defect."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import quality
from tidemill.plans import medallion
from tidemill.session import work_path
from tidemill.sources.files import capture_raw, export_csv

# A report with every kind of defect; the expected figures were worked out by hand.
HOLDINGS = [
    ("QFX", "Quay Foods", "310", "$45.20", "Food", "CORE"),
    ("XETR:LMN", "Lumen Grid", "90", "$210.05", "Energy", "CORE"),
    ("ZED", "Zedra Labs", "1200", "12.34", "Health", "CORE"),
    ("  PIK", "Pika Rail", "75", "$1,040.00", "Transport", "SIDE"),
    ("TOVA  ", "Tova Media", "640", "$33.33", "Media", "SIDE"),
    ("NYSE:BRK", "Brook Water", "200", "88.01", "Energy", "CORE"),
    ("ONI", "Oni Steel", "'415", "7.75", "Metal", "SIDE"),
    (None, None, None, None, None, None),
    ("QFX", "Quay Foods", "310", "$45.20", "Food", "CORE"),
    ("ZED", "Zedra Labs", "1300", "12.34", "Health", "SIDE"),
    ("LOST", "No Shares", "n/a", "1.00", "Food", "CORE"),
    ("GONE", "Null Shares", None, "1.00", "Food", "CORE"),
]
PRICES = [
    ("QFX", "2024-06-03", "47.10", "1500200", "0.4"),
    ("LMN", "06/03/2024", "$199.95", "3200000000", "-1.1"),
    ("ZED", "2024-06-03", "11.90", "910000", "-2.0"),
    ("PIK", "06/03/2024", "$1,101.50", "40100", "3.2"),
    ("TOVA", "2024-06-03", "35.00", "77000", "0.0"),
    ("BRK", "2024-06-03", "$90.25", "655000", "1.5"),
    ("ONI", "06/03/2024", "8.05", "1200000", "0.9"),
    ("ONI", "2024-06-03", "8.05", "1300000", "0.9"),
    ("QFX", "2024-06-03", "47.10", "1500200", "0.4"),
    ("NIL", "2024-06-03", "N/A", "0", "-"),
]
POSITIONS = [
    ("BRK", 18050.0, 17602.0, 448.0, 10.42),
    ("LMN", 17995.5, 18904.5, -909.0, 10.39),
    ("ONI", 3340.75, 3216.25, 124.5, 1.93),
    ("PIK", 82612.5, 78000.0, 4612.5, 47.68),
    ("QFX", 14601.0, 14012.0, 589.0, 8.43),
    ("TOVA", 22400.0, 21331.2, 1068.8, 12.93),
    ("ZED", 14280.0, 14808.0, -528.0, 8.24),
]
SECTORS = [
    ("Energy", 36045.5, 290, -461.0, 20.8),
    ("Food", 14601.0, 310, 589.0, 8.43),
    ("Health", 14280.0, 1200, -528.0, 8.24),
    ("Media", 22400.0, 640, 1068.8, 12.93),
    ("Metal", 3340.75, 415, 124.5, 1.93),
    ("Transport", 82612.5, 75, 4612.5, 47.68),
]


@pytest.fixture(scope="module")
def bronze(spark):
    h = spark.createDataFrame(HOLDINGS, "Ticker string, `Company Name` string, `Shares Held` string, `Cost Basis` string, Sector string, Account string")
    p = spark.createDataFrame(PRICES, "Symbol string, Date string, Close string, Volume string, `Change Pct` string")
    return capture_raw(h, "report", "Holdings"), capture_raw(p, "report", "Prices")


@pytest.fixture(scope="module")
def silver(bronze):
    return medallion.silver_holdings(bronze[0]), medallion.silver_prices(bronze[1])


def test_bronze_is_text_with_metadata(bronze):
    kinds = dict(bronze[0].dtypes)
    assert kinds.pop("_ingested_at") == "timestamp"
    assert set(kinds.values()) == {"string"}
    assert "Company_Name" in kinds and "_source_sheet" in kinds


def test_silver_counts(silver):
    assert silver[0].count() == 7 and silver[1].count() == 7


def test_first_of_differing_copies(silver):
    """Of copies that differ the first in column order stays, whatever the row order."""
    assert silver[0].filter("Ticker = 'ZED'").first().Shares_Held == 1200
    assert silver[1].filter("Symbol = 'ONI'").first().Volume == 1200000


def test_numbers_beyond_32_bits(silver):
    assert silver[1].filter("Symbol = 'LMN'").first().Volume == 3200000000


def test_rows_without_readable_shares_are_dropped_after_the_cast(bronze, silver):
    typed = medallion.typed_holdings(bronze[0])
    assert {r.Ticker for r in typed.filter("Shares_Held IS NULL AND Ticker IS NOT NULL").collect()} == {"LOST", "GONE"}
    assert silver[0].filter("Ticker IN ('LOST', 'GONE')").count() == 0


def test_positions(silver):
    out = medallion.gold_portfolio(*silver)
    assert rows(out.select("Ticker", "Market_Value", "Cost_Value", "Unrealized_PnL", "Weight_Pct")) == POSITIONS
    assert out.agg(F.sum("Market_Value")).first()[0] == 173279.75


def test_sectors(silver):
    assert rows(medallion.gold_sector_allocation(medallion.gold_portfolio(*silver))) == SECTORS


def test_row_order_does_not_matter(bronze):
    mixed = bronze[0].repartition(7).orderBy(F.rand(3))
    assert rows(medallion.silver_holdings(mixed)) == rows(medallion.silver_holdings(bronze[0]))


def test_cleaning_twice_changes_nothing(silver):
    again = medallion.silver_holdings(silver[0].select([F.col(c).cast("string") for c in silver[0].columns]))
    assert rows(again) == rows(silver[0])


def test_latest_price_only(silver):
    holdings, prices = silver
    old = prices.withColumns({"Date": F.date_sub("Date", 1), "Close": F.lit(1.0)})
    both = prices.unionByName(old)
    assert medallion.gold_portfolio(holdings, both).count() == 14
    latest = medallion.gold_portfolio_latest(holdings, both)
    assert rows(latest.select("Ticker", "Market_Value")) == [p[:2] for p in POSITIONS]


def test_blank_marks_are_dropped(spark, bronze):
    marked = bronze[0].withColumn("Ticker", F.when(F.col("Ticker") == "ONI", "nan").otherwise(F.col("Ticker")))
    assert medallion.silver_holdings(marked).count() == 6


def test_expectations(spark, silver, bronze):
    rules = {"valid_ticker": "Ticker IS NOT NULL", "has_shares": "Shares_Held IS NOT NULL", "big": "Shares_Held > 150"}
    kept, report = quality.expect_or_drop(medallion.cleaned_holdings(bronze[0]), rules)
    assert kept.count() == 5
    assert rows(report.select("rule", "rows", "failed")) == [("big", 10, 5), ("has_shares", 10, 3), ("valid_ticker", 10, 1)]
    with pytest.raises(quality.ExpectationFailed, match="valid_ticker: 1 of 12"):
        quality.expect_or_fail(bronze[0], {"valid_ticker": "Ticker IS NOT NULL"})
    assert quality.expect_or_fail(silver[0], {"valid_ticker": "Ticker IS NOT NULL"}).count() == 7


def test_processed_at_is_left_out_of_exports(spark, silver):
    stamped = medallion.with_processed_at(silver[0])
    assert dict(stamped.dtypes)["_processed_at"] == "timestamp"
    path = export_csv(stamped, work_path(spark, "export"), "holdings", ["_processed_at"], files=1)
    assert spark.read.csv(path, header=True).columns == silver[0].columns


def test_weights_add_up(silver):
    portfolio = medallion.gold_portfolio(*silver)
    assert quality.total_off_target(portfolio, "Weight_Pct", 100, 0.5).count() == 0
    off = portfolio.withColumn("Weight_Pct", F.col("Weight_Pct") * 2)
    assert quality.total_off_target(off, "Weight_Pct", 100, 0.5).count() == 1
    with pytest.raises(quality.ExpectationFailed):
        quality.singular(quality.total_off_target(off, "Weight_Pct", 100, 0.5))
