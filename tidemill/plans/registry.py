"""Every job by name: ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemill.functions import sketch
from tidemill.functions.latest import first_per_key
from tidemill.functions.money import mean, total
from tidemill.functions.ordered import numbered
from tidemill.functions.text import (
    MONEY_SIGNS,
    US_DATE,
    digits_only,
    iso_from_us_date,
    mixed_date,
    money_text,
    safe_name,
)
from tidemill.operators import auction, observed, quality, recommend, scoring
from tidemill.plans import customer, derived, medallion, relational
from tidemill.plans.datasets import Project
from tidemill.session import prepare, stored, work_path
from tidemill.sources import colocated, evolving, files, keyed, managed, reports, versions
from tidemill.streaming import gaps, sensors
from tidemill.tables import Tables

Job = Callable[[SparkSession, str], DataFrame]
JOBS: dict[str, Job] = {}


def job(build: Callable[[Tables], DataFrame], name: str | None = None) -> None:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        prepare(spark)
        return build(Tables(spark, folder))

    run.__name__ = name or build.__name__
    run.__doc__ = build.__doc__
    JOBS[run.__name__] = run


# --- star schema ---------------------------------------------------------------

for build in (
    relational.building_customers,
    relational.staging_orders,
    relational.sample_orders,
    relational.distinct_segments,
    relational.segment_balance,
    relational.segment_profile,
    relational.order_value_by_status,
    relational.order_status_stats,
    relational.pricing_summary,
    relational.orders_by_year,
    relational.monthly_orders,
    relational.monthly_orders_by_status,
    relational.order_date_range,
    relational.priority_avg_filter,
    relational.table_counts,
    relational.null_audit,
    relational.top_orders,
    relational.top_spenders,
    relational.supplier_nations,
    relational.top_supplier_nations,
    relational.nation_region_balance,
    relational.revenue_by_part_type,
    relational.segment_status_view,
    relational.above_average_customers,
    relational.top_by_segment,
    relational.priority_rank_by_year,
    relational.cumulative_revenue,
    relational.lead_daily_revenue,
    relational.moving_avg_7d,
    relational.yearly_trends,
):
    job(build)

job(derived.employees, "generated_employees")
for build in (relational.department_profile, relational.hires_by_year, relational.top_paid_by_department):
    job(lambda t, build=build: build(derived.employees(t)), build.__name__)


def above_department_average(t: Tables) -> DataFrame:
    staff = derived.employees(t).filter(F.col("status") == "Active")
    average = relational.group_average(staff, "department", "salary")
    return relational.above_group_average(staff, "department", "salary", average)


def above_segment_average(t: Tables) -> DataFrame:
    balances = t.customer.select(F.col("c_mktsegment").alias("segment"), "c_acctbal")
    average = relational.group_average(balances, "segment", "c_acctbal")
    return relational.above_group_average(balances, "segment", "c_acctbal", average)


job(lambda t: relational.sample_orders(t, 1000), "sample_orders_small")
job(above_department_average)
job(above_segment_average)


# --- files and tables ------------------------------------------------------------

def ctas_segment_year(t: Tables) -> DataFrame:
    """The summary written as a named table and read back by name."""
    path = work_path(t.spark, "segment_summary")
    return managed.create_or_replace(relational.segment_year_summary(t), "segment_summary", path=path)


def employees_partitioned(t: Tables) -> DataFrame:
    """A table split by department; the report opens one department only."""
    path = work_path(t.spark, "employees")
    table = managed.create_or_replace(derived.employees(t), "employees_by_department", ["department"], path)
    return (
        table.filter(F.col("department") == "Engineering")
        .groupBy("department")
        .agg(F.count("*").alias("headcount"), mean("salary").alias("avg_salary"))
    )


job(ctas_segment_year)
job(employees_partitioned)


def csv_roundtrip(t: Tables) -> DataFrame:
    """Orders through CSV with inferred types."""
    rows = files.roundtrip(relational.working_orders(t), "csv", "orders")
    return rows.withColumn("order_date", F.col("order_date").cast("timestamp_ntz"))


def parquet_roundtrip(t: Tables) -> DataFrame:
    """Orders through parquet, two of nine columns read."""
    return files.roundtrip(relational.working_orders(t), "parquet", "orders").select("customer_name", "total_price")


def format_counts(t: Tables) -> DataFrame:
    return files.format_counts(relational.working_orders(t), ["csv", "json", "orc", "parquet"], "orders")


# The date range of the month-partitioned report.
RANGE_START, RANGE_END = date(1996, 3, 15), date(1997, 6, 30)


def month_partition_scan(t: Tables) -> DataFrame:
    """Orders stored by month, read by date."""
    path = work_path(t.spark, "orders_by_month")
    files.write_by_month(t.orders, path, "o_orderdate")
    return (
        files.read_month_range(t.spark, path, "o_orderdate", RANGE_START, RANGE_END)
        .groupBy("o_orderdate")
        .agg(F.count("*").alias("orders"), total("o_totalprice").alias("revenue"))
    )


def decimal_export(t: Tables) -> DataFrame:
    """Prices kept as decimals, handed to a reader that calculates in doubles."""
    exact = t.orders.select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), "o_orderstatus")
    return files.decimals_as_doubles(exact)


TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_inventory(t: Tables) -> DataFrame:
    """Every table with its rows."""
    counts = [getattr(t, n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n in TABLES]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


def file_inventory(t: Tables) -> DataFrame:
    return files.file_inventory(t.spark, t.folder)


def events_json_fields(t: Tables) -> DataFrame:
    return derived.interactions(t)


for build in (csv_roundtrip, parquet_roundtrip, format_counts, month_partition_scan, file_inventory, table_inventory, decimal_export, events_json_fields):
    job(build)


# --- versioned tables --------------------------------------------------------------

ORDER_KEY = ["order_id"]
LOADED, UPDATED = datetime(2024, 1, 1, tzinfo=timezone.utc), datetime(2024, 1, 3, tzinfo=timezone.utc)


def _updated_orders(t: Tables) -> str:
    """Orders as version 0; version 1 marks the urgent ones critical."""
    path = work_path(t.spark, "orders_versions")
    versions.append(relational.working_orders(t), path, 0, at=LOADED)
    urgent = F.col("priority") == "1-URGENT"
    versions.update_where(t.spark, path, ORDER_KEY, urgent, {"priority": F.lit("CRITICAL")}, at=UPDATED)
    return path


def snapshot_history(t: Tables) -> DataFrame:
    return versions.history(t.spark, _updated_orders(t)).withColumn("committed_at", F.col("committed_at").cast("timestamp_ntz"))


def snapshot_as_of(t: Tables) -> DataFrame:
    return versions.as_of(t.spark, _updated_orders(t), ORDER_KEY, version=0)


def snapshot_as_of_time(t: Tables) -> DataFrame:
    """The orders as they stood between the load and the update."""
    return versions.as_of(t.spark, _updated_orders(t), ORDER_KEY, at=datetime(2024, 1, 2, tzinfo=timezone.utc))


def snapshot_update(t: Tables) -> DataFrame:
    return versions.as_of(t.spark, _updated_orders(t), ORDER_KEY)


def snapshot_diff(t: Tables) -> DataFrame:
    return versions.diff_counts(t.spark, _updated_orders(t), ORDER_KEY, 0, 1, "priority")


def append_enforced(t: Tables) -> DataFrame:
    """Orders plus a rejected append of the same rows with a text key."""
    path = work_path(t.spark, "orders_enforced")
    good = relational.staging_orders(t)
    managed.append_enforced(good, path, good.schema)
    try:
        managed.append_enforced(good.withColumn("order_id", F.col("order_id").cast("string")), path, good.schema)
        outcome = "written"
    except managed.SchemaMismatch as err:
        outcome = str(err)
    return t.spark.read.parquet(path).agg(F.count("*").alias("rows")).withColumn("outcome", F.lit(outcome))


for build in (snapshot_history, snapshot_as_of, snapshot_as_of_time, snapshot_update, snapshot_diff, append_enforced):
    job(build)


# --- customer reports ----------------------------------------------------------------

job(customer.customer_360)
job(customer.partitioned_copy)
job(lambda t: customer.segment_report(customer.customer_360(t)), "segment_report")
job(lambda t: customer.top_customers_by_region(customer.customer_360(t)), "top_customers_by_region")
job(lambda t: customer.customer_360_checks(customer.customer_360(t)), "customer_360_checks")


# --- bronze, silver, gold ----------------------------------------------------------------

def _bronze_holdings(t: Tables) -> DataFrame:
    return files.capture_raw(derived.dirty_holdings(t), "holdings_report", "Holdings")


def _bronze_prices(t: Tables) -> DataFrame:
    return files.capture_raw(derived.dirty_prices(t), "holdings_report", "Prices")


def bronze_capture(t: Tables) -> DataFrame:
    """Both parts of the report, side by side as text."""
    holdings, prices = _bronze_holdings(t), _bronze_prices(t)
    return holdings.unionByName(prices, allowMissingColumns=True).drop("_ingested_at")


def title_block_rows(t: Tables) -> DataFrame:
    """Holdings written as report files with a title block, and read back below it."""
    path = work_path(t.spark, "holdings_report")
    rows = derived.dirty_holdings(t)
    reports.write_report(rows, path, ["Holdings report", "Holdings", "", "All figures in USD"])
    return reports.read_report(t.spark, path, [safe_name(c) for c in rows.columns])


def _silver(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Both silver tables, written once: gold reads each of them more than once."""
    return (
        stored(medallion.silver_holdings(_bronze_holdings(t)), "silver_holdings"),
        stored(medallion.silver_prices(_bronze_prices(t)), "silver_prices"),
    )


def _portfolio(t: Tables) -> DataFrame:
    return medallion.gold_portfolio(*_silver(t))


def gold_portfolio_latest(t: Tables) -> DataFrame:
    """Two days of prices, of which the newer one values the position."""
    holdings, prices = _silver(t)
    return medallion.gold_portfolio_latest(holdings, derived.price_history(prices))


def layer_funnel(t: Tables) -> DataFrame:
    holdings, prices = _silver(t)
    portfolio = medallion.gold_portfolio(holdings, prices)
    return medallion.layer_funnel(
        {
            "Bronze: Holdings": _bronze_holdings(t),
            "Bronze: Prices": _bronze_prices(t),
            "Silver: Holdings": holdings,
            "Silver: Prices": prices,
            "Gold: Portfolio": portfolio,
            "Gold: Sectors": medallion.gold_sector_allocation(portfolio),
        }
    )


job(bronze_capture)
job(title_block_rows)
job(lambda t: medallion.silver_holdings(_bronze_holdings(t)), "silver_holdings")
job(lambda t: medallion.silver_prices(_bronze_prices(t)), "silver_prices")
job(_portfolio, "gold_portfolio")
job(gold_portfolio_latest)
job(lambda t: medallion.gold_sector_allocation(_portfolio(t)), "gold_sector_allocation")
job(lambda t: medallion.top_gainers(_portfolio(t)), "top_gainers")
job(layer_funnel)


# --- tables that change --------------------------------------------------------------------------

def _order_state(t: Tables, name: str) -> tuple[keyed.KeyedTable, DataFrame]:
    """Orders by key in three versions: all, urgent ones changed, pending ones taken away."""
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    table = keyed.KeyedTable(t.spark, work_path(t.spark, name), ("o_orderkey",), rows.schema)
    table.put(rows, 0)
    table.put(rows.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderpriority", F.lit("CRITICAL")), 1)
    table.remove(rows.filter("o_orderstatus = 'P'"), 2)
    return table, rows


def keyed_delete(t: Tables) -> DataFrame:
    """Rows of three versions of a table whose rows change and go."""
    table, _ = _order_state(t, "orders-by-key")
    states = [table.rows(v).withColumn("version", F.lit(v).cast("long")) for v in range(3)]
    return states[0].unionByName(states[1]).unionByName(states[2])


def keyed_compaction(t: Tables) -> DataFrame:
    """The same table compacted and rid of its history, then changed: some rows come back."""
    table, rows = _order_state(t, "orders-compacted")
    table.compact()
    table.forget()
    table.put(rows.filter("o_orderstatus = 'P' AND o_totalprice > 200000").withColumn("o_orderpriority", F.lit("BACK")), 3)
    return table.rows()


def append_widened(t: Tables) -> DataFrame:
    """Two appends of different shapes as one table, and what was said to a third that doesn't fit."""
    path = work_path(t.spark, "widened")
    old = t.orders.filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").cast("int"), F.col("o_custkey").cast("int"), F.to_date("o_orderdate").alias("o_orderdate"))
    evolving.append(old, path)
    new = t.orders.filter("o_orderkey % 2 = 1").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("timestamp_ntz").alias("o_orderdate"), "o_orderpriority")
    evolving.append(new, path)
    try:
        evolving.append(new.withColumn("o_custkey", F.col("o_custkey").cast("string")), path)
        refused = "nothing"
    except managed.SchemaMismatch as err:
        refused = str(err)
    return evolving.read(t.spark, path).withColumn("refused", F.lit(refused))


def bucketed_join(t: Tables) -> DataFrame:
    """Orders and their lines joined bucket by bucket."""
    buckets = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    orders = colocated.bucketed(t.orders.select("o_orderkey", "o_orderpriority"), "orders", "o_orderkey", buckets)
    lines = colocated.bucketed(t.lineitem.select("l_orderkey", "l_extendedprice"), "lines", "l_orderkey", buckets)
    joined = orders.hint("merge").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("lines"), total("l_extendedprice").alias("revenue"))


def pruned_fact(t: Tables) -> DataFrame:
    """Orders in folders by nation, read where the nations of one region are."""
    fact = t.orders.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")).select("o_totalprice", "c_nationkey")
    asia = t.nation.join(t.region.filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name")
    joined = colocated.foldered(fact, "orders-by-nation", "c_nationkey").join(asia, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("orders"), total("o_totalprice").alias("revenue"))


def segment_median_sketch(t: Tables) -> DataFrame:
    """Median order value per segment from sketches of every year, and whether its rank is within twice the stated error."""
    k = 400
    spent = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select("c_mktsegment", "o_totalprice", F.year("o_orderdate").alias("year"))
    parts = stored(sketch.sketches(spent, ["c_mktsegment", "year"], "o_totalprice", k), "sketches")
    medians = sketch.merged(parts, ["c_mktsegment"]).select("c_mktsegment", sketch.count().alias("orders"), sketch.quantile(0.5).alias("median"))
    below = F.count(F.when(F.col("o_totalprice") <= F.col("median"), 1))
    ranked = spent.join(stored(medians, "medians"), "c_mktsegment").groupBy("c_mktsegment", "orders").agg((below / F.count(F.lit(1))).alias("rank"))
    return ranked.select("c_mktsegment", "orders", (F.abs(F.col("rank") - 0.5) <= 2 * sketch.rank_error(k) + 1 / F.col("orders")).alias("within_error"))


def catalog_tables(t: Tables) -> DataFrame:
    """Three tables are made in a database of their own and one is dropped: the others, with their rows."""
    path = work_path(t.spark, "catalog")
    database = path.rsplit("/", 1)[1].replace("-", "_")
    t.spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    for name in ("region", "nation", "supplier"):
        managed.create_or_replace(getattr(t, name), f"{database}.{name}", path=f"{path}/{name}")
    managed.drop(t.spark, f"{database}.supplier")
    listed = managed.tables_in(t.spark, database).filter("NOT isTemporary").select(F.col("tableName").alias("table_name"))
    sizes = None
    for name in ("region", "nation"):
        one = t.spark.table(f"{database}.{name}").agg(F.count(F.lit(1)).alias("rows")).withColumn("table_name", F.lit(name))
        sizes = one if sizes is None else sizes.unionByName(one)
    return listed.join(sizes, "table_name", "left")


for build in (catalog_tables, keyed_delete, keyed_compaction, append_widened, bucketed_join, pruned_fact, segment_median_sketch):
    job(build)


# --- data quality ----------------------------------------------------------------------------

def expect_report(t: Tables) -> DataFrame:
    """The drop rules on the cleaned holdings and a warn rule on the portfolio."""
    cleaned = quality.expect(medallion.cleaned_holdings(_bronze_holdings(t)), medallion.HOLDING_RULES)
    values = medallion.market_values(*_silver(t))
    return cleaned.unionByName(quality.expect(values, {"has_market_value": "Market_Value > 0"}))


def expect_or_drop(t: Tables) -> DataFrame:
    kept, _ = quality.expect_or_drop(medallion.cleaned_holdings(_bronze_holdings(t)), medallion.HOLDING_RULES)
    return kept


def gold_checks(t: Tables) -> DataFrame:
    """Columns of the portfolio that may not be null, and positions without a holding."""
    holdings, prices = _silver(t)
    portfolio = medallion.gold_portfolio(holdings, prices)
    rules = {c: F.col(c).isNotNull() for c in ("Shares_Held", "Cost_Basis", "Market_Value")}
    orphans = quality.relationships(portfolio, "Ticker", holdings, "Ticker")
    lost = orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failed"))
    known = portfolio.agg(F.count("Ticker").alias("rows")).withColumn("failed", lost.scalar())
    related = known.select(F.lit("known_holding").alias("rule"), "rows", (F.col("rows") - F.col("failed")).alias("passed"), "failed")
    return quality.expect(portfolio, rules).unionByName(related)


def dq_weight_total(t: Tables) -> DataFrame:
    """The total of the weights, and of weights that are off target."""
    portfolio = _portfolio(t).select("Weight_Pct", (F.col("Weight_Pct") * 2).alias("Double_Pct"))
    return quality.total_drift(portfolio, ["Weight_Pct", "Double_Pct"], 100)


def dq_relationships(t: Tables) -> DataFrame:
    """Held tickers that have no price."""
    holdings, prices = _silver(t)
    return quality.relationships(holdings, "Ticker", prices, "Symbol")


def dq_orphans(t: Tables) -> DataFrame:
    """Lines whose order is not among those delivered or open; the lines are not shuffled."""
    orders = t.orders.filter("o_orderstatus <> 'P'")
    return quality.orphans_by_bitmap(t.lineitem, "l_orderkey", orders, "o_orderkey")


def source_freshness(t: Tables) -> DataFrame:
    return quality.freshness(t.events, "ts", datetime(2024, 2, 1), warn_hours=12, error_hours=48)


def observed_rules(t: Tables) -> DataFrame:
    """Three tables written under rules: what each rule saw, and what became of the table."""
    line_rules = [
        observed.Rule("known_return", "l_returnflag <> 'X'"),
        observed.Rule("small_discount", "l_discount <= 0.08"),
        observed.Rule("enough_pieces", "l_quantity >= 5", "drop"),
        observed.Rule("recent", "l_shipdate >= '1994-01-01'", "drop"),
        observed.Rule("has_order", "l_orderkey IS NOT NULL", "fail"),
    ]
    order_rules = [observed.Rule("has_status", "o_orderstatus IS NOT NULL", "fail"), observed.Rule("affordable", "o_totalprice < 300000", "fail")]
    holding_rules = [observed.Rule(name, rule, "drop") for name, rule in medallion.HOLDING_RULES.items()]
    inputs = {
        "lineitem": (t.lineitem, line_rules),
        "orders": (t.orders, order_rules),
        "holdings": (medallion.cleaned_holdings(_bronze_holdings(t)), holding_rules),
    }
    reports = None
    for name, (df, rules) in inputs.items():
        written = observed.write_observed(df, work_path(t.spark, f"observed-{name}"), rules)
        report = written.report(t.spark).withColumns({"dataset": F.lit(name), "outcome": F.lit("withheld" if written.broken else "written")})
        if written.broken:
            report = report.withColumn("rows_in_table", F.lit(None).cast("long"))
        else:
            report = report.withColumn("rows_in_table", written.table(t.spark).agg(F.count(F.lit(1))).scalar())
        reports = report if reports is None else reports.unionByName(report)
    return reports


job(observed_rules)
job(expect_report)
job(expect_or_drop)
job(gold_checks)
job(dq_weight_total)
job(lambda t: quality.unique(t.lineitem, ["l_orderkey", "l_linenumber"]), "dq_unique")
job(lambda t: quality.not_null(_bronze_holdings(t).drop("_ingested_at"), "Ticker"), "dq_not_null")
job(lambda t: quality.accepted_values(t.orders, "o_orderstatus", ["F", "O"]), "dq_accepted_values")
job(dq_relationships)
job(dq_orphans)
job(lambda t: quality.total_off_target(_portfolio(t), "Weight_Pct", 100, 0.5), "dq_weight_sum")
job(source_freshness)


# --- datasets with declared inputs --------------------------------------------------------------

def portfolio_project(t: Tables) -> Project:
    """The portfolio as six named datasets."""
    p = Project(t.spark)
    p.source("raw_holdings", derived.dirty_holdings(t))
    p.source("raw_prices", derived.dirty_prices(t))

    @p.dataset("view")
    def bronze_holdings(p):
        return files.capture_raw(p.ref("raw_holdings"), "holdings_report", "Holdings")

    @p.dataset("view")
    def bronze_prices(p):
        return files.capture_raw(p.ref("raw_prices"), "holdings_report", "Prices")

    @p.dataset("table")
    def silver_holdings(p):
        return medallion.silver_holdings(p.ref("bronze_holdings"))

    @p.dataset("table")
    def silver_prices(p):
        return medallion.silver_prices(p.ref("bronze_prices"))

    @p.dataset("table")
    def gold_portfolio(p):
        return medallion.gold_portfolio(p.ref("silver_holdings"), p.ref("silver_prices"))

    @p.dataset("ephemeral")
    def gold_sector_allocation(p):
        return medallion.gold_sector_allocation(p.ref("gold_portfolio"))

    return p


def lineage_edges(t: Tables) -> DataFrame:
    """Who reads what, with the rows each input held in this run."""
    project = portfolio_project(t)
    project.run()
    sizes = None
    for name in sorted({i for _, i in project.edges}):
        counted = project.ref(name).agg(F.count("*").alias("input_rows")).withColumn("input", F.lit(name))
        sizes = counted if sizes is None else sizes.unionByName(counted)
    return project.lineage().join(sizes, "input").select("dataset", "input", "input_rows")


def incremental_orders(t: Tables) -> DataFrame:
    """A table loaded up to 1999, then extended by a run that sees all orders."""
    folder = work_path(t.spark, "incremental")
    for arrived in (t.orders.filter(F.col("o_orderdate") < F.lit(date(2000, 1, 1))), t.orders):
        run = Project(t.spark, folder)
        run.source("orders", arrived)

        @run.dataset("incremental", cursor="o_orderdate")
        def order_facts(p):
            return p.ref("orders")

        out = run.ref("order_facts")
    return out


def incremental_merge(t: Tables) -> DataFrame:
    """A table loaded with part of the orders under an older status; the next run brings the change and the rest."""
    folder = work_path(t.spark, "incremental")
    early = t.orders.filter(F.col("o_orderkey") % 3 > 0).withColumns({"o_orderstatus": F.lit("N"), "o_orderdate": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderdate"))})
    for arrived in (early, t.orders):
        run = Project(t.spark, folder)
        run.source("orders", arrived)

        @run.dataset("incremental", key=["o_orderkey"])
        def order_facts(p):
            return p.ref("orders")

        out = run.ref("order_facts")
    return out


def parallel_project(t: Tables) -> DataFrame:
    """The portfolio with a dataset that fails and one that needs it: what became of each, and its rows."""
    project = portfolio_project(t)

    @project.dataset("table")
    def broken_prices(p):
        return p.ref("silver_prices").withColumn("Close", F.raise_error(F.lit("no such price")))

    @project.dataset("table")
    def broken_portfolio(p):
        return medallion.gold_portfolio(p.ref("silver_holdings"), p.ref("broken_prices"))

    lines = None
    for name, outcome in sorted(project.run_side_by_side().items()):
        one = t.spark.range(1) if outcome.rows is None else outcome.rows
        counted = one.agg((F.lit(None).cast("long") if outcome.rows is None else F.count(F.lit(1))).alias("rows"))
        line = counted.select(F.lit(name).alias("dataset"), F.lit(outcome.state).alias("state"), "rows")
        lines = line if lines is None else lines.unionByName(line)
    return lines


job(parallel_project)
job(lineage_edges)
job(incremental_orders)
job(incremental_merge)


# --- scoring ---------------------------------------------------------------------------------------

def score_vectorized(t: Tables) -> DataFrame:
    scored = scoring.score_vectorized(derived.scoring_input(t))
    return scored.withColumn("p_buy", F.round("p_buy", 9))


def score_builtin(t: Tables) -> DataFrame:
    scored = scoring.score_builtin(derived.scoring_input(t))
    return scored.withColumn("p_buy", F.round("p_buy", 9))


def top_scored(t: Tables) -> DataFrame:
    return scoring.top_scored(score_builtin(t), "c_custkey")


def score_by_partitions(t: Tables) -> DataFrame:
    tried = None
    for n in (4, 16, 32):
        one = scoring.score_by_partitions(derived.scoring_input(t), n).withColumn("partitions", F.lit(n).cast("long"))
        tried = one if tried is None else tried.unionByName(one)
    return tried.withColumn("total_prob", F.round("total_prob", 6))


for build in (score_vectorized, score_builtin, top_scored, score_by_partitions):
    job(build)


# --- auction ------------------------------------------------------------------------------------------

def _opportunities(t: Tables) -> DataFrame:
    return auction.parse_opportunities(derived.opportunity_messages(t.events))[0]


def _winners(t: Tables) -> DataFrame:
    return auction.pick_winners(_opportunities(t))


def _results(t: Tables) -> DataFrame:
    """Result records with a processing time that follows from the message number."""
    number = F.substring_index("opportunity_id", "-", -1).cast("long")
    done = F.try_to_timestamp("timestamp") + F.make_dt_interval(secs=(number % 500) / 1000)
    return auction.processed(_winners(t).withColumn("started", F.col("timestamp")), done)


def auction_latency(t: Tables) -> DataFrame:
    return auction.latency(_results(t), "started", "processed_at", "content_category")


def keyed_upsert(t: Tables) -> DataFrame:
    """Results by opportunity, some delivered again with a later time and all of them with an earlier one: the last write wins."""
    path = work_path(t.spark, "auction_results")
    results = _results(t).drop("started")
    again = results.withColumns(
        {"score_margin": F.lit(0.0), "processed_at": F.lit("2030-01-01T00:00:00.000Z")}
    ).filter(F.col("content_category") == "sports")
    late = results.withColumns({"score_margin": F.lit(-1.0), "processed_at": F.lit("2000-01-01T00:00:00.000Z")})
    for batch in (results, again, late):
        batch.write.mode("append").parquet(path)
    return first_per_key(t.spark.read.parquet(path), ["opportunity_id"], [F.desc("processed_at")])


def auction_windows(t: Tables) -> DataFrame:
    """Bids scored from tables; a third of the messages come within one hour.

    The windows: the bonuses by hour on every day with an event, one open at its
    start and one open at its end.
    """
    rush = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-02 07:00:00")) + F.col("event_id") % 3600)
    events = t.events.withColumn("ts", F.when(F.col("event_id") % 3 == 0, rush.cast("timestamp_ntz")).otherwise(F.col("ts")))
    good, _ = auction.parse_opportunities(derived.opportunity_messages(events))
    relevance, devices = auction.lookup_tables(t.spark)
    days = events.select(F.to_date("ts").alias("day")).distinct()
    edge = lambda day: F.unix_micros(F.lit(f"{day} 00:00:00").cast("timestamp"))
    none = F.lit(None).cast("long")
    open_ended = t.events.groupBy().agg(F.lit(1)).select(
        F.inline(F.array(
            F.struct(none.alias("first"), edge("2024-01-02").alias("after"), F.lit(1.02).alias("time_bonus")),
            F.struct(edge("2024-01-05").alias("first"), none.alias("after"), F.lit(1.05).alias("time_bonus")),
        ))
    )
    windows = stored(auction.daily_windows(days).unionByName(open_ended), "windows")
    return auction.score_from_tables(good, stored(relevance, "relevance"), stored(devices, "devices"), windows)


job(auction_windows)
job(lambda t: auction.score_bids(_opportunities(t)), "auction_scores")
job(lambda t: _winners(t).drop("timestamp"), "auction_winners")
job(lambda t: auction.parse_opportunities(derived.opportunity_messages(t.events))[1], "auction_quarantine")
job(lambda t: auction.win_counts(_winners(t)), "auction_wins")
job(lambda t: auction.win_counts(_winners(t), ["content_category"]), "auction_wins_by_category")
job(auction_latency)
job(keyed_upsert)


# --- recommender ------------------------------------------------------------------------------------------

def _features(t: Tables) -> DataFrame:
    return recommend.feature_table(derived.interactions(t))


def _split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Train and holdout; the features are stored, as both sides read them."""
    return recommend.holdout_split(stored(_features(t), "features"))


def _stored_split(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The same as tables, for jobs that read each side more than once."""
    train, held = _split(t)
    return stored(train, "train"), stored(held, "holdout")


def id_index(t: Tables) -> DataFrame:
    return recommend.index_ids(_features(t), "user_id", "user_idx")


def hit_rate(t: Tables) -> DataFrame:
    """The popularity baseline against the holdout."""
    train, held = _split(t)
    return recommend.popular_hit_rate(recommend.popular_items(train), held)


def _indexed_train(t: Tables) -> tuple[DataFrame, int, int]:
    """Train with dense ids; the features are stored, as ids and train read them several times."""
    features, users, items = recommend.indexed_features(stored(_features(t), "features"))
    train, _ = recommend.holdout_split(features)
    return train, users.count(), items.count()


def negative_samples(t: Tables) -> DataFrame:
    train, n_users, n_items = _indexed_train(t)
    return recommend.negative_pairs(train, n_users, n_items)


def training_pairs(t: Tables) -> DataFrame:
    train, n_users, n_items = _indexed_train(t)
    train = stored(train, "train")  # read for its top score, its pairs and the draws
    pairs = recommend.training_pairs(train, recommend.negative_pairs(train, n_users, n_items))
    return pairs.withColumn("label", F.round("label", 6))


def negative_checks(t: Tables) -> DataFrame:
    """What has to hold of the draws, whatever the formula: enough of them, all new, spread over all users."""
    train, n_users, n_items = _indexed_train(t)
    train = stored(train, "train")
    drawn = stored(recommend.negative_pairs(train, n_users, n_items), "negatives")
    pairs = ["user_idx", "item_idx"]
    facts = drawn.agg(F.count("*").alias("draws"), F.countDistinct(*pairs).alias("pairs"), F.countDistinct("user_idx").alias("users"))
    overlap = drawn.join(train.select(*pairs), pairs, "left_semi").agg(F.count("*").alias("known"))
    return facts.withColumn("known", overlap.scalar())


def dot_product_topk(t: Tables) -> DataFrame:
    """Every vector as a user against every vector as an item."""
    users = t.embeddings.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vec"))
    items = t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))
    return recommend.dot_topk(users, items)


def _scaled(t: Tables) -> tuple[DataFrame, DataFrame]:
    """The vectors as users, and as items of different lengths: half, once, twice, four or eight times."""
    users = t.embeddings.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vec"))
    by = F.pow(F.lit(2.0), F.col("vec_id") % 5 - 1)
    return users, t.embeddings.select(F.col("vec_id").alias("item_id"), F.transform("embedding", lambda x: x * by).alias("vec"))


def bounded_topk(t: Tables) -> DataFrame:
    """The best items of different lengths, in many small blocks."""
    return recommend.bounded_topk(*_scaled(t), user_rows=100, item_rows=40).best


def bounded_topk_share(t: Tables) -> DataFrame:
    """How many pairs there are, and whether some of them were never scored."""
    out = recommend.bounded_topk(*_scaled(t), user_rows=100, item_rows=40)
    pairs = t.embeddings.agg((F.count(F.lit(1)) * F.count(F.lit(1))).alias("pairs"))
    return pairs.withColumn("some_skipped", F.lit(out.scored < out.pairs)).withColumn("all_counted", F.col("pairs") == F.lit(out.pairs))


def pair_scores(t: Tables) -> DataFrame:
    """Every vector scored against the one that follows it."""
    users = t.embeddings.select(F.col("vec_id").alias("user_id"), F.col("embedding").alias("vec"))
    items = t.embeddings.select(F.col("vec_id").alias("item_id"), F.col("embedding").alias("vec"))
    pairs = users.select("user_id", (F.col("user_id") + 1).alias("item_id"))
    return recommend.score_pairs(pairs, users, items, weight=2.0, bias=-0.5).withColumn("score", F.round("score", 9))


def _als(t: Tables) -> tuple[DataFrame, DataFrame]:
    """ALS recommendations and the holdout."""
    features, users, items = recommend.indexed_features(stored(_features(t), "features"))
    train, held = recommend.holdout_split(stored(features, "indexed_features"))
    return recommend.top_items(recommend.fit_als(stored(train, "train")), users, items), held


def als_factors(t: Tables) -> DataFrame:
    """The training alone: how many users and items got factors, and of what length."""
    train, _, _ = _indexed_train(t)
    model = recommend.fit_als(stored(train, "train"))
    sides = [m.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("features")).cast("long").alias("factors")).withColumn("side", F.lit(s))
             for s, m in (("user", model.userFactors), ("item", model.itemFactors))]
    return sides[0].unionByName(sides[1])


def als_checks(t: Tables) -> DataFrame:
    """What has to hold of recommendations, whatever the factors."""
    recs, held = _als(t)
    recs, features = stored(recs, "recommendations"), _features(t)
    counts = recs.groupBy("user_id").agg(F.count("*").alias("n"), F.count_distinct("item_id").alias("items"), F.count("score").alias("scores"))
    facts = counts.agg(
        F.count("*").alias("users"), F.min("n").alias("least"), F.max("n").alias("most"),
        F.sum(F.col("n") - F.col("items")).alias("repeated"), F.sum(F.col("n") - F.col("scores")).alias("unscored"),
    )
    strange = recs.join(features.select("item_id").distinct(), "item_id", "left_anti").agg(F.count("*").alias("n"))
    both = recs.join(held, ["user_id", "item_id"], "left_semi").agg(F.count("*").alias("n"))
    hits = recommend.hit_rate(recs, held).select("hits")
    return facts.withColumn("unknown_items", strange.scalar()).withColumn("hits_are_joined_pairs", both.scalar() == hits.scalar())


def als_hit_rate(t: Tables) -> DataFrame:
    return recommend.hit_rate(*_als(t))


def run_log(t: Tables) -> DataFrame:
    """The ALS run and the baseline run as logged."""
    path = work_path(t.spark, "runs")
    als = {"algorithm": "ALS-implicit", "rank": recommend.RANK, "maxIter": recommend.ITERATIONS,
           "regParam": recommend.REGULARISATION}
    recommend.log_run(path, hit_rate(t), "run-1", "popular", {"algorithm": "popularity"}, "hit_rate")
    recommend.log_run(path, als_hit_rate(t), "run-2", "als", als, "hit_rate")
    return t.spark.read.schema(recommend.RUN_SCHEMA).parquet(path).drop("logged_at")


def run_log_checks(t: Tables) -> DataFrame:
    """The logged runs without their time: parameters in order, and whether the figure is a share."""
    params = F.array_join(F.array_sort(F.transform(F.map_entries("params"), lambda e: F.concat_ws("=", e.key, e.value))), ",")
    return run_log(t).select("run_id", "model", params.alias("params"), "metric", F.col("value").between(0, 1).alias("is_share"))


def promotion_decision(t: Tables) -> DataFrame:
    """Popularity by score holds the title; popularity by number of users challenges it."""
    path = work_path(t.spark, "runs")
    train, held = _stored_split(t)
    measures = {"by_score": None, "by_users": F.count("*")}
    for i, (model, by) in enumerate(measures.items()):
        rate = recommend.popular_hit_rate(recommend.popular_items(train, by=by), held)
        recommend.log_run(path, rate, f"run-{i}", model, {"k": recommend.TOP}, "hit_rate")
    runs = t.spark.read.schema(recommend.RUN_SCHEMA).parquet(path)
    decisions = work_path(t.spark, "decisions")
    recommend.record_decision(decisions, recommend.promote(runs, "by_score", "by_users"))
    return t.spark.read.schema(recommend.DECISION_SCHEMA).parquet(decisions).drop("decided_at")


job(_features, "feature_table")
job(lambda t: recommend.feature_stats(_features(t)), "feature_stats")
job(id_index)
job(lambda t: _split(t)[1], "holdout_split")
job(lambda t: _split(t)[0], "train_split")
job(lambda t: recommend.popular_items(_split(t)[0]), "popular_items")
job(hit_rate)
job(negative_samples)
job(negative_checks)
job(training_pairs)
job(dot_product_topk)
job(bounded_topk)
job(bounded_topk_share)
job(pair_scores)
job(lambda t: _als(t)[0], "als_top_items")
job(als_hit_rate)
job(als_factors)
job(als_checks)
job(run_log)
job(run_log_checks)
job(promotion_decision)


# --- sensor stream ------------------------------------------------------------------------------------------

ALERT_ABOVE = 33.0
# Queries that share the files of a stream at one time, and the files a query takes: the logs that it lists and merges grow with them.
STREAM_LANES, LANE_FILES = 16, 100


def _sensor_stream(t: Tables, replays: bool = False) -> DataFrame:
    return derived.sensor_messages(t.stream("events"), replays)


def _through_files(t: Tables, rows: DataFrame, name: str) -> DataFrame:
    """Run a stream into files and read them back."""
    path = work_path(t.spark, name)
    sensors.run_to_files(rows, f"{path}/out", f"{path}/checkpoint")
    return t.spark.read.schema(rows.schema).parquet(f"{path}/out")


def stream_parsed(t: Tables) -> DataFrame:
    rows = sensors.readings(_sensor_stream(t))
    return _through_files(t, rows, "parsed").withColumn("at", F.col("at").cast("timestamp_ntz"))


def stream_unreadable(t: Tables) -> DataFrame:
    return _through_files(t, sensors.unreadable(_sensor_stream(t)), "unreadable")


def stream_tag_counts(t: Tables) -> DataFrame:
    """Messages of one tag and the skipped ones, as the closing count of a stream."""
    path = work_path(t.spark, "tag_counts")
    counts = sensors.tag_counts(sensors.readings(_sensor_stream(t)), "s1")
    sink = sensors.append_sink(f"{path}/state")
    sensors.run_batches(counts.withColumn("stream", F.lit("s1")), f"{path}/checkpoint", "update", sink)
    return sensors.newest(t.spark, f"{path}/state", ["stream"]).select("messages", "skipped")


def _sensor_means(t: Tables, rows: DataFrame, name: str, mode: str) -> DataFrame:
    """Running means through a stream into a table by sensor; the table is compacted after the run."""
    path = work_path(t.spark, name)
    means = sensors.running_mean(rows)
    table = keyed.KeyedTable(t.spark, f"{path}/state", ("sensor_id",), means.schema)
    sensors.run_batches(means, f"{path}/checkpoint", mode, sensors.table_sink(table))
    table.compact()
    return table.rows()


def stream_running_mean(t: Tables) -> DataFrame:
    return _sensor_means(t, sensors.readings(_sensor_stream(t)), "running_mean", "update")


def stream_restart(t: Tables) -> DataFrame:
    """Running means over eight files by two runs: the first dies in its fourth batch, after writing it."""
    path = work_path(t.spark, "restart")
    numbers = t.events.repartitionByRange(8, "event_id")
    derived.sensor_messages(numbers).write.parquet(f"{path}/in")

    def run(start, sink) -> None:
        messages = sensors.folder_source(t.spark, f"{path}/in", files_per_trigger=1)
        start(sensors.running_mean(sensors.readings(messages)), f"{path}/checkpoint", "update", sink)

    append = sensors.append_sink(f"{path}/state")
    run(sensors.run_interrupted, sensors.interrupt_after(append, 3, written=True))
    run(sensors.run_batches, append)
    state = t.spark.read.parquet(f"{path}/state")
    batches = state.agg(F.count_distinct(sensors.BATCH)).scalar()
    twice = state.groupBy(sensors.BATCH, "sensor_id").agg(F.count("*").alias("n")).filter("n > 1").agg(F.count_distinct(sensors.BATCH)).scalar()
    return sensors.newest(t.spark, f"{path}/state", ["sensor_id"]).withColumns({"batches": batches, "brought_twice": twice})


def stream_batches(t: Tables) -> DataFrame:
    """Unreadable messages in files of ten, one a batch, as the reports on batches count them; the files are dealt to queries that run side by side."""
    path = work_path(t.spark, "batches")
    # stored, as numbering reads them twice and few are unreadable
    unreadable = stored(sensors.unreadable(derived.sensor_messages(t.events)), "unreadable")
    placed = numbered(unreadable.withColumn("id", F.regexp_extract("value", r'"reading_id":(\d+)', 1).cast("long")), "id")
    files = -(-placed.count() // 10)
    lanes = max(min(STREAM_LANES, files), -(-files // LANE_FILES))
    lane = F.pmod(F.floor(F.col("position") / 10), F.lit(max(lanes, 1))).cast("int")
    # in a lane only the last file can be short, so cutting every ten rows leaves the files whole
    sent = placed.withColumn("lane", lane).repartition(max(lanes, 1), "lane").sortWithinPartitions("lane", "position").select("key", "value", "lane")
    sent.write.option("maxRecordsPerFile", 10).partitionBy("lane").parquet(f"{path}/in")

    def start(i: int) -> StreamingQuery:
        messages = sensors.folder_source(t.spark, f"{path}/in/lane={i}", files_per_trigger=1)
        return sensors.start_to_files(messages, f"{path}/out/lane={i}", f"{path}/checkpoint/{i}")

    with sensors.batch_log(t.spark) as log, sensors.quick_checkpoints(t.spark, path):
        done = [n for run in sensors.ended(map(start, range(lanes)), STREAM_LANES) for n in log.of(run).values()]
    counts = t.spark.createDataFrame([(n,) for n in done], "n long")  # one row a batch of the runs
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("messages"), F.count("n").alias("batches"),
        F.max("n").alias("largest"), F.count(F.when(F.col("n") == 10, 1)).alias("full_batches"),
    )


def stream_gaps(t: Tables) -> DataFrame:
    """Numbered messages per user that come out of order, again, or not at all; each part is a run of its own."""
    path = work_path(t.spark, "gaps")
    sent = stored(derived.numbered_messages(t), "numbered")
    with gaps.keyed_state(t.spark):
        for part in (1, 2, 3):
            sent.filter(F.col("part") == part).drop("part").repartition("number").write.mode("append").parquet(f"{path}/in")
            came = t.spark.readStream.schema("key string, number long, at timestamp").parquet(f"{path}/in")
            # no message counts as too late: its time may lie far behind the newest
            found = gaps.gaps(came, idle=timedelta(days=400), watermark="400 days")
            sensors.run_batches(found, f"{path}/checkpoint", "update", sensors.append_sink(f"{path}/state"))
    ranges = F.transform("gaps", lambda g: F.concat_ws("-", g["first"], g["last"]))
    return sensors.newest(t.spark, f"{path}/state", ["key"]).withColumn("gaps", F.array_join(ranges, ","))


def stream_session_summary(t: Tables) -> DataFrame:
    """The running means of one tag, rounded and in sensor order."""
    means = _sensor_means(t, sensors.for_tag(sensors.readings(_sensor_stream(t)), "s1"), "session", "complete")
    return means.select("sensor_id", "readings", F.round("avg_temperature", 3).alias("avg_temperature")).orderBy("sensor_id")


def stream_tumbling(t: Tables) -> DataFrame:
    return _through_files(t, sensors.tumbling_mean(sensors.readings(_sensor_stream(t))), "tumbling")


def stream_dedup(t: Tables) -> DataFrame:
    rows = sensors.dedup(sensors.readings(_sensor_stream(t, replays=True)))
    return _through_files(t, rows, "dedup").withColumn("at", F.col("at").cast("timestamp_ntz"))


def alert_messages(t: Tables) -> DataFrame:
    return _through_files(t, sensors.alerts(sensors.readings(_sensor_stream(t)), ALERT_ABOVE), "alerts")


def auction_stream(t: Tables) -> DataFrame:
    """The auction on a stream of messages: results in files, exactly once across restarts."""
    good, _ = auction.parse_opportunities(derived.opportunity_messages(t.stream("events")))
    return _through_files(t, auction.pick_winners(good).drop("timestamp"), "auction")


def auction_stream_retries(t: Tables) -> DataFrame:
    """The messages of the same stream that failed, set aside without stopping it."""
    _, failed = auction.parse_opportunities(derived.opportunity_messages(t.stream("events")))
    return _through_files(t, failed, "retries")


for build in (auction_stream, auction_stream_retries, stream_parsed, stream_unreadable, stream_tag_counts, stream_running_mean, stream_session_summary,
              stream_restart, stream_batches, stream_gaps,
              stream_tumbling, stream_dedup, alert_messages):
    job(build)


# --- scalar functions -------------------------------------------------------------------------------------------

def scalar_functions(t: Tables) -> DataFrame:
    """One column per text, date and number function, over all priced parts and orders."""
    prices = _bronze_prices(t)
    return prices.select(
        F.trim("Symbol").alias("trimmed"),
        F.regexp_replace("Close", MONEY_SIGNS, "").alias("plain"),
        F.col("Date").rlike(US_DATE).alias("is_us_date"),
        iso_from_us_date(F.col("Date")).alias("iso_date"),
        mixed_date(F.col("Date")).alias("day"),
        F.year(mixed_date(F.col("Date"))).cast("long").alias("year"),
        F.date_add(mixed_date(F.col("Date")), 30).alias("due"),
        F.date_diff(F.date_add(mixed_date(F.col("Date")), 30), mixed_date(F.col("Date"))).cast("long").alias("days"),
        F.nullif("Close", F.lit("N/A")).alias("close_text"),
        F.coalesce(money_text(F.col("Close"), "N/A"), F.lit(0.0)).alias("close"),
        F.abs(F.coalesce(money_text(F.col("Change_Pct"), "-"), F.lit(0.0))).alias("move"),
        (digits_only(F.col("Volume")) % 1000).cast("long").alias("odd_lot"),
        F.when(F.col("Close") == "N/A", "missing").otherwise("priced").alias("state"),
    )


job(scalar_functions)
