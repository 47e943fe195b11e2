"""Independent SQL for files, versions, the customer reports and the portfolio."""

from tidemill.plans.oracle_relational import WORKING, _avg, _sum

C360 = f"""
    SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment, n_name AS nation, r_name AS region,
           COUNT(o_orderkey) AS total_orders, COALESCE({_sum('o_totalprice')}, 0.0) AS total_revenue,
           CASE WHEN COUNT(o_totalprice) > 0 THEN {_avg('o_totalprice')} END AS avg_order_value,
           MIN(o_orderdate) AS first_order_date, MAX(o_orderdate) AS last_order_date,
           DATE_DIFF('day', MIN(o_orderdate), MAX(o_orderdate)) AS customer_tenure_days
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey
         LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
    GROUP BY c_custkey, c_name, c_mktsegment, n_name, r_name
"""


def _cents_text(cents: str, comma: str) -> str:
    whole = f"({cents}) // 100"
    return f"""(CASE WHEN {comma} AND {whole} >= 1000
        THEN CAST(({whole}) // 1000 AS VARCHAR) || ',' || LPAD(CAST(({whole}) % 1000 AS VARCHAR), 3, '0')
        ELSE CAST({whole} AS VARCHAR) END || '.' || LPAD(CAST(({cents}) % 100 AS VARCHAR), 2, '0'))"""


TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

K = "p_partkey"
HOLDINGS = f"""
    SELECT CASE WHEN {K} % 50 <> 0 THEN CASE WHEN {K} % 53 = 0 THEN 'nan'
             ELSE CASE WHEN {K} % 5 = 0 THEN 'NYSE:' ELSE '' END || 'TK' || {K} || CASE WHEN {K} % 7 = 0 THEN '  ' ELSE '' END
             END END AS "Ticker",
           CASE WHEN {K} % 50 <> 0 THEN p_name END AS "Company_Name",
           CASE WHEN {K} % 50 <> 0 THEN CASE WHEN {K} % 61 = 0 THEN 'unknown' ELSE CASE WHEN {K} % 11 = 0 THEN '''' ELSE '' END
             || (CASE WHEN copy = 2 THEN 50 ELSE 100 END + {K} % 900) END END AS "Shares_Held",
           CASE WHEN {K} % 50 <> 0 THEN CASE WHEN {K} % 3 = 0 THEN '$' ELSE '' END ||
             {_cents_text(f'1000 + ({K} * 7919) % 200000', f'{K} % 2 = 0')} END AS "Cost_Basis",
           CASE WHEN {K} % 50 <> 0 THEN p_type END AS "Sector",
           CASE WHEN {K} % 50 <> 0 THEN CASE WHEN {K} % 4 = 0 THEN 'ALT' ELSE 'MAIN' END END AS "Account"
    FROM part, UNNEST(CASE WHEN {K} % 20 = 0 THEN [1, 2] ELSE [1] END) AS u(copy)
"""

PRICES = f"""
    SELECT 'TK' || {K} || CASE WHEN {K} % 9 = 0 THEN ' ' ELSE '' END AS "Symbol",
           CASE WHEN {K} % 2 = 0 THEN '2024-03-15' ELSE '03/15/2024' END AS "Date",
           CASE WHEN {K} % 25 = 0 THEN 'N/A' ELSE CASE WHEN {K} % 3 = 0 THEN '$' ELSE '' END ||
             {_cents_text(f'1000 + ({K} * 104729) % 200000', f'{K} % 2 = 0')} END AS "Close",
           CAST(1000000 + ({K} * 1009) % 50000000 - CASE WHEN copy = 2 THEN 7 ELSE 0 END AS VARCHAR) AS "Volume",
           CASE WHEN {K} % 13 = 0 THEN '-' ELSE CASE WHEN {K} % 2 = 0 THEN '-' ELSE '' END || ({K} % 5) || '.' || ({K} % 10)
             END AS "Change_Pct"
    FROM part, UNNEST(CASE WHEN {K} % 30 = 0 THEN [1, 2] ELSE [1] END) AS u(copy)
"""

TYPED_H = f"""
    SELECT CASE WHEN "Ticker" IS NOT NULL AND TRIM("Ticker") NOT IN ('', 'nan')
             THEN TRIM(REGEXP_REPLACE(TRIM("Ticker"), '^[A-Z]+:', '')) END AS "Ticker", "Company_Name",
           TRY_CAST(REGEXP_REPLACE("Shares_Held", '[^0-9]', '', 'g') AS BIGINT) AS "Shares_Held",
           TRY_CAST(REGEXP_REPLACE("Cost_Basis", '[\\$,]', '', 'g') AS DOUBLE) AS "Cost_Basis", "Sector", "Account"
    FROM ({HOLDINGS})
"""

CLEANED_H = f"""
    SELECT * EXCLUDE (place) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY "Ticker" ORDER BY "Shares_Held" IS NULL, "Company_Name" NULLS FIRST, "Shares_Held",
                                     "Cost_Basis" NULLS FIRST, "Sector" NULLS FIRST, "Account" NULLS FIRST) AS place
        FROM ({TYPED_H}))
    WHERE place = 1
"""

SILVER_H = f"""SELECT * FROM ({CLEANED_H}) WHERE "Ticker" IS NOT NULL AND "Shares_Held" IS NOT NULL"""

SILVER_P = f"""
    SELECT * EXCLUDE (place) FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY "Symbol", "Date" ORDER BY "Close", "Volume" NULLS FIRST, "Change_Pct" NULLS FIRST) AS place
        FROM (
            SELECT TRIM("Symbol") AS "Symbol",
                CAST(CASE WHEN "Date" LIKE '%/%' THEN STRPTIME("Date", '%m/%d/%Y') ELSE STRPTIME("Date", '%Y-%m-%d') END AS DATE) AS "Date",
                TRY_CAST(REGEXP_REPLACE(NULLIF("Close", 'N/A'), '[\\$,]', '', 'g') AS DOUBLE) AS "Close",
                TRY_CAST(REGEXP_REPLACE("Volume", '[^0-9]', '', 'g') AS BIGINT) AS "Volume",
                TRY_CAST(NULLIF("Change_Pct", '-') AS DOUBLE) AS "Change_Pct"
            FROM ({PRICES})) WHERE "Close" IS NOT NULL)
    WHERE place = 1
"""


def _portfolio(prices: str) -> str:
    return f"""
    SELECT *, ROUND("Market_Value" / (SUM(CAST("Market_Value" AS DECIMAL(18,2))) OVER ())::DOUBLE * 100, 2) AS "Weight_Pct"
    FROM (
        SELECT *, ROUND("Market_Value" - "Cost_Value", 2) AS "Unrealized_PnL" FROM (
            SELECT "Ticker", "Company_Name", "Sector", "Shares_Held", "Cost_Basis", "Close" AS "Current_Price",
                   "Change_Pct" AS "Daily_Change_Pct", "Date" AS "Price_Date",
                   ROUND("Shares_Held" * "Close", 2) AS "Market_Value", ROUND("Shares_Held" * "Cost_Basis", 2) AS "Cost_Value"
            FROM ({SILVER_H}) JOIN ({prices}) ON "Ticker" = "Symbol"))
"""


PORTFOLIO = _portfolio(SILVER_P)

SECTORS = f"""
    SELECT *, ROUND("Sector_Value" / (SUM(CAST("Sector_Value" AS DECIMAL(18,2))) OVER ())::DOUBLE * 100, 2) AS "Allocation_Pct"
    FROM (SELECT "Sector", {_sum('"Market_Value"')} AS "Sector_Value", CAST(SUM("Shares_Held") AS BIGINT) AS "Total_Shares",
                 {_sum('"Unrealized_PnL"')} AS "Sector_PnL"
          FROM ({PORTFOLIO}) GROUP BY "Sector")
"""

META_H = "'holdings_report' AS _source_file, 'Holdings' AS _source_sheet"


def _rule(name: str, source: str, cond: str) -> str:
    return f"""
        SELECT '{name}' AS rule, COUNT(*) AS rows, COUNT(*) FILTER (WHERE COALESCE({cond}, FALSE)) AS passed,
               COUNT(*) FILTER (WHERE NOT COALESCE({cond}, FALSE)) AS failed FROM ({source})"""


def _observed(dataset: str, source: str, rules: list[tuple[str, str, str]], kept: str, outcome: str) -> str:
    counts = " UNION ALL ".join(
        f"""SELECT '{rule}' AS rule, '{action}' AS action, COUNT(*) AS rows, COUNT(*) FILTER (WHERE {cond}) AS passed,
                   COUNT(*) - COUNT(*) FILTER (WHERE {cond}) AS failed FROM ({source})"""
        for rule, action, cond in rules
    )
    return f"SELECT *, '{dataset}' AS dataset, '{outcome}' AS outcome, {kept} AS rows_in_table FROM ({counts})"


def _edge(dataset: str, name: str, rows: str) -> str:
    return f"SELECT '{dataset}' AS dataset, '{name}' AS input, COUNT(*) AS input_rows FROM ({rows})"


SQL = {
    "csv_roundtrip": f"""
        SELECT * REPLACE (CAST(order_id AS INTEGER) AS order_id, CAST(customer_id AS INTEGER) AS customer_id) FROM ({WORKING})""",
    "parquet_roundtrip": f"SELECT customer_name, total_price FROM ({WORKING})",
    "format_counts": f"""
        SELECT f AS format, (SELECT COUNT(*) FROM ({WORKING})) AS rows
        FROM (VALUES ('csv'), ('json'), ('orc'), ('parquet')) v(f)""",
    "month_partition_scan": f"""
        SELECT o_orderdate, COUNT(*) AS orders, {_sum('o_totalprice')} AS revenue FROM orders
        WHERE o_orderdate BETWEEN DATE '1996-03-15' AND DATE '1997-06-30' GROUP BY o_orderdate""",
    "events_json_fields": """
        SELECT event_id, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS item_id, event_type FROM events""",
    "snapshot_history": """
        SELECT 0 :: BIGINT AS version, 'WRITE' AS operation, TIMESTAMP '2024-01-01' AS committed_at, COUNT(*) AS rows_written FROM orders
        UNION ALL SELECT 1, 'UPDATE', TIMESTAMP '2024-01-03', COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "snapshot_as_of": WORKING,
    "snapshot_as_of_time": WORKING,
    "decimal_export": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS price, o_orderstatus FROM orders""",
    "table_inventory": " UNION ALL ".join(f"SELECT '{n}' AS table_name, COUNT(*) AS rows FROM {n}" for n in TABLES),
    "snapshot_update": f"""
        SELECT * REPLACE (CASE WHEN priority = '1-URGENT' THEN 'CRITICAL' ELSE priority END AS priority) FROM ({WORKING})""",
    "snapshot_diff": """
        SELECT o_orderpriority AS value, COUNT(*) AS old_rows,
               CASE WHEN o_orderpriority = '1-URGENT' THEN 0 ELSE COUNT(*) END AS new_rows FROM orders GROUP BY 1
        UNION ALL SELECT 'CRITICAL', 0, COUNT(*) FROM orders WHERE o_orderpriority = '1-URGENT'""",
    "append_enforced": """
        SELECT COUNT(*) AS rows, 'column order_id is string, table has bigint' AS outcome FROM orders""",
    "customer_360": C360,
    "segment_report": f"""
        SELECT segment, COUNT(*) AS num_customers, {_sum('total_revenue')} AS total_revenue,
               {_avg('total_revenue', 'SUM(total_orders)')} AS avg_order_value,
               QUANTILE_DISC(customer_tenure_days, 0.5) AS median_tenure_days
        FROM ({C360}) GROUP BY segment""",
    "top_customers_by_region": f"""
        SELECT * FROM (
            SELECT region, customer_name, segment, nation, total_revenue,
                   RANK() OVER (PARTITION BY region ORDER BY total_revenue DESC) AS rank_in_region FROM ({C360}))
        WHERE rank_in_region <= 5""",
    "customer_360_checks": f"""
        SELECT COUNT(*) AS total_customers, COUNT(DISTINCT segment) AS segments, COUNT(DISTINCT region) AS regions,
               COUNT(*) - COUNT(customer_id) AS null_customer_id, COUNT(*) - COUNT(total_orders) AS null_total_orders,
               COUNT(*) - COUNT(region) AS null_region FROM ({C360})""",
    "partitioned_copy": f"""
        SELECT region, segment, COUNT(*) AS customers, {_sum('total_revenue')} AS revenue FROM ({C360}) GROUP BY 1, 2""",
    "bronze_capture": f"""
        SELECT *, {META_H} FROM ({HOLDINGS})
        UNION ALL BY NAME SELECT *, 'holdings_report' AS _source_file, 'Prices' AS _source_sheet FROM ({PRICES})""",
    "title_block_rows": HOLDINGS,
    "silver_holdings": SILVER_H,
    "silver_prices": SILVER_P,
    "gold_portfolio": PORTFOLIO,
    "gold_portfolio_latest": PORTFOLIO,
    "gold_sector_allocation": SECTORS,
    "top_gainers": f"""SELECT * FROM ({PORTFOLIO}) WHERE "Unrealized_PnL" > 0""",
    "layer_funnel": " UNION ALL ".join(
        f"SELECT {i} :: BIGINT AS layer_no, '{name}' AS layer, COUNT(*) AS rows FROM ({rows})"
        for i, (name, rows) in enumerate(
            [("Bronze: Holdings", HOLDINGS), ("Bronze: Prices", PRICES), ("Silver: Holdings", SILVER_H),
             ("Silver: Prices", SILVER_P), ("Gold: Portfolio", PORTFOLIO), ("Gold: Sectors", SECTORS)], 1)
    ),
    "expect_report": " UNION ALL ".join([
        _rule("valid_ticker", CLEANED_H, """("Ticker" IS NOT NULL AND "Ticker" <> 'nan')"""),
        _rule("has_shares", CLEANED_H, '("Shares_Held" IS NOT NULL)'),
        _rule("has_market_value", PORTFOLIO, '("Market_Value" > 0)'),
    ]),
    "expect_or_drop": f"""
        SELECT * FROM ({CLEANED_H}) WHERE "Ticker" <> 'nan' AND "Shares_Held" IS NOT NULL""",
    "observed_rules": " UNION ALL ".join([
        _observed("lineitem", "FROM lineitem", [
            ("known_return", "warn", "l_returnflag <> 'X'"), ("small_discount", "warn", "l_discount <= 0.08"),
            ("enough_pieces", "drop", "l_quantity >= 5"), ("recent", "drop", "l_shipdate >= DATE '1994-01-01'"),
            ("has_order", "fail", "l_orderkey IS NOT NULL"),
        ], "(SELECT COUNT(*) FROM lineitem WHERE l_quantity >= 5 AND l_shipdate >= DATE '1994-01-01')", "written"),
        _observed("orders", "FROM orders", [
            ("has_status", "fail", "o_orderstatus IS NOT NULL"), ("affordable", "fail", "o_totalprice < 300000"),
        ], "NULL::BIGINT", "withheld"),
        _observed("holdings", CLEANED_H, [
            ("valid_ticker", "drop", """("Ticker" IS NOT NULL AND "Ticker" <> 'nan')"""), ("has_shares", "drop", '"Shares_Held" IS NOT NULL'),
        ], f"""(SELECT COUNT(*) FROM ({CLEANED_H}) WHERE "Ticker" <> 'nan' AND "Shares_Held" IS NOT NULL)""", "written"),
    ]),
    "gold_checks": " UNION ALL ".join([
        *[_rule(c, PORTFOLIO, f'"{c}" IS NOT NULL') for c in ("Shares_Held", "Cost_Basis", "Market_Value")],
        _rule("known_holding", PORTFOLIO, f'"Ticker" IN (SELECT "Ticker" FROM ({SILVER_H}))'),
    ]),
    "dq_weight_total": " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", SUM(CAST("Weight_Pct" AS DECIMAL(18,2)) * {by})::DOUBLE AS total,
                   ABS(SUM(CAST("Weight_Pct" AS DECIMAL(18,2)) * {by})::DOUBLE - 100.0::DOUBLE) AS drift FROM ({PORTFOLIO})"""
        for name, by in (("Weight_Pct", 1), ("Double_Pct", 2))
    ),
    "dq_unique": """
        SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""",
    "dq_not_null": f"""SELECT *, {META_H} FROM ({HOLDINGS}) WHERE "Ticker" IS NULL""",
    "dq_accepted_values": """
        SELECT o_orderstatus AS value, COUNT(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 1""",
    "dq_relationships": f"""
        SELECT "Ticker" AS value, COUNT(*) AS n FROM ({SILVER_H})
        WHERE "Ticker" NOT IN (SELECT "Symbol" FROM ({SILVER_P})) GROUP BY 1""",
    "dq_orphans": """
        SELECT l_orderkey AS value, COUNT(*) AS n FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY 1""",
    "dq_weight_sum": f"""
        SELECT * FROM (SELECT SUM(CAST("Weight_Pct" AS DECIMAL(18,2)))::DOUBLE AS total,
                              ABS(SUM(CAST("Weight_Pct" AS DECIMAL(18,2)))::DOUBLE - 100.0::DOUBLE) AS drift FROM ({PORTFOLIO}))
        WHERE drift > 0.5""",
    "source_freshness": """
        SELECT newest, age_hours, CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 12 THEN 'warn' ELSE 'pass' END AS status
        FROM (SELECT MAX(ts) AS newest, ROUND((EPOCH(TIMESTAMP '2024-02-01') - EPOCH(MAX(ts))) / 3600, 3) AS age_hours FROM events)""",
    "lineage_edges": " UNION ALL ".join([
        _edge("bronze_holdings", "raw_holdings", HOLDINGS), _edge("bronze_prices", "raw_prices", PRICES),
        _edge("silver_holdings", "bronze_holdings", HOLDINGS), _edge("silver_prices", "bronze_prices", PRICES),
        _edge("gold_portfolio", "silver_holdings", SILVER_H), _edge("gold_portfolio", "silver_prices", SILVER_P),
        _edge("gold_sector_allocation", "gold_portfolio", PORTFOLIO),
    ]),
    "parallel_project": " UNION ALL ".join([
        *[f"SELECT '{name}' AS dataset, 'built' AS state, COUNT(*) AS rows FROM ({rows})" for name, rows in (
            ("bronze_holdings", HOLDINGS), ("bronze_prices", PRICES), ("silver_holdings", SILVER_H), ("silver_prices", SILVER_P),
            ("gold_portfolio", PORTFOLIO), ("gold_sector_allocation", SECTORS))],
        "SELECT 'broken_prices', 'failed', NULL", "SELECT 'broken_portfolio', 'skipped', NULL",
    ]),
    "catalog_tables": "SELECT 'region' AS table_name, COUNT(*) AS rows FROM region UNION ALL SELECT 'nation', COUNT(*) FROM nation",
    "keyed_delete": """
        WITH o AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders),
             changed AS (SELECT * REPLACE (CASE WHEN o_orderpriority = '1-URGENT' THEN 'CRITICAL' ELSE o_orderpriority END AS o_orderpriority) FROM o)
        SELECT *, 0::BIGINT AS version FROM o UNION ALL SELECT *, 1 FROM changed
        UNION ALL SELECT *, 2 FROM changed WHERE o_orderstatus <> 'P'""",
    "keyed_compaction": """
        SELECT o_orderkey, o_orderstatus, o_totalprice,
               CASE WHEN o_orderstatus = 'P' THEN 'BACK' WHEN o_orderpriority = '1-URGENT' THEN 'CRITICAL' ELSE o_orderpriority END AS o_orderpriority
        FROM orders WHERE o_orderstatus <> 'P' OR o_totalprice > 200000""",
    "append_widened": """
        SELECT o_orderkey, o_custkey, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate, CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS o_orderpriority,
               'column o_custkey is string, table has bigint' AS refused FROM orders""",
    "bucketed_join": f"""
        SELECT o_orderpriority, COUNT(*) AS lines, {_sum('l_extendedprice')} AS revenue FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    "pruned_fact": f"""
        SELECT n_name, COUNT(*) AS orders, {_sum('o_totalprice')} AS revenue
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE r_name = 'ASIA' GROUP BY 1""",
    "segment_median_sketch": """
        SELECT c_mktsegment, COUNT(*) AS orders, TRUE AS within_error FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""",
    "incremental_orders": "SELECT * FROM orders",
    "incremental_merge": "SELECT * FROM orders",
}
