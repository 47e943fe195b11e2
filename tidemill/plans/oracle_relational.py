"""Independent SQL for the star-schema reports."""

M = "DECIMAL(18,2)"


def _sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS {M})) AS DOUBLE)"


def _avg(c: str, n: str | None = None) -> str:
    """Average in whole cents, halves rounded away from zero, without floating point."""
    n = n or f"COUNT({c})"
    cents = f"CAST(SUM(CAST({c} AS {M})) * 100 AS HUGEINT)"
    return f"CAST(SIGN({cents}) * ((2 * ABS({cents}) + {n}) // (2 * {n})) AS DOUBLE) / 100"


WORKING = """
    SELECT o_orderkey AS order_id, c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
           c_nationkey AS nation_key, o_orderdate AS order_date, o_totalprice AS total_price,
           o_orderstatus AS status, o_orderpriority AS priority
    FROM orders JOIN customer ON o_custkey = c_custkey
"""

EMPLOYEES = """
    SELECT c_custkey AS id,
           CASE c_custkey % 5 WHEN 0 THEN 'Engineering' WHEN 1 THEN 'Marketing' WHEN 2 THEN 'Sales'
                WHEN 3 THEN 'Operations' ELSE 'Finance' END AS department,
           (4000000 + (c_custkey * 7919) % 8000000) / 100 AS salary,
           CAST(DATE '2015-01-01' + CAST((c_custkey * 31) % 3650 AS INTEGER) AS DATE) AS hire_date,
           CASE WHEN c_custkey % 10 >= 3 THEN 'Active' ELSE 'Inactive' END AS status
    FROM customer
"""

SUPPLIER_NATION = f"""
    SELECT n_name, n_regionkey, COUNT(*) AS num_suppliers, {_sum('s_acctbal')} AS balance, {_avg('s_acctbal')} AS avg_balance
    FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, n_regionkey
"""

CUSTOMER_SPEND = f"""
    SELECT c_custkey, c_name, c_mktsegment, COUNT(*) AS num_orders, {_sum('o_totalprice')} AS total_spent,
           {_avg('o_totalprice')} AS avg_order_value
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_custkey, c_name, c_mktsegment
"""

DAILY = f"""
    SELECT c_mktsegment AS segment, CAST(o_orderdate AS DATE) AS o_orderdate, SUM(CAST(o_totalprice AS {M})) AS daily
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2
"""

SQL = {
    "building_customers": "SELECT c_custkey, c_name, c_mktsegment, c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING'",
    "staging_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
               o_orderdate AS order_date, o_totalprice AS total_price FROM orders""",
    "sample_orders": f"SELECT * FROM ({WORKING}) ORDER BY order_id LIMIT 100000",
    "sample_orders_small": f"SELECT * FROM ({WORKING}) ORDER BY order_id LIMIT 1000",
    "distinct_segments": "SELECT DISTINCT c_mktsegment AS segment FROM customer",
    "segment_balance": f"""
        SELECT c_mktsegment, COUNT(*) AS num_customers, {_avg('c_acctbal')} AS avg_balance
        FROM customer GROUP BY c_mktsegment""",
    "segment_profile": f"""
        SELECT c_mktsegment AS segment, COUNT(*) AS num_customers, {_avg('c_acctbal')} AS avg_balance,
               ROUND(MIN(c_acctbal), 2) AS min_balance, ROUND(MAX(c_acctbal), 2) AS max_balance
        FROM customer GROUP BY c_mktsegment""",
    "order_value_by_status": f"""
        SELECT o_orderstatus, COUNT(*) AS order_count, {_sum('o_totalprice')} AS total_value,
               {_avg('o_totalprice')} AS avg_value
        FROM orders GROUP BY o_orderstatus""",
    "order_status_stats": f"""
        SELECT o_orderstatus AS status,
               CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial' END AS status_label,
               COUNT(*) AS order_count, {_sum('o_totalprice')} AS total_value, {_avg('o_totalprice')} AS avg_order_value,
               ROUND(STDDEV(o_totalprice), 2) AS stddev_value
        FROM orders GROUP BY o_orderstatus""",
    "pricing_summary": f"""
        SELECT l_returnflag, l_linestatus, COUNT(*) AS cnt, {_avg('l_quantity')} AS avg_qty,
               {_sum('l_extendedprice')} AS sum_price
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "orders_by_year": f"""
        SELECT YEAR(o_orderdate) AS order_year, COUNT(*) AS num_orders, {_avg('o_totalprice')} AS avg_order_value
        FROM orders GROUP BY 1""",
    "monthly_orders": """
        SELECT CAST(DATE_TRUNC('month', o_orderdate) AS TIMESTAMP) AS order_month, COUNT(o_orderkey) AS total_orders
        FROM orders GROUP BY 1""",
    "monthly_orders_by_status": """
        SELECT CAST(DATE_TRUNC('month', o_orderdate) AS TIMESTAMP) AS order_month, COUNT(o_orderkey) AS total_orders,
               COUNT(CASE WHEN o_orderstatus = 'O' THEN o_orderkey END) AS "status_O_count",
               COUNT(CASE WHEN o_orderstatus = 'F' THEN o_orderkey END) AS "status_F_count",
               COUNT(CASE WHEN o_orderstatus = 'P' THEN o_orderkey END) AS "status_P_count"
        FROM orders GROUP BY 1""",
    "order_date_range": "SELECT MIN(o_orderdate) AS earliest, MAX(o_orderdate) AS latest FROM orders",
    "priority_avg_filter": f"""
        SELECT o_orderpriority AS priority, {_avg('o_totalprice')} AS avg_order_value
        FROM orders GROUP BY 1 HAVING {_avg('o_totalprice')} > 150000""",
    "table_counts": """
        SELECT 'customer' AS tbl, COUNT(*) AS rows FROM customer
        UNION ALL SELECT 'orders', COUNT(*) FROM orders
        UNION ALL SELECT 'nation', COUNT(*) FROM nation
        UNION ALL SELECT 'region', COUNT(*) FROM region""",
    "null_audit": """
        SELECT COUNT(*) - COUNT(o_orderkey) AS null_o_orderkey, COUNT(*) - COUNT(o_custkey) AS null_o_custkey,
               COUNT(*) - COUNT(o_orderstatus) AS null_o_orderstatus, COUNT(*) - COUNT(o_totalprice) AS null_o_totalprice,
               COUNT(*) - COUNT(o_orderdate) AS null_o_orderdate, COUNT(*) - COUNT(o_orderpriority) AS null_o_orderpriority
        FROM orders""",
    "top_orders": """
        SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate, o_orderstatus FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""",
    "top_spenders": f"""
        SELECT c_name, c_mktsegment, COUNT(o_orderkey) AS num_orders, {_sum('o_totalprice')} AS total_spent
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name, c_mktsegment
        ORDER BY total_spent DESC, c_name LIMIT 10""",
    "supplier_nations": f"""
        SELECT n_name AS nation, num_suppliers, avg_balance FROM ({SUPPLIER_NATION})
        ORDER BY num_suppliers DESC, n_name LIMIT 10""",
    "top_supplier_nations": f"""
        SELECT n_name, num_suppliers, avg_balance FROM ({SUPPLIER_NATION})
        ORDER BY num_suppliers DESC, n_name LIMIT 5""",
    "nation_region_balance": f"""
        SELECT n_name AS nation, r_name AS region, balance AS total_balance
        FROM ({SUPPLIER_NATION}) JOIN region ON n_regionkey = r_regionkey
        ORDER BY balance DESC, n_name LIMIT 5""",
    "revenue_by_part_type": f"""
        SELECT p_type, {_sum('l_extendedprice')} AS total_revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type
        ORDER BY total_revenue DESC, p_type LIMIT 10""",
    "segment_status_view": f"""
        SELECT c_mktsegment, o_orderstatus, COUNT(*) AS order_count, {_avg('o_totalprice')} AS avg_price
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment, o_orderstatus""",
    "above_average_customers": f"""
        WITH s AS ({CUSTOMER_SPEND}),
             o AS (SELECT {_avg('avg_order_value')} AS global_avg FROM s)
        SELECT c_name, c_mktsegment, num_orders, avg_order_value, total_spent, global_avg,
               ROUND(avg_order_value / global_avg * 100 - 100, 1) AS pct_above_avg
        FROM s CROSS JOIN o WHERE avg_order_value > global_avg * 1.5
        ORDER BY total_spent DESC, c_name LIMIT 15""",
    "ctas_segment_year": f"""
        SELECT c_mktsegment AS segment, YEAR(o_orderdate) AS order_year, COUNT(*) AS num_orders,
               COUNT(DISTINCT o_custkey) AS unique_customers, {_sum('o_totalprice')} AS total_revenue,
               {_avg('o_totalprice')} AS avg_order_value
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2""",
    "top_by_segment": f"""
        SELECT * FROM (
            SELECT c_name, c_mktsegment, total_spent,
                   RANK() OVER (PARTITION BY c_mktsegment ORDER BY total_spent DESC) AS rank_in_segment
            FROM (SELECT c_name, c_mktsegment, {_sum('o_totalprice')} AS total_spent
                  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_name, c_mktsegment))
        WHERE rank_in_segment <= 5""",
    "priority_rank_by_year": """
        SELECT * FROM (
            SELECT order_year, priority, order_count,
                   RANK() OVER (PARTITION BY order_year ORDER BY order_count DESC) AS rank_in_year
            FROM (SELECT YEAR(o_orderdate) AS order_year, o_orderpriority AS priority, COUNT(*) AS order_count
                  FROM orders GROUP BY 1, 2))
        WHERE rank_in_year <= 3""",
    "cumulative_revenue": f"""
        SELECT o_orderdate, CAST(daily AS DOUBLE) AS daily_revenue,
               CAST(SUM(daily) OVER (ORDER BY o_orderdate) AS DOUBLE) AS cumulative_revenue,
               COUNT(*) OVER (ORDER BY o_orderdate) AS cumulative_days
        FROM ({DAILY}) WHERE segment = 'BUILDING'""",
    "lead_daily_revenue": f"""
        SELECT segment, o_orderdate, CAST(daily AS DOUBLE) AS daily_revenue,
               CAST(LEAD(daily) OVER w AS DOUBLE) AS next_revenue,
               CAST(LEAD(daily) OVER w - daily AS DOUBLE) AS change
        FROM ({DAILY}) WINDOW w AS (PARTITION BY segment ORDER BY o_orderdate)""",
    "moving_avg_7d": f"""
        SELECT segment, o_orderdate, CAST(daily AS DOUBLE) AS daily_revenue,
               CAST(SUM(daily) OVER w AS DOUBLE) / COUNT(*) OVER w AS avg_7d
        FROM ({DAILY})
        WINDOW w AS (PARTITION BY segment ORDER BY o_orderdate RANGE BETWEEN INTERVAL 6 DAYS PRECEDING AND CURRENT ROW)""",
    "yearly_trends": f"""
        WITH r AS (
            SELECT YEAR(o_orderdate) AS order_year, r_name AS region, {_sum('o_totalprice')} AS total_revenue
            FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
                 JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2),
        p AS (SELECT *, LAG(total_revenue) OVER (PARTITION BY region ORDER BY order_year) AS prev_revenue FROM r)
        SELECT order_year, region, total_revenue, prev_revenue,
               ROUND((total_revenue - prev_revenue) * 100 / prev_revenue, 2) AS yoy_pct FROM p""",
    "generated_employees": EMPLOYEES,
    "department_profile": f"""
        SELECT department, COUNT(*) AS headcount, {_avg('salary')} AS avg_salary,
               MIN(salary) AS min_salary, MAX(salary) AS max_salary
        FROM ({EMPLOYEES}) WHERE status = 'Active' GROUP BY department""",
    "hires_by_year": f"""
        SELECT YEAR(hire_date) AS hire_year, COUNT(*) AS num_hired, {_avg('salary')} AS avg_salary
        FROM ({EMPLOYEES}) GROUP BY 1""",
    "above_department_average": f"""
        WITH e AS (SELECT * FROM ({EMPLOYEES}) WHERE status = 'Active'),
        a AS (SELECT department, {_sum('salary')} / COUNT(*) AS dept_avg FROM e GROUP BY 1),
        b AS (SELECT department, ROUND(salary - dept_avg, 2) AS above_by FROM e JOIN a USING (department)
              WHERE salary > dept_avg)
        SELECT department, COUNT(*) AS num_above_avg, {_avg('above_by')} AS avg_amount_above FROM b GROUP BY 1""",
    "above_segment_average": f"""
        WITH a AS (SELECT c_mktsegment, {_sum('c_acctbal')} / COUNT(*) AS seg_avg FROM customer GROUP BY 1),
        b AS (SELECT c_mktsegment AS segment, ROUND(c_acctbal - seg_avg, 2) AS above_by
              FROM customer JOIN a USING (c_mktsegment) WHERE c_acctbal > seg_avg)
        SELECT segment, COUNT(*) AS num_above_avg, {_avg('above_by')} AS avg_amount_above FROM b GROUP BY 1""",
    "top_paid_by_department": f"""
        SELECT * FROM (
            SELECT department, id, salary, RANK() OVER (PARTITION BY department ORDER BY salary DESC) AS rank_in_dept
            FROM ({EMPLOYEES}) WHERE status = 'Active')
        WHERE rank_in_dept <= 3""",
    "employees_partitioned": f"""
        SELECT department, COUNT(*) AS headcount, {_avg('salary')} AS avg_salary
        FROM ({EMPLOYEES}) WHERE department = 'Engineering' GROUP BY department""",
}
