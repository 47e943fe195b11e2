"""Reports on the star schema: filters, joins, aggregates and windows.

Facts are added up per foreign key before they meet a dimension wherever the
result allows it. The partial sums run on the map side, so a customer or part
that holds a large share of the rows is one row per task by the time it is
shuffled. Nation and region carry no hint: Spark knows their file size and
broadcasts them while they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.latest import first_rows, ranked_per_key
from tidemill.functions.money import average, exact_sum, mean, ratio, shown, total
from tidemill.functions.ordered import running_total
from tidemill.tables import Tables

# How an order status is shown, and the order in which its columns appear.
STATUS_LABELS = {"F": "Fulfilled", "O": "Open", "P": "Partial"}
STATUS_COLUMNS = ["O", "F", "P"]


# --- filters and projections -------------------------------------------------

def building_customers(t: Tables) -> DataFrame:
    return t.customer.filter(F.col("c_mktsegment") == "BUILDING").select(
        "c_custkey", "c_name", "c_mktsegment", "c_acctbal"
    )


def staging_orders(t: Tables) -> DataFrame:
    names = {
        "o_orderkey": "order_id",
        "o_custkey": "customer_id",
        "o_orderstatus": "status",
        "o_orderdate": "order_date",
        "o_totalprice": "total_price",
    }
    return t.orders.select([F.col(old).alias(new) for old, new in names.items()])


def working_orders(t: Tables, orders: DataFrame | None = None) -> DataFrame:
    """Orders with their customer's name, segment and nation: the nine columns used by the file reports."""
    orders = t.orders if orders is None else orders
    return orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").alias("nation_key"),
        F.col("o_orderdate").alias("order_date"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def sample_orders(t: Tables, rows: int = 100_000) -> DataFrame:
    """A bounded working set: the first orders by key, so the same rows come back every time."""
    return working_orders(t, first_rows(t.orders, "o_orderkey", rows))


def distinct_segments(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_mktsegment").alias("segment")).distinct()


# --- aggregates on one table -------------------------------------------------

def segment_balance(t: Tables) -> DataFrame:
    return (
        t.customer.groupBy("c_mktsegment")
        .agg(F.count("*").alias("num_customers"), mean("c_acctbal").alias("avg_balance"))
        .orderBy(F.desc("num_customers"), "c_mktsegment")
    )


def segment_profile(t: Tables) -> DataFrame:
    return (
        t.customer.groupBy(F.col("c_mktsegment").alias("segment"))
        .agg(
            F.count("*").alias("num_customers"),
            mean("c_acctbal").alias("avg_balance"),
            F.round(F.min("c_acctbal"), 2).alias("min_balance"),
            F.round(F.max("c_acctbal"), 2).alias("max_balance"),
        )
        .orderBy(F.desc("num_customers"), "segment")
    )


def order_value_by_status(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy("o_orderstatus")
        .agg(
            F.count("*").alias("order_count"),
            total("o_totalprice").alias("total_value"),
            mean("o_totalprice").alias("avg_value"),
        )
        .orderBy(F.desc("total_value"))
    )


def order_status_stats(t: Tables) -> DataFrame:
    status = F.col("status")
    label = F.lit(None).cast("string")
    for code, text in STATUS_LABELS.items():
        label = F.when(status == code, text).otherwise(label)
    return (
        t.orders.groupBy(F.col("o_orderstatus").alias("status"))
        .agg(
            F.count("*").alias("order_count"),
            total("o_totalprice").alias("total_value"),
            mean("o_totalprice").alias("avg_order_value"),
            F.round(F.stddev("o_totalprice"), 2).alias("stddev_value"),
        )
        .select(status, label.alias("status_label"), "order_count", "total_value", "avg_order_value", "stddev_value")
        .orderBy(F.desc("order_count"))
    )


def pricing_summary(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count("*").alias("cnt"),
            mean("l_quantity").alias("avg_qty"),
            total("l_extendedprice").alias("sum_price"),
        )
        .orderBy("l_returnflag", "l_linestatus")
    )


def orders_by_year(t: Tables) -> DataFrame:
    return (
        t.orders.groupBy(F.year("o_orderdate").cast("long").alias("order_year"))
        .agg(F.count("*").alias("num_orders"), mean("o_totalprice").alias("avg_order_value"))
        .orderBy("order_year")
    )


def _order_month():
    # date_trunc gives a zoned timestamp; the cast back keeps the wall-clock month start
    return F.date_trunc("month", "order_date").cast("timestamp_ntz").alias("order_month")


def monthly_orders(t: Tables) -> DataFrame:
    return (
        staging_orders(t)
        .groupBy(_order_month())
        .agg(F.count("order_id").alias("total_orders"))
        .orderBy(F.desc("order_month"))
    )


def monthly_orders_by_status(t: Tables) -> DataFrame:
    per_status = [
        F.count(F.when(F.col("status") == s, F.col("order_id"))).alias(f"status_{s}_count") for s in STATUS_COLUMNS
    ]
    return (
        staging_orders(t)
        .groupBy(_order_month())
        .agg(F.count("order_id").alias("total_orders"), *per_status)
        .orderBy(F.desc("order_month"))
    )


def order_date_range(t: Tables) -> DataFrame:
    return t.orders.agg(F.min("o_orderdate").alias("earliest"), F.max("o_orderdate").alias("latest"))


def priority_avg_filter(t: Tables, floor: float = 150_000) -> DataFrame:
    """Average order value per priority, from SQL, then filtered as a DataFrame."""
    per_priority = t.spark.sql(
        """
        SELECT o_orderpriority AS priority,
               CAST(ROUND(CAST(SUM(CAST(RINT(o_totalprice * 100) AS LONG)) AS DECIMAL(38,0)) / (100 * COUNT(*)), 2)
                    AS DOUBLE) AS avg_order_value
        FROM {orders}
        GROUP BY o_orderpriority
        """,
        orders=t.orders,
    )
    return per_priority.filter(F.col("avg_order_value") > floor)


def table_counts(t: Tables) -> DataFrame:
    counts = [
        getattr(t, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("tbl"), "rows")
        for name in ("customer", "orders", "nation", "region")
    ]
    first, *rest = counts
    for more in rest:
        first = first.unionByName(more)
    return first


def null_audit(t: Tables) -> DataFrame:
    """Nulls per column of the orders table, in one pass."""
    return t.orders.agg(
        *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}") for c in t.orders.columns]
    )


def top_orders(t: Tables, k: int = 10) -> DataFrame:
    return (
        t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(k)
    )


# --- joins -------------------------------------------------------------------

def spend_per_customer(t: Tables) -> DataFrame:
    """Orders added up per customer key, with the customer's name and segment."""
    per_key = t.orders.groupBy("o_custkey").agg(
        F.count("o_orderkey").alias("num_orders"), exact_sum("o_totalprice").alias("spent")
    )
    return per_key.join(
        t.customer.select("c_custkey", "c_name", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey")
    )


def top_spenders(t: Tables, k: int = 10) -> DataFrame:
    return (
        spend_per_customer(t)
        .groupBy("c_name", "c_mktsegment")
        .agg(F.sum("num_orders").alias("num_orders"), shown(F.sum("spent")).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "c_name")
        .limit(k)
    )


def _suppliers_per_nation(t: Tables) -> DataFrame:
    """Suppliers counted and their balances added up per nation key, then named."""
    per_key = t.supplier.groupBy("s_nationkey").agg(
        F.count("s_suppkey").alias("num_suppliers"), exact_sum("s_acctbal").alias("balance")
    )
    return per_key.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))


def supplier_nations(t: Tables, k: int = 10) -> DataFrame:
    """Supplier count and balance per nation, written in SQL."""
    return t.spark.sql(
        """
        SELECT n.n_name AS nation, COUNT(s.s_suppkey) AS num_suppliers,
               CAST(ROUND(CAST(SUM(CAST(RINT(s.s_acctbal * 100) AS LONG)) AS DECIMAL(38,0)) / (100 * COUNT(s.s_acctbal)), 2)
                    AS DOUBLE) AS avg_balance
        FROM {supplier} s JOIN {nation} n ON s.s_nationkey = n.n_nationkey
        GROUP BY n.n_name
        ORDER BY num_suppliers DESC, nation
        LIMIT {k}
        """,
        supplier=t.supplier,
        nation=t.nation,
        k=k,
    )


def top_supplier_nations(t: Tables, k: int = 5) -> DataFrame:
    return (
        _suppliers_per_nation(t)
        .groupBy("n_name")
        .agg(
            F.sum("num_suppliers").alias("num_suppliers"),
            average(F.sum("balance"), F.sum("num_suppliers")).alias("avg_balance"),
        )
        .orderBy(F.desc("num_suppliers"), "n_name")
        .limit(k)
    )


def nation_region_balance(t: Tables, k: int = 5) -> DataFrame:
    return (
        _suppliers_per_nation(t)
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy(F.col("n_name").alias("nation"), F.col("r_name").alias("region"))
        .agg(shown(F.sum("balance")).alias("total_balance"))
        .orderBy(F.desc("total_balance"), "nation")
        .limit(k)
    )


def revenue_by_part_type(t: Tables, k: int = 10) -> DataFrame:
    per_part = t.lineitem.groupBy("l_partkey").agg(exact_sum("l_extendedprice").alias("revenue"))
    return (
        per_part.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_type")
        .agg(shown(F.sum("revenue")).alias("total_revenue"))
        .orderBy(F.desc("total_revenue"), "p_type")
        .limit(k)
    )


def segment_status_view(t: Tables) -> DataFrame:
    """A view built from DataFrames and queried with SQL.

    The view holds orders added up per customer and status, so its join key
    is no longer skewed.
    """
    per_key = t.orders.groupBy("o_custkey", "o_orderstatus").agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("value")
    )
    joined = per_key.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        "c_mktsegment", "o_orderstatus", "orders", "value"
    )
    joined.createOrReplaceTempView("order_totals_by_customer")
    return t.spark.sql(
        """
        SELECT c_mktsegment, o_orderstatus, SUM(orders) AS order_count,
               CAST(ROUND(CAST(SUM(value) AS DECIMAL(38,0)) / (100 * SUM(orders)), 2) AS DOUBLE) AS avg_price
        FROM order_totals_by_customer
        GROUP BY c_mktsegment, o_orderstatus
        ORDER BY c_mktsegment, order_count DESC
        """
    )


def above_average_customers(t: Tables, factor: float = 1.5, k: int = 15) -> DataFrame:
    """Customers whose average order is ``factor`` times the average over customers.

    The overall average is a scalar subquery: one value, no join.
    """
    spend = spend_per_customer(t).select(
        "c_name",
        "c_mktsegment",
        "num_orders",
        average(F.col("spent"), F.col("num_orders")).alias("avg_order_value"),
        shown(F.col("spent")).alias("total_spent"),
    )
    overall = spend.agg(mean("avg_order_value").alias("global_avg")).scalar()
    return (
        spend.withColumn("global_avg", overall)
        .filter(F.col("avg_order_value") > F.col("global_avg") * factor)
        .withColumn("pct_above_avg", F.round(F.col("avg_order_value") / F.col("global_avg") * 100 - 100, 1))
        .orderBy(F.desc("total_spent"), "c_name")
        .limit(k)
    )


def segment_year_summary(t: Tables) -> DataFrame:
    """Revenue by segment and year; the body of the summary table."""
    per_key = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("order_year")).agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("value")
    )
    return (
        per_key.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), "order_year")
        .agg(
            F.sum("orders").alias("num_orders"),
            F.count("o_custkey").alias("unique_customers"),  # one row per customer and year
            shown(F.sum("value")).alias("total_revenue"),
            average(F.sum("value"), F.sum("orders")).alias("avg_order_value"),
        )
    )


# --- windows -----------------------------------------------------------------

def top_by_segment(t: Tables, n: int = 5) -> DataFrame:
    """The highest-spending customers of each market segment."""
    per_name = (
        spend_per_customer(t)
        .groupBy("c_name", "c_mktsegment")
        .agg(shown(F.sum("spent")).alias("total_spent"))
    )
    return ranked_per_key(per_name, ["c_mktsegment"], [F.desc("total_spent")], n, "rank_in_segment")


def priority_rank_by_year(t: Tables, n: int = 3) -> DataFrame:
    counts = t.orders.groupBy(
        F.year("o_orderdate").cast("long").alias("order_year"), F.col("o_orderpriority").alias("priority")
    ).agg(F.count("*").alias("order_count"))
    return ranked_per_key(counts, ["order_year"], [F.desc("order_count")], n, "rank_in_year")


def _customer_days(t: Tables) -> DataFrame:
    """Orders added up per customer and calendar day, which takes the skew off the customer key."""
    return t.orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("o_orderdate")).agg(
        exact_sum("o_totalprice").alias("value")
    )


def daily_revenue(t: Tables) -> DataFrame:
    """Revenue per segment and day: one row per segment and calendar day."""
    per_key = _customer_days(t)
    return (
        per_key.join(t.customer.select("c_custkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy(F.col("c_mktsegment").alias("segment"), "o_orderdate")
        .agg(F.sum("value").alias("daily"))
    )


def cumulative_revenue(t: Tables, segment: str = "BUILDING") -> DataFrame:
    """Running revenue and running day count of one segment.

    Running sums are taken inside a month and lifted by the months before
    it, so no window spans the whole history.
    """
    per_key = _customer_days(t)
    wanted = t.customer.filter(F.col("c_mktsegment") == segment).select("c_custkey")
    days = (
        per_key.join(wanted, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("o_orderdate")
        .agg(F.sum("value").alias("daily"))
        .withColumn("_month", F.date_trunc("month", "o_orderdate"))
    )
    return running_total(
        days,
        "_month",
        "o_orderdate",
        {"cumulative_revenue": F.col("daily"), "cumulative_days": F.lit(1).cast("long")},
    ).select(
        "o_orderdate",
        shown(F.col("daily")).alias("daily_revenue"),
        shown(F.col("cumulative_revenue")).alias("cumulative_revenue"),
        F.col("cumulative_days").cast("long").alias("cumulative_days"),
    )


def lead_daily_revenue(t: Tables) -> DataFrame:
    """Each segment's revenue of the day beside that of its next trading day."""
    by_day = W.partitionBy("segment").orderBy("o_orderdate")
    following = F.lead("daily").over(by_day)
    return daily_revenue(t).select(
        "segment",
        "o_orderdate",
        shown(F.col("daily")).alias("daily_revenue"),
        shown(following).alias("next_revenue"),
        shown(following - F.col("daily")).alias("change"),
    )


def moving_avg_7d(t: Tables, days: int = 7) -> DataFrame:
    """Mean daily revenue over the last ``days`` calendar days, per segment."""
    day_no = F.unix_date("o_orderdate")
    span = W.partitionBy("segment").orderBy("_day").rangeBetween(-(days - 1), 0)
    return (
        daily_revenue(t)
        .withColumn("_day", day_no)
        .select(
            "segment",
            "o_orderdate",
            shown(F.col("daily")).alias("daily_revenue"),
            (shown(F.sum("daily").over(span)) / F.count("daily").over(span)).alias("avg_7d"),
        )
    )


def yearly_trends(t: Tables) -> DataFrame:
    """Revenue by year and region, with the change against the year before."""
    per_key = t.orders.groupBy("o_custkey", F.year("o_orderdate").cast("long").alias("order_year")).agg(
        exact_sum("o_totalprice").alias("value")
    )
    revenue = (
        per_key.join(t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
        .groupBy("order_year", F.col("r_name").alias("region"))
        .agg(shown(F.sum("value")).alias("total_revenue"))
    )
    before = F.lag("total_revenue").over(W.partitionBy("region").orderBy("order_year"))
    return (
        revenue.withColumn("prev_revenue", before)
        .withColumn("yoy_pct", ratio((F.col("total_revenue") - F.col("prev_revenue")) * 100, F.col("prev_revenue")))
    )


# --- staff table -------------------------------------------------------------

def department_profile(staff: DataFrame) -> DataFrame:
    return (
        staff.filter(F.col("status") == "Active")
        .groupBy("department")
        .agg(
            F.count("*").alias("headcount"),
            mean("salary").alias("avg_salary"),
            F.min("salary").alias("min_salary"),
            F.max("salary").alias("max_salary"),
        )
        .orderBy(F.desc("avg_salary"))
    )


def hires_by_year(staff: DataFrame) -> DataFrame:
    return (
        staff.groupBy(F.year("hire_date").cast("long").alias("hire_year"))
        .agg(F.count("*").alias("num_hired"), mean("salary").alias("avg_salary"))
        .orderBy("hire_year")
    )


def above_group_average(df: DataFrame, group: str, value: str, average: DataFrame) -> DataFrame:
    """Per group: how many rows lie above their group's average, and by how much.

    ``average`` has one row per group with column ``group_avg``. It carries no
    hint: adaptive execution broadcasts it by its measured bytes.
    """
    above = (
        df.join(average, group)
        .filter(F.col(value) > F.col("group_avg"))
        .withColumn("above_by", F.round(F.col(value) - F.col("group_avg"), 2))
    )
    return (
        above.groupBy(group)
        .agg(F.count("*").alias("num_above_avg"), mean("above_by").alias("avg_amount_above"))
        .orderBy(F.desc("num_above_avg"))
    )


def group_average(df: DataFrame, group: str, value: str) -> DataFrame:
    return df.groupBy(group).agg((total(value) / F.count(value)).alias("group_avg"))


def top_paid_by_department(staff: DataFrame, n: int = 3) -> DataFrame:
    active = staff.filter(F.col("status") == "Active").select("department", "id", "salary")
    return ranked_per_key(active, ["department"], [F.desc("salary")], n, "rank_in_dept")
