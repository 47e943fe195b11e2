"""Customer 360 and the reports built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.latest import ranked_per_key
from tidemill.functions.money import average, exact_sum, shown, total
from tidemill.session import work_path
from tidemill.sources.files import write_partitioned
from tidemill.tables import Tables


def customer_360(t: Tables) -> DataFrame:
    """One row per customer, with order history and place.

    Customers without orders are kept with zero orders and revenue; their
    average, dates and tenure are null. Orders are added up per customer
    before the join, so the join carries one row per customer on both sides.
    """
    history = t.orders.groupBy("o_custkey").agg(
        F.count("*").alias("orders"),
        exact_sum("o_totalprice").alias("revenue"),
        F.min("o_orderdate").alias("first_order_date"),
        F.max("o_orderdate").alias("last_order_date"),
    )
    return (
        t.customer.join(history, F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_name").alias("customer_name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("n_name").alias("nation"),
            F.col("r_name").alias("region"),
            F.coalesce("orders", F.lit(0)).alias("total_orders"),
            F.coalesce(shown(F.col("revenue")), F.lit(0.0)).alias("total_revenue"),
            average(F.col("revenue"), F.col("orders")).alias("avg_order_value"),
            "first_order_date",
            "last_order_date",
            F.date_diff("last_order_date", "first_order_date").cast("long").alias("customer_tenure_days"),
        )
    )


def segment_report(c360: DataFrame) -> DataFrame:
    """Customers, revenue, mean order and median tenure per segment.

    Customers are first added up per segment and tenure in days, which is at
    most a few thousand rows a segment. The lower median is the first tenure at
    which half of the segment's known tenures are counted.
    """
    per_day = c360.groupBy("segment", "customer_tenure_days").agg(
        F.count("*").alias("customers"),
        F.count("customer_tenure_days").alias("known"),
        exact_sum("total_revenue").alias("revenue"),
        F.sum("total_orders").alias("orders"),
    )
    upto = W.partitionBy("segment").orderBy("customer_tenure_days").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = per_day.withColumns({"upto": F.sum("known").over(upto), "all": F.sum("known").over(W.partitionBy("segment"))})
    half = (F.col("upto") * 2 >= F.col("all")) & (F.col("known") > 0)
    return (
        counted.groupBy("segment")
        .agg(
            F.sum("customers").alias("num_customers"),
            F.sum("revenue").alias("_revenue"),
            F.sum("orders").alias("_orders"),
            F.min(F.when(half, F.col("customer_tenure_days"))).alias("median_tenure_days"),
        )
        .select(
            "segment",
            "num_customers",
            shown(F.col("_revenue")).alias("total_revenue"),
            average(F.col("_revenue"), F.col("_orders")).alias("avg_order_value"),
            "median_tenure_days",
        )
        .orderBy(F.desc("total_revenue"))
    )


def top_customers_by_region(c360: DataFrame, n: int = 5) -> DataFrame:
    columns = ["region", "customer_name", "segment", "nation", "total_revenue"]
    return ranked_per_key(c360.select(*columns), ["region"], [F.desc("total_revenue")], n, "rank_in_region")


def customer_360_checks(c360: DataFrame) -> DataFrame:
    """The sanity checks as one row: counts that must hold, and nulls that must not occur."""

    def nulls(c: str):
        return F.count(F.when(F.col(c).isNull(), 1)).alias(f"null_{c}")

    return c360.agg(
        F.count("*").alias("total_customers"),
        F.count_distinct("segment").alias("segments"),
        F.count_distinct("region").alias("regions"),
        nulls("customer_id"),
        nulls("total_orders"),
        nulls("region"),
    )


def region_summary(rows: DataFrame) -> DataFrame:
    """The query that is run on the plain and on the partitioned copy."""
    return rows.groupBy("region", "segment").agg(
        F.count("*").alias("customers"), total("total_revenue").alias("revenue")
    )


def partitioned_copy(t: Tables) -> DataFrame:
    """Customer 360 in one folder per region, read back and summarised."""
    path = work_path(t.spark, "customer_360_partitioned")
    write_partitioned(customer_360(t), path, ["region"])
    return region_summary(t.spark.read.parquet(path))
