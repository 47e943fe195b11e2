"""What the plans have to look like, whatever the size of the data."""

from __future__ import annotations

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from tests.conftest import SMALL, rows
from tidemill.operators import auction, scoring
from tidemill.plans import customer, derived, relational
from tidemill.plans.registry import JOBS
from tidemill.session import work_path
from tidemill.sources.files import write_partitioned
from tidemill.tables import Tables


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_columns_and_filters_reach_the_scan(tables):
    text = plan(relational.building_customers(tables))
    assert "PushedFilters: [IsNotNull(c_mktsegment), EqualTo(c_mktsegment,BUILDING)]" in text
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_returnflag:string,l_linestatus:string>" in plan(
        relational.pricing_summary(tables)
    )


def test_partial_aggregation(tables):
    assert "partial_sum" in plan(relational.pricing_summary(tables))


def test_facts_are_added_up_before_the_join(tables):
    """The fact side of these joins has one row per key, so a hot customer or part cannot skew it."""
    for build in (relational.top_spenders, relational.revenue_by_part_type, relational.top_by_segment, customer.customer_360):
        text = plan(build(tables))
        fact = text.index("FileScan parquet [l_" if build is relational.revenue_by_part_type else "FileScan parquet [o_")
        assert text.rindex("HashAggregate", 0, fact) > text.rindex("HashJoin", 0, fact)


def test_region_folders_are_pruned(spark, tables):
    path = work_path(spark, "c360")
    c360 = customer.customer_360(tables)
    write_partitioned(c360, path, ["region"])
    copy = spark.read.parquet(path)
    asia = customer.region_summary(copy.filter("region = 'ASIA'"))
    assert "PartitionFilters: [isnotnull(region" in plan(asia)
    assert rows(customer.region_summary(copy)) == rows(customer.region_summary(c360))


def test_top_k_runs_before_the_shuffle(tables):
    for build in (relational.top_by_segment, relational.priority_rank_by_year):
        assert plan(build(tables)).count("WindowGroupLimit") == 2
    assert "TakeOrderedAndProject" in plan(relational.top_orders(tables))


def test_winners_need_no_shuffle(tables):
    good, _ = auction.parse_opportunities(derived.opportunity_messages(tables.events))
    text = plan(auction.pick_winners(good))
    assert "Exchange" not in text
    assert text.count("from_json(") == 1


def test_builtin_score_stays_in_the_jvm(tables):
    df = derived.scoring_input(tables)
    assert "ArrowEvalPython" not in plan(scoring.score_builtin(df))
    assert "ArrowEvalPython" in plan(scoring.score_vectorized(df))


def plans_of(build):
    """The plans of a job: of its result, and of every step that it stores or checkpoints on the way."""
    seen = []
    checkpoint, parquet = DataFrame.checkpoint, DataFrameWriter.parquet

    def noted_checkpoint(self, *args):
        seen.append(plan(self))
        return checkpoint(self, *args)

    def noted_parquet(self, *args, **options):
        seen.append(plan(self._df))
        return parquet(self, *args, **options)

    DataFrame.checkpoint, DataFrameWriter.parquet = noted_checkpoint, noted_parquet
    try:
        seen.append(plan(build()))
    finally:
        DataFrame.checkpoint, DataFrameWriter.parquet = checkpoint, parquet
    return seen


def test_stored_steps_are_looked_at(spark):
    assert len(plans_of(lambda: JOBS["gold_portfolio"](spark, SMALL))) == 4
    assert len(plans_of(lambda: JOBS["negative_samples"](spark, SMALL))) >= 4


@pytest.mark.parametrize("name", sorted(JOBS))
def test_no_cross_joins(spark, name):
    for text in plans_of(lambda: JOBS[name](spark, SMALL)):
        assert "CartesianProduct" not in text
        assert "BroadcastNestedLoopJoin" not in text


def test_large_sides_are_joined_by_shuffle(spark, tables):
    """Without room to broadcast, every join still plans, and the results agree."""
    want = rows(customer.customer_360(tables))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = customer.customer_360(tables)
        assert "SortMergeJoin" in plan(out)
        assert rows(out) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_skewed_customer(spark, tables):
    """One customer with a third of all orders gives the same figures as a plain join."""

    class Skewed(Tables):
        def __getattr__(self, name):
            df = super().__getattr__(name)
            if name == "orders":
                return df.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 0, 5).otherwise(F.col("o_custkey")))
            return df

    t = Skewed(spark, tables.folder)
    plain = (
        t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_name", "c_mktsegment")
        .agg(F.count("*").alias("num_orders"), F.round(F.sum("o_totalprice"), 2).alias("total_spent"))
        .orderBy(F.desc("total_spent"), "c_name").limit(10)
    )
    assert rows(relational.top_spenders(t)) == rows(plain)


def test_customers_without_orders_are_kept(spark, tables):
    class NoOrders(Tables):
        def __getattr__(self, name):
            df = super().__getattr__(name)
            return df.filter("o_custkey <> 7") if name == "orders" else df

    c360 = customer.customer_360(NoOrders(spark, tables.folder))
    assert c360.count() == tables.customer.count()
    row = c360.filter("customer_id = 7").first()
    assert (row.total_orders, row.total_revenue) == (0, 0.0)
    assert row.avg_order_value is None and row.first_order_date is None and row.customer_tenure_days is None
    assert row.region is not None
