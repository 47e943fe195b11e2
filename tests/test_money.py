"""Exact sums, with ANSI mode on and off."""

from decimal import Decimal

import pytest

from tidemill.functions import money


@pytest.fixture(params=["true", "false"])
def mode(spark, request):
    spark.conf.set("spark.sql.ansi.enabled", request.param)
    yield
    spark.conf.unset("spark.sql.ansi.enabled")


def test_sums_beyond_64_bits(spark, mode):
    df = spark.createDataFrame([(9e16,), (9e16,), (-0.01,), (None,)], "x double")
    out = df.agg(money.exact_sum("x").alias("cents"), money.total("x").alias("total"), money.mean("x").alias("mean")).first()
    assert out.cents == Decimal("17999999999999999999")
    assert (out.total, out.mean) == (1.8e17, 6e16)


def test_no_amounts(spark, mode):
    out = spark.createDataFrame([(None,)], "x double").agg(money.total("x").alias("t"), money.mean("x").alias("m")).first()
    assert (out.t, out.m) == (None, None)


def test_an_amount_that_does_not_fit_raises(spark, mode):
    with pytest.raises(Exception, match="amount beyond"):
        spark.createDataFrame([(1e17,)], "x double").agg(money.total("x")).collect()


def test_order_does_not_matter(spark, mode):
    df = spark.range(10_000).selectExpr("(id * 7919 % 100003) / 100 - 300 as x")
    totals = {df.orderBy(c).repartition(n).agg(money.total("x")).first()[0] for c, n in (("x", 3), ("x", 7))}
    exact = sum(i * 7919 % 100003 - 30000 for i in range(10_000)) / 100
    assert totals == {exact}
