from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.operators import observed, quality
from tidemill.operators.observed import Rule, write_observed
from tidemill.session import work_path


@pytest.fixture
def path(spark):
    return work_path(spark, "observed-test")


def table(spark):
    return spark.createDataFrame([(1, 5), (2, None), (3, -1), (4, 8)], "k int, v int")


def test_warn_counts_and_writes_all(spark, path):
    out = write_observed(table(spark), path, [Rule("positive", "v > 0"), Rule("small", F.col("k") < 4)])
    assert rows(out.report(spark)) == [("positive", "warn", 4, 2, 2), ("small", "warn", 4, 3, 1)]
    assert rows(out.table(spark)) == rows(table(spark)) and out.kept == 4


def test_drop_leaves_out_and_counts_all(spark, path):
    out = write_observed(table(spark), path, [Rule("positive", "v > 0", "drop"), Rule("odd", "k % 2 = 1", "drop"), Rule("few", "v < 6")])
    assert rows(out.table(spark)) == [(1, 5)]
    assert [r[2:] for r in rows(out.report(spark))] == [(4, 2, 2), (4, 2, 2), (4, 2, 2)] and (out.rows, out.kept) == (4, 1)


def test_fail_withholds_the_table(spark, path):
    out = write_observed(table(spark), path, [Rule("positive", "v > 0", "fail"), Rule("keyed", "k IS NOT NULL", "fail")])
    assert out.broken == ["positive"] and rows(out.report(spark))[1] == ("positive", "fail", 4, 2, 2)
    with pytest.raises(quality.ExpectationFailed, match="positive"):
        out.table(spark)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(path)


def test_fail_that_holds_publishes(spark, path):
    assert rows(write_observed(table(spark), path, [Rule("keyed", "k IS NOT NULL", "fail")]).table(spark)) == rows(table(spark))


def test_a_table_is_not_replaced(spark, path):
    write_observed(table(spark), path, [])
    with pytest.raises(FileExistsError):
        write_observed(table(spark), path, [])
    assert spark.read.parquet(path).count() == 4


@pytest.mark.parametrize("made", ["parallelize", "filter", "file"])
def test_no_rows(spark, path, made):
    none = {"parallelize": table(spark).limit(0), "filter": table(spark).filter("k > 9")}.get(made)
    if none is None:
        table(spark).limit(0).write.parquet(f"{path}-in")
        none = spark.read.parquet(f"{path}-in")
    out = write_observed(none, path, [Rule("positive", "v > 0", "fail"), Rule("odd", "k % 2 = 1", "drop")])
    assert rows(out.report(spark)) == [("odd", "drop", 0, 0, 0), ("positive", "fail", 0, 0, 0)]
    assert out.table(spark).count() == 0


def test_partitioned(spark, path):
    out = write_observed(table(spark), path, [Rule("positive", "v > 0", "drop")], partition_by=["k"])
    assert rows(out.table(spark).select("k", "v")) == [(1, 5), (4, 8)]


def test_one_pass_over_the_input(spark, path):
    """Rows are counted as they pass: every row is made once, whatever the number of rules."""
    seen = spark.sparkContext.accumulator(0)

    def pass_on(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    source = spark.range(0, 1000, 1, 4).mapInArrow(pass_on, "id long")
    rules = [Rule("even", "id % 2 = 0"), Rule("large", "id > 10", "drop"), Rule("there", "id IS NOT NULL", "fail")]
    out = write_observed(source, path, rules)
    assert seen.value == 1000 and (out.rows, out.kept) == (1000, 989)


def test_unknown_action():
    with pytest.raises(ValueError, match="action"):
        Rule("x", "true", "ignore")
    assert observed.ACTIONS == ("warn", "drop", "fail")
