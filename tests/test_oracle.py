"""Every job against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
from tests.compare import differences
from tests.conftest import SMALL
from tidemill.plans.registry import JOBS

QUERIES, SQL = JOBS, {name: sql for name, sql in entry.oracle_sql().items() if name in JOBS}
ROWS_ONLY = {"file_inventory", "als_top_items", "als_hit_rate", "run_log"}


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, con, name):
    assert differences(QUERIES[name](spark, SMALL), con, SQL[name]) == []


@pytest.mark.parametrize("name", sorted(ROWS_ONLY))
def test_gives_rows(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_every_job_is_covered():
    assert set(QUERIES) == set(SQL) | ROWS_ONLY


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() >= 25
    assert out.columns == ["c_name", "c_mktsegment", "total_spent", "rank_in_segment"]
