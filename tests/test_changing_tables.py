"""Tables whose rows go, whose history is compacted, whose columns change; tables laid out for joins; sketches."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.functions import sketch
from tidemill.plans.registry import JOBS
from tidemill.session import work_path
from tidemill.sources import colocated, evolving
from tidemill.sources.keyed import KeyedTable
from tidemill.sources.managed import SchemaMismatch


@pytest.fixture
def path(spark):
    return work_path(spark, "changing")


# --- rows that go ----------------------------------------------------------------

def frame(spark, values):
    return spark.createDataFrame(values, "k string, n int, v string")


def keyed(spark, path):
    return KeyedTable(spark, path, ("k", "n"), frame(spark, []).schema)


@pytest.mark.parametrize("seed", range(3))
def test_as_a_dictionary(spark, path, seed):
    """Random puts, removals and compactions against a dictionary, at every version still kept."""
    rng = random.Random(seed)
    table, state, past = keyed(spark, path), {}, {}
    for version in range(6):
        keys = [(rng.choice(["a", "b", None]), rng.randrange(4)) for _ in range(5)]
        if rng.random() < 0.6:
            new = {k: (*k, rng.choice(["x", "y", None])) for k in keys}
            table.put(frame(spark, list(new.values())), version)
            state = state | new
        else:
            table.remove(frame(spark, [(*k, None) for k in keys]), version)
            state = {k: v for k, v in state.items() if k not in keys}
        past[version] = sorted(state.values(), key=repr)
        if rng.random() < 0.4:
            table.compact()
        assert rows(table.rows()) == past[version]
    for version, want in past.items():
        assert rows(table.rows(version)) == want
    base = table.compact()
    table.forget()
    assert rows(table.rows()) == past[5] and base == 5
    assert {r.k for r in table.rows().collect()} == {x[0] for x in past[5]}


def test_a_version_written_twice_counts_once(spark, path):
    table = keyed(spark, path)
    table.put(frame(spark, [("a", 1, "old"), ("b", 1, "b")]), 0)
    table.put(frame(spark, [("a", 1, "new")]), 0)
    assert rows(table.rows()) == [("a", 1, "new")]


def test_readers_keep_their_rows_while_a_base_is_written(spark, path):
    table = keyed(spark, path)
    table.put(frame(spark, [("a", 1, "x")]), 0)
    planned = table.rows()
    table.put(frame(spark, [("a", 1, "y")]), 1)
    table.compact()
    assert rows(planned) == [("a", 1, "x")] and rows(table.rows()) == [("a", 1, "y")]


def test_an_unfinished_base_is_not_read(spark, path):
    table = keyed(spark, path)
    table.put(frame(spark, [("a", 1, "x")]), 0)
    table.put(frame(spark, [("b", 1, "x")]), 1)
    frame(spark, []).write.parquet(f"{path}/base/_upto=1")
    fs, done = table._place("base/_upto=1/_SUCCESS")
    fs.delete(done, False)
    assert len(rows(table.rows())) == 2
    table.compact()
    assert len(rows(table.rows())) == 2 and table._bases() == [1]


def test_compacted_versions_are_closed(spark, path):
    table = keyed(spark, path)
    table.put(frame(spark, [("a", 1, "x")]), 0)
    table.compact()
    with pytest.raises(ValueError, match="base"):
        table.put(frame(spark, [("a", 1, "y")]), 0)


def test_old_changes_are_not_read(spark, path):
    table = keyed(spark, path)
    for version in range(4):
        table.put(frame(spark, [("a", version, "x")]), version)
    table.compact(2)
    files = table.rows().inputFiles()
    assert not any(f"_version={v}/" in f for f in files for v in range(3)) and any("_version=3/" in f for f in files)


def test_everything_gone(spark, path):
    table = keyed(spark, path)
    table.put(frame(spark, [("a", 1, "x")]), 0)
    table.remove(frame(spark, [("a", 1, None), ("z", 9, None)]), 1)
    assert table.rows().count() == 0
    table.compact()
    table.forget()
    assert table.rows().count() == 0 and table.rows().columns == ["k", "n", "v"]


# --- columns that change -----------------------------------------------------------

def test_wider(spark):
    cases = [
        ("int", "bigint", "bigint"), ("bigint", "smallint", "bigint"), ("float", "double", "double"), ("int", "double", "double"),
        ("date", "timestamp_ntz", "timestamp_ntz"), ("decimal(9,2)", "decimal(12,4)", "decimal(12,4)"), ("decimal(9,0)", "int", "decimal(10,0)"),
        ("array<int>", "array<bigint>", "array<bigint>"), ("struct<a:int>", "struct<a:bigint>", "struct<a:bigint>"),
        ("bigint", "double", None), ("string", "int", None), ("decimal(38,0)", "decimal(38,10)", None), ("int", "float", None),
        ("struct<a:int>", "struct<b:int>", None), ("array<int>", "array<string>", None), ("boolean", "int", None),
    ]
    for a, b, want in cases:
        for x, y in ((a, b), (b, a)):
            got = evolving.wider(spark.createDataFrame([], f"c {x}").schema[0].dataType, spark.createDataFrame([], f"c {y}").schema[0].dataType)
            assert (got and got.simpleString()) == want, (x, y)


def test_append_added_missing_and_wider(spark, path):
    evolving.append(spark.sql("SELECT 1 AS a, 'x' AS b, CAST(1.5 AS FLOAT) AS c"), path)
    evolving.append(spark.sql("SELECT 5000000000 AS a, CAST(2.5 AS DOUBLE) AS c, DATE'2024-01-01' AS d"), path)
    evolving.append(spark.sql("SELECT 3 AS a, 'z' AS b, CAST(0 AS FLOAT) AS c"), path)
    out = evolving.read(spark, path)
    assert out.dtypes == [("a", "bigint"), ("b", "string"), ("c", "double"), ("d", "date")]
    assert sorted((r.a, r.b, r.c, str(r.d)) for r in out.collect()) == [(1, "x", 1.5, "None"), (3, "z", 0.0, "None"), (5000000000, None, 2.5, "2024-01-01")]


def test_refused_rows_leave_the_table_alone(spark, path):
    evolving.append(spark.sql("SELECT 1L AS a, 'x' AS b"), path)
    with pytest.raises(SchemaMismatch, match="column a is string, table has bigint; column b is int, table has string"):
        evolving.append(spark.sql("SELECT '1' AS a, 2 AS b"), path)
    assert rows(evolving.read(spark, path)) == [(1, "x")]
    assert evolving.schema_of(spark, f"{path}-none") is None


def test_many_shapes_keep_their_folders(spark, path):
    for i in range(12):
        evolving.append(spark.range(i, i + 1).select("id", *[F.lit(i).alias(f"c{j}") for j in range(i)]), path)
    evolving.append(spark.range(50, 51), path)
    out = evolving.read(spark, path)
    assert out.count() == 13 and len(out.columns) == 12
    assert out.filter("id = 11 AND c10 = 11").count() == 1 and out.filter("id = 50 AND c0 IS NULL").count() == 1


# --- laid out for joins ----------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_buckets_meet_without_a_shuffle(spark):
    a = colocated.bucketed(spark.range(1000).select(F.col("id").alias("k"), "id"), "a", "k", 4)
    b = colocated.bucketed(spark.range(0, 3000, 3).select(F.col("id").alias("k"), F.lit(1).alias("one")), "b", "k", 4)
    joined = a.hint("merge").join(b, "k")
    assert "Exchange" not in plan(joined) and "SortMergeJoin" in plan(joined)
    assert joined.count() == 334 and len(a.inputFiles()) <= 4


def test_bucketed_query_shuffles_sums_only(spark, tables):
    text = plan(JOBS["bucketed_join"](spark, tables.folder))
    assert "SortMergeJoin" in text and "hashpartitioning(o_orderkey" not in text and "hashpartitioning(l_orderkey" not in text


def test_folders_are_left_out_by_the_dimension(spark, tables):
    text = plan(JOBS["pruned_fact"](spark, tables.folder))
    assert "dynamicpruning" in text.lower()


# --- sketches ----------------------------------------------------------------------------

def rank_of(spark, df, value):
    return df.agg(F.avg((F.col("v") <= value).cast("double"))).first()[0]


@pytest.mark.parametrize("k", [50, 400])
def test_merged_sketches_are_within_their_error(spark, path, k):
    df = spark.range(40_000).select((F.xxhash64("id") % 100_000).cast("double").alias("v"), (F.col("id") % 9).alias("part"), F.lit("x").alias("g"))
    sketch.sketches(df, ["g", "part"], "v", k).write.parquet(path)
    whole = sketch.merged(spark.read.parquet(path), ["g"])
    for share in (0.01, 0.25, 0.5, 0.9):
        row = whole.select(sketch.quantile(share).alias("q"), sketch.count().alias("n")).first()
        assert row.n == 40_000 and abs(rank_of(spark, df, row.q) - share) <= 2 * sketch.rank_error(k)


def test_few_values_are_exact_and_nulls_left_out(spark):
    df = spark.createDataFrame([("a", 3.0), ("a", None), ("a", 1.0), ("a", 2.0), ("b", None)], "g string, v double")
    got = rows(sketch.sketches(df, ["g"], "v").select("g", sketch.count().alias("n"), sketch.quantile(0.5).alias("q")))
    assert got == [("a", 3, 2.0)]
