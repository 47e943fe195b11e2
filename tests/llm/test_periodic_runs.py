"""Periodic runs against all periods tried one by one."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm import plain
from tidemill.llm import periodic_runs
from tidemill.llm.queries import QUERIES
from tidemill.tables import Tables

NAMES = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_tables_as_plain(spark, tables):
    docs = [(r.doc_id, r.text) for r in tables.documents.select("doc_id", "text").collect() if len((r.text or "").split()) < 1200]
    got = {r.doc_id: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SMALL).select(*NAMES).collect()}
    assert len(got) == tables.documents.count() and len(docs) > 120
    for row in plain.periods(docs):
        assert got[row[0]] == row
    assert sum(row[1] > 0 for row in got.values()) > 10


@pytest.mark.parametrize("seed", range(8))
def test_random_words(seed):
    rng = random.Random(seed)
    for _ in range(250):
        words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 20])) for _ in range(rng.randrange(70))]
        if words and rng.random() < 0.6:
            a, p = rng.randrange(len(words)), rng.randrange(1, 12)
            words = words[:a] + [words[a + i % min(p, len(words) - a)] for i in range(len(words) - a)]
        least = rng.choice([2, 5, 12])
        assert periodic_runs.runs_in(words, least) == plain.runs(words, least)


def test_fibonacci_word():
    a, b = "b", "a"
    while len(b) < 400:
        a, b = b, b + a
    words = [c.encode() for c in b]
    assert periodic_runs.runs_in(words) == plain.runs(words)
    assert periodic_runs.runs_of([ord(c) for c in b], 2) == plain.runs(words, 2)


def test_words_are_compared_whole():
    """Two words that polynomial hashes modulo a power of two take for equal."""
    one, two = "a", "b"
    for _ in range(11):
        one, two = one + two, two + one
    words = [one.encode(), two.encode()] * 3 + [two.encode(), one.encode()] * 5
    assert periodic_runs.runs_in(words) == plain.runs(words)


def test_long_loop_and_long_period():
    words = [b"%d" % (i % 4001) for i in range(9000)]
    assert periodic_runs.runs_in(words) == [(0, 9000, 4001)]
    assert periodic_runs.runs_in([b"a"] * 20_000) == [(0, 20_000, 1)]


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "a b " * 6), (6, "a b " * 5 + "a"), (6, "a b " * 6), (None, "x y z " * 9 + "x"), (7, "é " * 13 + "\x0b漢")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("periods", "runs", "words")})
    out = periodic_runs.find_runs(docs)
    assert set(out.columns) == set(docs.columns) and out.count() == len(rows)
    for row in out.collect():
        words = plain.WORD.findall(row.text or "")
        assert [tuple(r) for r in row.periods.runs] == plain.runs(words) and row.periods.n_words == len(words)
        gone = {i for a, n, q in plain.runs(words) for i in range(a + q, a + n)}
        assert bytes(row.periods.collapsed).decode() == " ".join(w for i, w in enumerate(words) if i not in gone)


def test_query_odd_rows(spark, tmp_path):
    rows = [(d, t) for d, t in zip([None, *range(40)], [None, "", "a"] + ["one two three four five six seven " * 9] * 38, strict=True)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES["op13_periodic_runs"](spark, str(tmp_path))
    assert sorted((tuple(r) for r in out.select(*NAMES).collect()), key=repr) == sorted(plain.periods(rows), key=repr)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert QUERIES["op13_periodic_runs"](spark, f"{tmp_path}/none").count() == 0
    assert Tables(spark, str(tmp_path)).documents.count() == len(rows)
