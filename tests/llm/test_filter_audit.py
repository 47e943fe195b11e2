"""The filter audit against documents taken through every order one by one."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import plain
from tidemill.llm import filter_audit

COLUMNS = ["part", "filter_order", "step", "filter", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def outcome(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def text(rng):
    words = [f"w{rng.randrange(rng.choice([5, 4000]))}" for _ in range(rng.choice([0, 10, 49, 50, 51, 90]))]
    words = [w.upper() if rng.random() < 0.2 else w for w in words] if rng.random() < 0.3 else words
    return " ".join(words) + rng.choice(["", "", "\t\n", " #", " a|b", " é 漢"])


@pytest.mark.parametrize("seed", range(3))
def test_as_plain(spark, seed):
    rng = random.Random(seed)
    texts = [text(rng) for _ in range(25)] + [None, "", " \x0b\x0c "]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice(["a", "b", "", None, "ü"])) for _ in range(120)]
    rows += rows[:10]
    marks = [(d, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for d in [*range(0, 60, 2), 4, 4, None, 999]]
    labels = {}
    for d, q, t in marks:
        if d is not None:
            good, toxic = labels.get(d, (False, False))
            labels[d] = (good or q == 1, toxic or t == 1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({c: F.lit(1) for c in ("part", "words", "failed", "n", "salt", "least", "lone", "good", "label")})
    out = filter_audit.audit(docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"))
    assert outcome(out) == sorted(plain.audit(rows, labels))


def test_hot_text_is_spread_and_counted(spark, monkeypatch):
    """A third of the rows are one text; whether it is looked up by broadcast or not, the answer is the same."""
    rows = [(i, "copy " * 60 if i % 3 == 0 else f"own {i}", "s") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    want = sorted(plain.audit(rows, {}))
    for share in (1, 2, 1000):
        monkeypatch.setattr(filter_audit, "HOT_SHARE", share)
        assert outcome(filter_audit.audit(docs, none)) == want


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    assert filter_audit.audit(none, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_positional_popcounts(seed):
    rng = np.random.default_rng(seed)
    groups = 7
    group = np.sort(rng.integers(0, groups, rng.integers(0, 3000)))
    group = group[group != 3]
    words = rng.integers(0, 1 << 32, len(group), dtype=np.uint64).astype(np.uint32)
    want = np.array([[((words[group == g] >> b) & 1).sum() for b in range(32)] for g in range(groups)])
    assert (filter_audit.positional_popcounts(words, group, groups) == want).all()


def test_survival_words():
    for failed, word in enumerate(filter_audit.survival_word(np.arange(32)).tolist()):
        assert [word >> s & 1 for s in range(32)] == [int(not s & failed) for s in range(32)]
