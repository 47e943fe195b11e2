"""Words that sums modulo a power of two cannot tell apart."""

import pytest

from tests.llm import plain
from tidemill.llm import decontaminate, minhash_dedup, phrase_dedup, weak_rules
from tidemill.llm import rolling as R


def doubled(n):
    """Two different words of 2**n letters, built by doubling."""
    one, two = "a", "b"
    for _ in range(n):
        one, two = one + two, two + one
    return one, two


@pytest.fixture(scope="module", params=[10, 11, 12])
def pair(request):
    return doubled(request.param)


def frame(spark, rows, columns="doc_id long, text string"):
    return spark.createDataFrame(rows, columns)


def test_hashes_differ(pair):
    w = R.words_of([" ".join(pair).encode(), " ".join(reversed(pair)).encode()])
    assert w.hashes[0] != w.hashes[1] and w.hashes[0] == w.hashes[3] and w.hashes[1] == w.hashes[2]


def test_phrases(spark, pair):
    one, two = pair
    rows = [(1, " ".join([one] + [f"w{i}" for i in range(59)])), (2, " ".join([two] + [f"w{i}" for i in range(30)] + [one] + [f"w{i}" for i in range(31, 59)]))]
    rows += [(3, " ".join([one, two] * 30)), (4, " ".join([two, one, one] * 20))]
    out = phrase_dedup.remove_repeated(frame(spark, rows)).select("doc_id", "dedup.n_words", "dedup.n_removed", "dedup.kept_sha256")
    assert sorted(tuple(r) for r in out.collect()) == sorted(plain.phrase_dedup(rows))


def test_near_duplicates(spark, pair):
    one, two = pair
    rows = [(1, f"{one} b c d"), (2, f"{two} b c d"), (3, f"{one} b c d")]
    out = minhash_dedup.near_duplicates(frame(spark, rows), size=4).select("doc_id", "near.n_shingles", "near.component_id")
    assert sorted(tuple(r) for r in out.collect()) == sorted(plain.near_duplicates(rows))


def test_contamination(spark, pair):
    one, two = pair
    rows, items = [(1, f"{one} x y"), (2, f"{two} x y")], [("i", f"{one} x y"), ("j", f"q {two}")]
    out = decontaminate.contamination(frame(spark, rows), frame(spark, items, "item_id string, text string")).collect()
    assert sorted((r.doc_id, r.hits.n_words, r.hits.n_hit, r.hits["items"]) for r in out) == sorted(plain.contamination(rows, items))


def test_repeated_words(spark, pair):
    one, two = pair
    text = f"{one} x y {two} x y {one} x z"
    row = weak_rules.judged(frame(spark, [(1, text)])).first()
    assert row.rules.n_repeat_words == plain.rule_counts(text)[4]
