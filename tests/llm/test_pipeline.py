"""The pipeline, stage by stage, against plain versions of the same decisions."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SMALL
from tests.llm import plain
from tidemill.llm import nbsvm
from tidemill.session import stored


@pytest.fixture(scope="module")
def stages(spark, tables):
    """What every stage got and gave."""
    out, docs = {}, tables.documents
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SMALL), "stage")
        out[name] = (docs, after)
        docs = after
    return out


def pairs(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_order_and_columns(stages, tables):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "near duplicates", "suffix dedup", "decontamination", "source mix"]
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == tables.documents.columns


def test_quality(stages, tables, spark):
    before, after = stages["quality classifier"]
    scores = nbsvm.classify(tables.documents, tables.labels).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in scores if r.score >= 0.3}


def test_one_of_each_group(stages):
    before, after = stages["near duplicates"]
    assert sorted(r.doc_id for r in after.collect()) == sorted(d for d, _, c in plain.near_duplicates(pairs(before), size=5) if c == d)


def test_repeated_strings_go(stages):
    before, after = stages["suffix dedup"]
    rows = pairs(before)
    left = {}
    for (d, t), gone in zip(rows, plain.suffix_cut([t.encode() for _, t in rows], 240), strict=True):
        gone = plain.long_repeats(t.encode(), gone)
        left[d] = bytes(b for b, g in zip(t.encode(), gone, strict=True) if not g).decode("utf-8", "ignore")
    assert dict(pairs(after)) == left
    assert all(r.n_chars == len(r.text) for r in after.collect())


def test_passages_of_over_fifty_words_go(spark):
    """Whatever their length in bytes; shorter ones stay, and so do documents without any."""
    own = lambda d, n: " ".join(f"{'abcdefgh'[i % 8]}{d}x{i}" for i in range(n))
    short, long = " ".join(f"p{i}" for i in range(100, 151)), " ".join(f"q{i}" for i in range(100, 140))
    wide = "漢字" * 80
    texts = [f"{own(1, 30)} {short} {own(2, 9)}", f"{own(3, 9)} {short} {own(4, 9)}", f"{own(5, 9)} {long} {own(6, 9)}", f"{own(7, 9)} {long}", own(8, 90)]
    texts += [f"{own(9, 9)} {wide}", f"{own(10, 9)} {wide} {own(11, 9)}"]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    left = dict(pairs(corpus_pipeline.repeated_strings(spark, docs, SMALL)))
    assert len(short.encode()) < 260
    assert "p120" not in left[0] + left[1] and left[0].startswith(own(1, 30)) and left[1].endswith(own(4, 9)[2:])
    assert [left[i] for i in (2, 3, 4)] == [texts[i] for i in (2, 3, 4)]
    assert "漢" not in left[5] + left[6]


def test_contaminated_go(stages, tables):
    before, after = stages["decontamination"]
    bench = [(r.item_id, r.text) for r in tables.benchmark.collect()]
    clean = [d for d, n, h, _ in plain.contamination(pairs(before), bench) if not (h > 0 and 20 * h >= n)]
    assert sorted(r.doc_id for r in after.collect()) == sorted(clean)


def test_mix(stages):
    before, after = stages["source mix"]
    rows = after.collect()
    assert len(rows) == before.count()
    sizes = {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    target = plain.shares(sizes)
    for s in sizes:
        assert abs(sum(r.taken for r in rows if r.source == s) - target[s]) <= 0.5001


def test_run_is_the_stages(spark, stages):
    assert sorted(corpus_pipeline.run(spark, SMALL).collect()) == sorted(stages["source mix"][1].collect())
    assert corpus_pipeline.ORACLE_SQL is None


def test_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, clashing columns and empty tables pass through all stages."""
    rows = [(1, "a b c", "en", "s", 5), (1, "a b c", "en", "s", 5), (None, None, None, None, None), (2, "", "en", "t", 0), (3, "x " * 30_000, "en", None, 60_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs = docs.withColumns({c: F.lit(1) for c in ("score", "near", "hits", "left_text", "doc_key", "sid", "start")})
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for name, df in (("documents", docs), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/full/{name}.parquet")
        df.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    out = corpus_pipeline.run(spark, f"{tmp_path}/full")
    assert sorted(((r.doc_id, r["size"]) for r in out.collect()), key=repr) == [(1, 3), (2, 0), (3, 0), (None, 0)]
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
