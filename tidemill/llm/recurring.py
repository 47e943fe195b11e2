"""Where windows of a fixed size may recur: runs of windows, by their least k-gram.

Every window of every text gets the least hash of its k-grams as a key, so
equal windows have equal keys wherever they stand. Neighbouring windows that
share a key form a run; a text has one run for some tens of words or some
hundreds of bytes. A run whose key occurs nowhere else holds no recurring
window. This leaves out most of the corpus without looking at a window twice,
and never a recurring one.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import prepared, stored

RUNS = "key long, content long, doc long, sig long, first long, last long, again boolean"
#: A key with more contents is not given to one task.
HOT_CONTENTS = 4096
PIECES = "key long, content long, owner long, piece binary"


def _units(texts: list[bytes], words: bool):
    slab = R.words_of(texts) if words else R.bytes_of(texts)
    return slab, R.Prefix(slab.hashes if words else R.byte_values(slab.data))


def runs(texts: DataFrame, window: int, gram: int, words: bool) -> DataFrame:
    """The runs of every text; ``first`` and ``last`` count windows from its start."""

    def scan(batches):
        for pdf in batches:
            for rows in R.slabs(zip(pdf["doc"], pdf["text"], pdf["sig"], strict=True)):
                slab, prefix = _units([r[1] for r in rows], words)
                found = R.window_runs(prefix, slab.bounds, window, gram, repeats=not words)
                if not len(found.key):
                    continue
                at = slab.bounds[found.text]
                yield pd.DataFrame({
                    "key": found.key.view(np.int64),
                    "content": found.content.view(np.int64),
                    "doc": np.array([r[0] for r in rows], np.int64)[found.text],
                    "sig": np.array([r[2] for r in rows], np.int64)[found.text],
                    "first": found.first - at,
                    "last": found.last - at,
                    "again": found.again,
                })

    return texts.mapInPandas(scan, RUNS)


def recurring(found: DataFrame, across_documents: bool) -> DataFrame:
    """The runs whose key recurs, with ``differ``: whether their contents do.

    ``across_documents`` asks for two documents; else two places will do. The
    keys are counted with partial sums before the shuffle, and the runs meet
    them in a join whose large keys adaptive execution can split.
    """
    keys = found.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("doc").alias("d0"),
        F.max("doc").alias("d1"),
        F.max("again").alias("again"),
        F.min("content").alias("c0"),
        F.max("content").alias("c1"),
    )
    enough = F.col("d0") < F.col("d1") if across_documents else (F.col("n") > 1) | F.col("again")
    differ = F.col("c0") != F.col("c1")
    keys = keys.filter(enough).select("key", (differ if across_documents else differ | F.col("again")).alias("differ"))
    return stored(found.drop("again").join(keys, "key"), "recurring-runs")


def contents(runs_found: DataFrame) -> DataFrame:
    """One row per key and content: how often, and its first place."""
    return runs_found.groupBy("key", "content", "differ").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc", "sig", "first", "last")).alias("at")
    )


def pieces(texts: DataFrame, groups: DataFrame, window: int, words: bool) -> DataFrame:
    """The bytes of one place of every content, cut from the texts."""
    wanted = (
        groups.select(F.col("at.doc").alias("doc"), F.col("at.sig").alias("sig"), F.struct("key", "content", "at.first", "at.last").alias("w"))
        .groupBy("doc", "sig")
        .agg(F.collect_list("w").alias("wanted"))
    )
    found = texts.join(wanted, ["doc", "sig"])

    def cut(batches):
        for pdf in batches:
            for rows in R.slabs(zip(pdf["doc"], pdf["text"], pdf["wanted"], strict=True)):
                out = []
                if words:
                    w = R.words_of([r[1] for r in rows])
                    flat = w.data.tobytes()
                for i, (doc, text, wants) in enumerate(rows):
                    base = w.bounds[i] if words else 0
                    for x in wants:
                        a, b = base + x["first"], base + x["last"] + window - 1
                        out.append((x["key"], x["content"], doc, flat[w.start[a] : w.end[b - 1]] if words else text[a:b]))
                yield pd.DataFrame(out, columns=["key", "content", "owner", "piece"])

    return found.mapInPandas(cut, PIECES)


def by_bucket(cut: DataFrame, buckets: int) -> DataFrame:
    """Pieces dealt out by key; the pieces of a bucket arrive one after another."""
    bucket = F.pmod(F.xxhash64("key"), F.lit(buckets))
    return cut.withColumn("bucket", bucket).repartition(buckets, "bucket").sortWithinPartitions("bucket", "key", "content")


def in_buckets(batches, work):
    """Call ``work`` with all rows of each bucket, as they end."""
    held, current = [], None
    for pdf in batches:
        if pdf.empty:
            continue
        starts = np.flatnonzero(np.diff(pdf["bucket"].to_numpy())) + 1
        for part in np.split(np.arange(len(pdf)), starts):
            rows = pdf.iloc[part]
            if current is not None and rows["bucket"].iat[0] != current:
                yield work(pd.concat(held, ignore_index=True))
                held = []
            current = rows["bucket"].iat[0]
            held.append(rows)
    if held:
        yield work(pd.concat(held, ignore_index=True))


def split_by_heat(groups: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """The groups whose contents differ: of keys that one task can take whole, and of hotter keys (none: null)."""
    differing = groups.filter("differ")
    hot = differing.groupBy("key").agg(F.count(F.lit(1)).alias("contents")).filter(F.col("contents") > HOT_CONTENTS).select("key")
    if hot.isEmpty():
        return differing, None
    return differing.join(hot, "key", "left_anti"), differing.join(hot, "key")


def by_window(cut: DataFrame, window: int, words: bool, taken: Column) -> DataFrame:
    """``key, content, part`` for pieces of hot keys, window by window.

    Equal windows meet by their hash within a key, counted with partial sums, so
    no task holds a key whole. ``taken`` is a condition on ``n`` (places of the
    window), ``least`` (its smallest owner) and ``owner``.
    """

    def scan(batches):
        for pdf in batches:
            for rows in R.slabs(zip(pdf["key"], pdf["piece"], pdf["content"], pdf["owner"], strict=True)):
                slab, prefix = _units([r[1] for r in rows], words)
                n = np.diff(slab.bounds) - window + 1
                of = np.repeat(np.arange(len(rows)), n)
                at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                start = slab.bounds[of] + at
                column = lambda i: np.array([r[i] for r in rows], np.int64)[of]  # noqa: B023, E731
                whole = prefix.stretch(start, start + window).view(np.int64)
                yield pd.DataFrame({"key": column(0), "content": column(2), "owner": column(3), "at": at, "whole": whole})

    each = cut.mapInPandas(scan, "key long, content long, owner long, at long, whole long")
    met = each.groupBy("key", "whole").agg(F.count(F.lit(1)).alias("n"), F.min("owner").alias("least"))
    hit = each.join(met.hint("merge"), ["key", "whole"]).filter(taken)  # windows are far more than the pieces they are estimated from
    return hit.groupBy("key", "content").agg(F.collect_set(F.struct(F.col("at").alias("a"), (F.col("at") + F.lit(window)).alias("b"))).alias("part"))


def spans_of(runs_found: DataFrame, groups: DataFrame, parts: DataFrame, window: int, whole: Column) -> DataFrame:
    """The spans of every text that has any.

    ``whole`` says for a run and its group that all of the run counts; other
    runs get the ``part`` of their content, which counts from the run's start.
    """
    held = groups.select("key", "content", "n", F.col("at.doc").alias("owner")).join(parts, ["key", "content"], "left")
    moved = F.transform("part", lambda s: F.struct((s.a + F.col("first")).alias("a"), (s.b + F.col("first")).alias("b")))
    full = F.array(F.struct(F.col("first").alias("a"), (F.col("last") + F.lit(window - 1)).alias("b")))
    return (
        runs_found.drop("differ")
        .join(held, ["key", "content"])
        .select("doc", "sig", F.explode(F.when(whole, full).otherwise(moved)).alias("s"))
        .groupBy("doc", "sig")
        .agg(F.collect_set("s").alias("spans"))
    )


__all__ = ["PIECES", "RUNS", "by_bucket", "by_window", "contents", "in_buckets", "pieces", "prepared", "recurring", "runs", "spans_of", "split_by_heat"]
