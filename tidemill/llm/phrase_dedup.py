"""Substring dedup by automata of repeated phrases.

A window is ``window`` consecutive words. Words are removed where a window
covers them whose word sequence also starts in a document with a smaller id.

1. Candidate phrases: each window names its least k-gram of words. A phrase
   named in two documents is confirmed; a window whose phrase is named in one
   document only cannot recur.
2. The passages around confirmed phrases go to shards by phrase. Passages with
   one content were merged before, so a passage that a third of all documents
   share is one row there.
3. Each shard compiles its phrases into an Aho-Corasick automaton over word
   numbers and streams its passages through it. Every hit locates the windows
   that hold the phrase; equal windows meet, and the smallest id owns them.
   A phrase with too many different passages for one shard is looked up window
   by window instead, with partial sums.
4. The spans go back to the documents by id.

Nulls and empty texts have no words. A null id counts as larger than any other.
Rows with equal ids never remove each other's words. Other columns stay as
they are, whatever their names.
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import recurring as rec
from tidemill.llm import rolling as R
from tidemill.llm.common import SPAN, besides, identity, merged, parts_for, prepared, ranges, texts_of, unused
from tidemill.llm.common import col as named

#: Words in one shard's passages.
SHARD_WORDS = 200_000
RESULT = "struct<n_words:long,n_removed:long,kept_sha256:string,kept:string>"


def shard_parts(rows: pd.DataFrame, window: int, gram: int) -> pd.DataFrame:
    """For every passage of a shard, the spans whose windows have an earlier owner."""
    w = R.words_of(list(rows["piece"]))
    bounds, owner = w.bounds, rows["owner"].to_numpy(np.int64)
    key = rows["key"].to_numpy(np.int64).view(R.U64)
    _, number = np.unique(w.hashes, return_inverse=True)  # words as small numbers, as the automaton takes 32 bits
    prefix = R.Prefix(w.hashes)
    grams = prefix.windows(gram)
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for i in np.unique(key, return_index=True)[1]:
        at = bounds[i] + np.flatnonzero(grams[bounds[i] : bounds[i + 1] - gram + 1] == key[i])[0]
        automaton.add_word(tuple(number[at : at + gram].tolist()), int(i))
    automaton.make_automaton()
    found_at, found_in = [], []
    for i in range(len(rows)):
        lo, hi = bounds[i], bounds[i + 1] - window + 1
        located = np.zeros(hi - lo + 1, np.int64)
        for end, _ in automaton.iter(tuple(number[lo : bounds[i + 1]].tolist())):
            a, b = max(0, end - window + 1), min(hi - lo, end - gram + 2)
            if a < b:
                located[a] += 1
                located[b] -= 1
        at = lo + np.flatnonzero(np.cumsum(located[:-1]) > 0)
        found_at.append(at)
        found_in.append(np.full(len(at), i))
    at, of = np.concatenate(found_at), np.concatenate(found_in)
    whole = prefix.stretch(at, at + window)
    order = np.lexsort((owner[of], whole))
    first = np.ones(len(order), bool)
    first[1:] = whole[order[1:]] != whole[order[:-1]]
    least = owner[of[order]][np.flatnonzero(first)][np.cumsum(first) - 1]
    taken = least < owner[of[order]]
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    hit = at[order[taken]]
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + window, -1)
    a, b = ranges(np.cumsum(cover[:-1]) > 0)
    # a covered run may pass from one passage into the next: cut it at the passages' bounds
    cut_a = np.unique(np.concatenate((a, bounds[:-1][np.searchsorted(a, bounds[:-1], side="right") > np.searchsorted(b, bounds[:-1], side="right")])))
    ends = np.sort(np.concatenate((b, bounds[1:])))
    cut_b = ends[np.searchsorted(ends, cut_a, side="right")]
    of = np.searchsorted(bounds, cut_a, side="right") - 1
    spans = [[] for _ in range(len(rows))]
    for i, x, y in zip(of.tolist(), (cut_a - bounds[of]).tolist(), (cut_b - bounds[of]).tolist(), strict=True):
        spans[i].append({"a": x, "b": y})
    return pd.DataFrame({"key": rows["key"], "content": rows["content"], "part": spans})


def repeated_spans(texts: DataFrame, window: int = 50, gram: int = 16) -> DataFrame:
    """``doc``, ``sig`` and the word spans to remove, for texts that have any."""
    found = rec.recurring(rec.runs(texts, window, gram, words=True), across_documents=True)
    groups = rec.contents(found)
    differing, hot = rec.split_by_heat(groups)
    _, shards = parts_for(differing, F.col("at.last") - F.col("at.first") + F.lit(window - 1), SHARD_WORDS)
    cut = rec.by_bucket(rec.pieces(texts, differing, window, words=True), shards)
    parts = cut.mapInPandas(lambda batches: rec.in_buckets(batches, lambda rows: shard_parts(rows, window, gram)), f"key long, content long, part {SPAN}")
    parts = parts.dropDuplicates(["key", "content"])
    if hot is not None:
        parts = parts.unionByName(rec.by_window(rec.pieces(texts, hot, window, words=True), window, True, F.col("least") < F.col("owner")))
    return rec.spans_of(found, groups, parts, window, F.col("doc") > F.col("owner"))


def _kept_words(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for raw, cuts in zip(text, spans, strict=True):
        words = (raw or b"").split()
        a, b = merged(cuts)
        left, at = [], 0
        for x, y in zip(a, b, strict=True):
            left += words[at:x]
            at = y
        left += words[at:]
        kept = b" ".join(left)
        out.append((len(words), len(words) - len(left), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "replace")))
    return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeated(docs: DataFrame, window: int = 50, gram: int = 16, id_col: str = "doc_id", text_col: str = "text", result: str = "dedup") -> DataFrame:
    """``docs`` with a struct column ``result``: word counts, the kept words and their digest."""
    prepared(docs.sparkSession)
    spans = repeated_spans(texts_of(docs, id_col, text_col), window, gram)
    return with_spans(docs, spans, F.pandas_udf(_kept_words, RESULT), id_col, text_col, result)


def with_spans(docs: DataFrame, spans: DataFrame, keep, id_col: str, text_col: str, result: str) -> DataFrame:
    """Bring spans back to the rows of ``docs`` and apply ``keep`` to texts and spans."""
    doc, sig, cuts, out = unused(docs, "doc_key", "text_sig", "cuts", result)
    text: Column = F.coalesce(named(text_col).cast("string"), F.lit(""))
    left = docs.withColumns({doc: identity(docs, id_col), sig: F.xxhash64(text)})
    right = spans.select(F.col("doc").alias(doc), F.col("sig").alias(sig), F.col("spans").alias(cuts))
    joined = left.join(right, [doc, sig], "left").withColumn(out, keep(text.cast("binary"), F.col(cuts)))
    return joined.select(*besides(docs, result), F.col(out).alias(result))
