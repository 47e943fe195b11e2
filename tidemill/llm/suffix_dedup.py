"""Suffix-array dedup: shard Burrows-Wheeler transforms, merged by refining an interleave.

Texts are byte strings; a byte is removed if a string of ``size`` bytes that
covers it also starts anywhere else, in the same text or another.

1. Windows that cannot recur are left out (``recurring.py``); what remains are
   pieces, one for each content, dealt to buckets by key. Equal strings of
   ``size`` bytes are in the same bucket. A key with too many different pieces
   for one bucket is looked up window by window instead, with partial sums.
2. A bucket's pieces are split into shards. The symbols of a shard are blocks of
   ``stride`` bytes, one starting at every byte, and the chain of a byte goes on
   ``stride`` bytes further; ``size`` is ``depth`` strides. The shard's suffixes
   are sorted once, to that depth, and give its transform: before each suffix
   stands the block that ends where it begins.
3. Transforms are merged in pairs. The interleave of two sorted lists starts as
   "all of one, then all of the other". Dealing it out by the preceding symbols,
   in order, sorts it one symbol deeper; after ``depth`` rounds it is final. No
   suffix is compared or sorted again. A place where neighbours first part in
   round k marks a common prefix of k - 1 symbols, so neighbours that never part
   share ``size`` bytes: a repeated interval.

Null texts are empty. Rows repeated in the input count as other places.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import recurring as rec
from tidemill.llm import rolling as R
from tidemill.llm.common import SPAN, merged, parts_for, prepared, ranges, texts_of, unused
from tidemill.llm.common import col as named
from tidemill.llm.phrase_dedup import with_spans

#: Bytes of the pieces in a bucket, and suffixes in a shard before the merges.
BUCKET_BYTES = 2_000_000
SHARD_SUFFIXES = 600_000
RESULT = "struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string,kept:binary>"


def stride_of(size: int, most: int = 128) -> int:
    """The largest divisor of ``size`` up to ``most``."""
    return max(s for s in range(1, min(size, most) + 1) if size % s == 0)


def stable_order(symbols: np.ndarray) -> np.ndarray:
    """The order that sorts ``symbols`` (under 2**32) and keeps ties as they are."""
    packed = (symbols.astype(R.U64) << R.U64(32)) | np.arange(len(symbols), dtype=R.U64)
    packed.sort()
    return (packed & R.U64(0xFFFFFFFF)).astype(np.int64)


@dataclass
class Transform:
    """Sorted suffixes: ``place`` of each (-1: the end of a chain), and the symbol before it (0: none)."""

    before: np.ndarray
    place: np.ndarray
    ends: int


def transform_of(symbol: np.ndarray, starts: np.ndarray, stops: np.ndarray, stride: int, depth: int) -> Transform:
    """The transform of some pieces. ``symbol[p]`` names the block at p; pieces reach from ``starts`` to ``stops``."""
    place = np.concatenate([np.arange(a, b - stride + 1) for a, b in zip(starts, stops, strict=True)])
    begin, stop = np.repeat(starts, stops - starts - stride + 1), np.repeat(stops, stops - starts - stride + 1)
    order = np.arange(len(place))
    for d in range(depth - 1, -1, -1):
        at = place + d * stride
        level = np.where(at + stride <= stop, symbol[np.minimum(at, len(symbol) - 1)], 0)
        order = order[stable_order(level[order])]
    before = np.where(place - stride >= begin, symbol[np.maximum(place - stride, 0)], 0)[order]
    # each chain ends after the last block that fits; the block before its end is that block
    chains = np.minimum(stride, stops - starts - stride + 1)
    last = np.concatenate([np.arange(b - stride - c + 1, b - stride + 1) for b, c in zip(stops, chains, strict=True)])
    return Transform(
        np.concatenate((symbol[last], before)).astype(np.uint32),
        np.concatenate((np.full(len(last), -1), place[order])),
        len(last),
    )


def merge(a: Transform, b: Transform, depth: int) -> tuple[Transform, np.ndarray]:
    """Both transforms as one, and the common prefix of each suffix with the one before it, in symbols (``depth`` at most)."""
    n, ends = len(a.place) + len(b.place), a.ends + b.ends
    from_b = np.zeros(n, bool)
    from_b[len(a.place) :] = True
    block = np.zeros(n, np.int32)
    common = np.full(n, depth, np.int8)
    common[0] = 0
    before = np.empty(n, np.uint32)
    for d in range(depth):
        before[~from_b], before[from_b] = a.before, b.before
        order = stable_order(before)
        symbol, source = before[order], block[order]
        from_b = from_b[order]
        parts = np.zeros(n, bool)
        parts[1:] = (symbol[1:] != symbol[:-1]) | (source[1:] != source[:-1])
        parts[1:ends] = False  # ends of chains are equal; those of a stand first
        from_b[:ends] = np.arange(ends) >= a.ends
        common[parts & (common == depth)] = d
        block = np.cumsum(parts, dtype=np.int32)
    before[~from_b], before[from_b] = a.before, b.before
    place = np.empty(n, np.int64)
    place[~from_b], place[from_b] = a.place, b.place
    return Transform(before, place, ends), common


def bucket_parts(rows: pd.DataFrame, size: int, shard_suffixes: int = SHARD_SUFFIXES) -> pd.DataFrame:
    """For every piece of a bucket, the spans covered by strings that recur in it."""
    stride = stride_of(size)
    depth = size // stride
    slab = R.bytes_of(list(rows["piece"]))
    bounds = slab.bounds
    hashes = R.Prefix(R.byte_values(slab.data)).windows(stride)
    by_hash = np.argsort(hashes)
    new = np.ones(len(hashes), np.uint32)
    new[1:] = hashes[by_hash[1:]] != hashes[by_hash[:-1]]
    symbol = np.empty(len(hashes), np.uint32)
    symbol[by_hash] = np.cumsum(new, dtype=np.uint32)  # from 1: 0 stands for the end
    del by_hash, new, hashes
    shards, at = [], 0
    while at < len(rows):
        to = max(at + 1, int(np.searchsorted(bounds, bounds[at] + shard_suffixes, side="right")) - 1)
        shards.append(transform_of(symbol, bounds[at:to], bounds[at + 1 : to + 1], stride, depth))
        at = to
    if len(shards) == 1:  # a merge with nothing tells the common prefixes
        shards.append(Transform(np.zeros(0, np.uint32), np.zeros(0, np.int64), 0))
    common = None
    while len(shards) > 1:
        merges = [merge(x, y, depth) for x, y in zip(shards[::2], shards[1::2], strict=False)]
        shards, common = [m[0] for m in merges] + shards[len(merges) * 2 :], merges[0][1]
    place, ends = shards[0].place, shards[0].ends
    same = common == depth
    same[: ends + 1] = False
    repeats = same.copy()
    repeats[:-1] |= same[1:]
    cover = np.zeros(bounds[-1] + 1, np.int64)
    hit = place[repeats]
    hit = hit[hit + size <= bounds[np.searchsorted(bounds, hit, side="right")]]  # shorter ones agree up to their end
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + size, -1)
    # a string lies within its piece, so runs that touch at a bound are split there
    flags = np.cumsum(cover[:-1]) > 0
    spans = []
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        x, y = ranges(flags[a:b])
        spans.append([{"a": i, "b": j} for i, j in zip(x.tolist(), y.tolist(), strict=True)])
    return pd.DataFrame({"key": rows["key"], "content": rows["content"], "part": spans})


def repeated_spans(texts: DataFrame, size: int = 400, gram: int | None = None) -> DataFrame:
    """``doc``, ``sig`` and the byte spans to remove, for texts that have any."""
    found = rec.recurring(rec.runs(texts, size, gram or max(1, size * 8 // 25), words=False), across_documents=False)
    groups = rec.contents(found)
    differing, hot = rec.split_by_heat(groups)
    _, buckets = parts_for(differing, F.col("at.last") - F.col("at.first") + F.lit(size - 1), BUCKET_BYTES)
    cut = rec.by_bucket(rec.pieces(texts, differing, size, words=False).dropDuplicates(["key", "content"]), buckets)
    parts = cut.mapInPandas(lambda batches: rec.in_buckets(batches, lambda rows: bucket_parts(rows, size)), f"key long, content long, part {SPAN}")
    if hot is not None:
        cut = rec.pieces(texts, hot, size, words=False).dropDuplicates(["key", "content"])
        parts = parts.unionByName(rec.by_window(cut, size, False, F.col("n") > 1))
    return rec.spans_of(found, groups, parts, size, F.col("n") > 1)


def _kept_bytes(text: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for raw, cuts in zip(text, spans, strict=True):
        raw = raw or b""
        a, b = merged(cuts)
        kept = b"".join(raw[x:y] for x, y in zip([0, *b], [*a, len(raw)], strict=True))
        out.append((len(raw), len(raw) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
    return pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeated(docs: DataFrame, size: int = 400, gram: int | None = None, id_col: str = "doc_id", text_col: str = "text", result: str = "dedup") -> DataFrame:
    """``docs`` with a struct column ``result``: byte counts, the kept bytes and their digest."""
    prepared(docs.sparkSession)
    spans = repeated_spans(texts_of(docs, id_col, text_col), size, gram)
    return with_spans(docs, spans, F.pandas_udf(_kept_bytes, RESULT), id_col, text_col, result)


def _long_enough(raw: bytes, spans, min_words: int, min_bytes: int) -> list[dict]:
    """The merged spans that have so many words, or so many bytes."""
    a, b = merged(spans)
    return [{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist(), strict=True) if y - x >= min_bytes or len(raw[x:y].split()) >= min_words]


def without_repeats(docs: DataFrame, size: int = 400, min_words: int = 0, min_bytes: int = 400, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated strings cut out of the text, and ``length_col``, if present, set anew.

    A repeated stretch stays if it has fewer than ``min_words`` words and fewer than
    ``min_bytes`` bytes; the latter is for scripts that set no spaces.
    """
    prepared(docs.sparkSession)
    (left,) = unused(docs, "left_text")

    def left_text(text: pd.Series, spans: pd.Series) -> pd.Series:
        long = pd.Series([_long_enough(raw or b"", cuts, min_words, min_bytes) for raw, cuts in zip(text, spans, strict=True)], dtype=object)
        return pd.Series([k.decode("utf-8", "ignore") for k in _kept_bytes(text, long)["kept"]], dtype=object)

    spans = repeated_spans(texts_of(docs, id_col, text_col), size)
    out = with_spans(docs, spans, F.pandas_udf(left_text, "string"), id_col, text_col, left)
    changed = {text_col: F.col(left), length_col: F.length(left).cast("long")}
    return out.select(*[changed[c].alias(c) if c in changed else named(c) for c in docs.columns])
