"""Benchmark decontamination by a prefix-filtered set join.

Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
lower-cased. A window is ``window`` consecutive words of a benchmark item (all
of a shorter one). A document word inside an occurrence of a window is hit.

1. Windows are sets of shingles (short word sequences with their place). A
   first pass over the documents counts in how many each benchmark shingle
   occurs, which orders the shingles by rarity.
2. A window can only occur in a document that has all of its shingles. Of sets
   that must be contained whole, a prefix of one token is enough: the rarest. A
   window with a shingle of no document is dropped at once.
3. A second pass joins the documents' shingles with the prefix tokens. The
   place of the token in the window bounds where the window would begin and
   end; candidates that leave the document go. The others are verified word by
   word over the window's full length.

The benchmark is the stated query set. It is taken in blocks of about
``BLOCK_BYTES`` bytes (of whole items), each small enough to be sent to every
task; documents are never shuffled. More items mean more passes.

Null texts have no words. An item without an id hits words but is not listed.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import besides, parts_for, prepared, ranges, unused
from tidemill.llm.common import col as named

BLOCK_BYTES = 4_000_000
SHINGLE = 3
_FILTER_BITS = 22
RESULT = "struct<n_words:long,spans:array<struct<a:long,b:long>>,items:array<string>>"


@dataclass
class Block:
    """Distinct windows, as rows of word hashes, with their items; and their prefix tokens by shingle size."""

    words: list[np.ndarray]
    whole: np.ndarray
    items: list[list[str]]
    tokens: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def windows_of(items: list[tuple[str | None, bytes]], window: int) -> tuple[list[np.ndarray], list[list[str]]]:
    """The distinct windows of some items, and who has them."""
    w = R.words_of([t for _, t in items], R.ALPHANUMERIC, lower=True)
    seen: dict[bytes, set] = {}
    for (item, _), lo, hi in zip(items, w.bounds[:-1], w.bounds[1:], strict=True):
        size = min(window, hi - lo)
        for at in range(lo, hi - size + 1) if size else ():
            seen.setdefault(w.hashes[at : at + size].tobytes(), set()).add(item)
    return [np.frombuffer(k, R.U64) for k in seen], [sorted(x for x in v if x is not None) for v in seen.values()]


def shingles(words: np.ndarray) -> tuple[int, np.ndarray]:
    """The shingle size that suits a window, and its shingles in place."""
    size = min(SHINGLE, len(words))
    return size, R.Prefix(words).windows(size)


def block_of(windows, items, frequency: dict[tuple[int, int], int]) -> Block:
    """Order every window's shingles by rarity and index it by the rarest."""
    chosen: dict[int, list[tuple[int, int, int]]] = {}
    for i, words in enumerate(windows):
        size, tokens = shingles(words)
        counts = [frequency.get((size, t), 0) for t in tokens.tolist()]
        if min(counts) > 0:
            place = int(np.argmin(counts))
            chosen.setdefault(size, []).append((int(tokens[place]), i, place))
    tokens = {}
    for size, rows in chosen.items():
        rows.sort()
        token = np.array([r[0] for r in rows], R.U64)
        keys, first = np.unique(token, return_index=True)
        tokens[size] = (keys, np.append(first, len(rows)), np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    whole = np.array([R.Prefix(w).stretch(np.array([0]), np.array([len(w)]))[0] for w in windows], R.U64)
    return Block(windows, whole, items, tokens)


def gate_of(keys: np.ndarray) -> np.ndarray:
    """A table over the leading bits that lets through all ``keys`` and little else."""
    gate = np.zeros(1 << _FILTER_BITS, bool)
    gate[keys >> R.U64(64 - _FILTER_BITS)] = True
    return gate


def found_among(hashes: np.ndarray, keys: np.ndarray, gate: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``hashes`` has one of the sorted ``keys``, and which."""
    at = np.flatnonzero(gate[hashes >> R.U64(64 - _FILTER_BITS)])
    which = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
    hit = keys[which] == hashes[at]
    return at[hit], which[hit]


def document_frequency(texts: DataFrame, keys: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """In how many texts each shingle occurs; ``keys`` holds one block's sorted shingles by size."""

    def scan(batches):
        gates = {size: gate_of(k) for size, k in keys.items()}
        counts = {size: np.zeros(len(k), np.int64) for size, k in keys.items()}
        for pdf in batches:
            for rows in R.slabs(((0, t) for t in pdf["text"])):
                w = R.words_of([r[1] for r in rows], R.ALPHANUMERIC, lower=True)
                prefix = R.Prefix(w.hashes)
                for size, k in keys.items():
                    at, which = found_among(prefix.windows(size), k, gates[size])
                    of = np.searchsorted(w.bounds, at, side="right") - 1
                    inside = at + size <= w.bounds[of + 1]
                    each = np.unique(of[inside] * len(k) + which[inside]) % len(k)
                    np.add.at(counts[size], each, 1)
        for size, c in counts.items():
            at = np.flatnonzero(c)
            yield pd.DataFrame({"size": np.full(len(at), size), "token": keys[size][at].view(np.int64), "n": c[at]})

    rows = texts.mapInPandas(scan, "size int, token long, n long").groupBy("size", "token").agg(F.sum("n").alias("n")).collect()
    return {(r["size"], r.token & (2**64 - 1)): r.n for r in rows}  # one row per benchmark shingle of the block


def hits_in(texts: list[bytes], block: Block, gates: dict[int, np.ndarray]) -> list[tuple[int, list, list]]:
    """For each text: its words, the hit spans and the items."""
    w = R.words_of(texts, R.ALPHANUMERIC, lower=True)
    prefix = R.Prefix(w.hashes)
    starts, wins = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for size, (keys, first, window, place) in block.tokens.items():
        at, which = found_among(prefix.windows(size), keys, gates[size])
        many = first[which + 1] - first[which]
        if not many.sum():
            continue
        entry = np.repeat(first[which] - np.cumsum(many) + many, many) + np.arange(many.sum())
        starts.append(np.repeat(at, many) - place[entry])
        wins.append(window[entry])
    start, win = np.concatenate(starts), np.concatenate(wins)
    length = np.array([len(x) for x in block.words], np.int64)[win] if len(win) else win
    inside = start >= 0
    start, win, length = start[inside], win[inside], length[inside]
    of = np.searchsorted(w.bounds, start, side="right") - 1
    fits = start + length <= w.bounds[np.minimum(of + 1, len(texts))]
    start, win, length, of = start[fits], win[fits], length[fits], of[fits]
    equal = prefix.stretch(start, start + length) == block.whole[win] if len(win) else np.zeros(0, bool)
    start, win, length, of = start[equal], win[equal], length[equal], of[equal]
    exact = np.array([np.array_equal(w.hashes[s : s + n], block.words[x]) for s, n, x in zip(start, length, win, strict=True)], bool)
    start, win, length, of = start[exact], win[exact], length[exact], of[exact]
    cover = np.zeros(len(w.hashes) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, start + length, -1)
    cover = np.cumsum(cover[:-1]) > 0
    items: dict[int, set] = {}
    for d, x in set(zip(of.tolist(), win.tolist(), strict=True)):
        items.setdefault(d, set()).update(block.items[x])
    out = []
    for i, (lo, hi) in enumerate(zip(w.bounds[:-1].tolist(), w.bounds[1:].tolist(), strict=True)):
        if i in items:
            a, b = ranges(cover[lo:hi])
            out.append((hi - lo, [{"a": x, "b": y} for x, y in zip(a.tolist(), b.tolist(), strict=True)], sorted(items[i])))
        else:
            out.append((hi - lo, [], []))
    return out


def matcher(block: Block):
    def match(texts: pd.Series) -> pd.DataFrame:
        gates = {size: gate_of(t[0]) for size, t in block.tokens.items()}
        out = []
        for rows in R.slabs(((0, t or b"") for t in texts)):
            out += hits_in([r[1] for r in rows], block, gates)
        return pd.DataFrame(out, columns=["n_words", "spans", "items"])

    return F.pandas_udf(match, RESULT)


def union_of(spans: Column) -> Column:
    """How many places the spans of an array cover together."""
    least = F.lit(0).cast("long")
    start = F.struct(least.alias("n"), least.alias("upto"))
    step = lambda s, x: F.struct((s.n + F.greatest(x.b - F.greatest(x.a, s.upto), least)).alias("n"), F.greatest(s.upto, x.b).alias("upto"))
    return F.aggregate(F.array_sort(spans), start, step, lambda s: s.n)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text", result: str = "hits", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with a struct column ``result``: ``n_words``, ``n_hit``, ``spans`` (of words), ``items`` (sorted)."""
    prepared(docs.sparkSession)
    text = F.coalesce(named(text_col).cast("string"), F.lit("")).cast("binary")
    queries = benchmark.select(F.col("item_id").cast("string").alias("item"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")).distinct()
    _, blocks = parts_for(queries, F.length("text"), block_bytes)
    out, hits = docs, []
    for i in range(blocks):
        rows = queries.filter(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == i).collect()  # bounded by block_bytes
        windows, items = windows_of([(r.item, bytes(r.text)) for r in rows], window)
        keys: dict[int, list] = {}
        for x in windows:
            size, tokens = shingles(x)
            keys.setdefault(size, []).append(tokens)
        known = {size: np.unique(np.concatenate(t)) for size, t in keys.items()}
        frequency = document_frequency(docs.select(text.alias("text")), known) if known else {}
        (name,) = unused(out, "block_hits")
        out = out.withColumn(name, matcher(block_of(windows, items, frequency))(text))
        hits.append(F.col(name))
    spans = F.array_sort(F.flatten(F.array(*[h["spans"] for h in hits])))
    items = F.array_sort(F.array_distinct(F.flatten(F.array(*[h["items"] for h in hits]))))
    value = F.struct(hits[0]["n_words"].alias("n_words"), union_of(spans).alias("n_hit"), spans.alias("spans"), items.alias("items"))
    return out.select(*besides(docs, result), value.alias(result))


def contaminated(hits: str = "hits", one_in: int = 20) -> Column:
    """At least one word in ``one_in`` is hit."""
    h = F.col(hits)
    return (h["n_hit"] > 0) & (h["n_hit"] * one_in >= h["n_words"])


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 13, text_col: str = "text") -> DataFrame:
    """Documents that aren't contaminated."""
    (hits,) = unused(docs, "hits")
    return contamination(docs, benchmark, window, text_col, hits).filter(~contaminated(hits)).drop(hits)
