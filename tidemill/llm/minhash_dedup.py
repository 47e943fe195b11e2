"""Near-duplicate documents: one-permutation hashing, optimal densification, star edges.

1. A document's shingles are hashed once. The hash space is cut into bins; the
   least hash of each bin is the signature. An empty bin borrows from the first
   filled bin in an order of its own (optimal densification), so two signatures
   agree in each bin with the probability of the sets' similarity.
2. Documents with equal sets form one class and go on as one row.
3. Bands of the signature are bucketed. Each bucket links one member, drawn by a
   hash, with every other: a star, so pairs grow with members, not their square.
4. Candidate pairs pass a size bound and are confirmed on the full sets.
5. A star can miss two members that resemble each other and not its centre.
   Buckets whose members are still in several components get a second star around
   the member that shares the most buckets with the most others. What is then still open is searched exactly, across components
   only: shingles are ordered by rarity, a pair at the threshold shares one of
   the first fifth of both sets, and the places of the first shared shingle bound
   how much may follow. In a group of edited copies the edits are the rarest
   shingles, so copies too far apart are told by their places, not by comparison.

The default bands miss a pair at the threshold with a probability below 1e-7.
Null and empty texts have no shingles and are linked with nothing. A null id
counts as larger than any other. Repeated rows are in one class. Classes are told
by their sets and only named by ids, so rows that share an id, or have none, are
compared like any others; the one kept of a component is the first by id and text hash.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm import rolling as R
from tidemill.llm.common import NO_ID, besides, identity, prepared, stored, texts_of, unused
from tidemill.llm.common import col as named
from tidemill.llm.components import components

BINS, ROWS = 128, 4
_SHIFT = R.U64(64 - BINS.bit_length() + 1)
#: For each bin, the order in which it looks for a filled one.
_LENDERS = np.random.default_rng(7).permuted(np.tile(np.arange(BINS), (BINS, 1)), axis=1)
_SIGNED = "doc long, sig long, n long, set_a long, set_b long, bands array<long>"


def shingle_sets(texts: list[bytes], size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text (A-Z lower-cased)."""
    w = R.words_of(texts, lower=True)
    prefix = R.Prefix(w.hashes)
    all_windows = prefix.windows(size)
    out = []
    for lo, hi in zip(w.bounds[:-1], w.bounds[1:], strict=True):
        if hi - lo >= size:
            out.append(np.unique(all_windows[lo : hi - size + 1]))
        elif hi > lo:
            out.append(prefix.stretch(np.array([lo]), np.array([hi])))
        else:
            out.append(np.zeros(0, R.U64))
    return out


def signature(hashes: np.ndarray) -> np.ndarray:
    """The least hash of each bin of a sorted, non-empty set; empty bins borrow."""
    bins = (hashes >> _SHIFT).astype(np.int64)
    first = np.ones(len(bins), bool)
    first[1:] = bins[1:] != bins[:-1]
    least = np.zeros(BINS, R.U64)
    filled = np.zeros(BINS, bool)
    least[bins[first]], filled[bins[first]] = hashes[first], True
    empty = np.flatnonzero(~filled)
    if len(empty):
        order = _LENDERS[empty]
        least[empty] = least[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    bands = least.reshape(-1, ROWS)
    key = R.mixed(np.arange(1, len(bands) + 1, dtype=R.U64))
    for r in range(ROWS):
        key = R.mixed(key ^ bands[:, r])
    return key.view(np.int64)


def signed(texts: DataFrame, size: int) -> DataFrame:
    """Per text: its set's size and identity, and its band keys."""

    def scan(batches):
        for pdf in batches:
            for rows in R.slabs(zip(pdf["doc"], pdf["text"], pdf["sig"], strict=True)):
                out = []
                for (doc, _, sig), s in zip(rows, shingle_sets([r[1] for r in rows], size), strict=True):
                    if len(s):
                        a = int(s.sum(dtype=R.U64).view(np.int64))
                        b = int(R.mixed(s ^ R.U64(0x5BF03635DD2A1C4D)).sum(dtype=R.U64).view(np.int64))
                        out.append((doc, sig, len(s), a, b, band_keys(signature(s))))
                    else:
                        out.append((doc, sig, 0, 0, 0, []))
                yield pd.DataFrame(out, columns=["doc", "sig", "n", "set_a", "set_b", "bands"])

    return texts.mapInPandas(scan, _SIGNED)


def similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    left = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    right = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - common
    return pairs.join(left, "b").join(right, "a").filter(common * 100 >= union * percent).select("a", "b").distinct()


def _pairs(spokes: DataFrame, percent: int) -> DataFrame:
    """Centre and member of every spoke, the smaller number first, if their sizes allow the threshold."""
    a, b = F.least("n", "hub.n"), F.greatest("n", "hub.n")
    ends = spokes.filter((a * 100 >= b * percent) & (F.col("node") != F.col("hub.node")))
    return ends.select(F.least("node", "hub.node").alias("a"), F.greatest("node", "hub.node").alias("b")).distinct()


def _open(members: DataFrame, comps: DataFrame) -> DataFrame:
    """The members of buckets that hold several components, with their component and the bucket's weightiest member."""
    placed = members.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    centre = F.max(F.struct("weight", "node", "n")).alias("hub")
    still = placed.groupBy("bucket").agg(centre, F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
    return stored(placed.join(still.drop("low", "high"), "bucket"), "open-buckets")


def across(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs of ``nodes`` (``node, n, comp``) of different components that may reach the threshold; none that does is left out."""
    grams = nodes.join(sets, "node").select("node", "n", "comp", F.explode("shingles").alias("s"))
    shared = grams.groupBy("s").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    sorted_ = grams.join(shared, "s").groupBy("node", "n", "comp").agg(F.array_sort(F.collect_list(F.struct("df", "s"))).alias("g"))
    # shingles of one set alone come first; they take up places and match nothing
    alone = F.col("n") - F.size("g")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    first = sorted_.withColumn("alone", alone).withColumn("g", F.slice("g", 1, F.greatest(prefix - F.col("alone"), F.lit(0)).cast("int")))
    tokens = first.select("node", "n", "comp", F.posexplode("g").alias("at", "g"), "alone").select("node", "n", "comp", (F.col("at") + F.col("alone")).alias("at"), F.col("g.s").alias("s"))
    x, y = (tokens.select("s", *[F.col(c).alias(c + end) for c in ("node", "n", "comp", "at")]) for end in "xy")
    low, high = F.least("nx", "ny"), F.greatest("nx", "ny")
    follow = F.least(F.col("nx") - F.col("atx"), F.col("ny") - F.col("aty"))
    fits = (low * 100 >= high * percent) & (follow * (100 + percent) >= (F.col("nx") + F.col("ny")) * percent)
    met = x.join(y, "s").filter((F.col("compx") < F.col("compy")) & fits)
    return met.select(F.least("nodex", "nodey").alias("a"), F.greatest("nodex", "nodey").alias("b")).distinct()


def _sets_of(texts: DataFrame, members: DataFrame, size: int) -> DataFrame:
    def scan(batches):
        for pdf in batches:
            for rows in R.slabs(zip(pdf["node"], pdf["text"], strict=True)):
                sets = shingle_sets([r[1] for r in rows], size)
                yield pd.DataFrame({"node": [r[0] for r in rows], "shingles": [s.view(np.int64) for s in sets]})

    return texts.join(members, ["doc", "sig"]).dropDuplicates(["doc", "sig"]).select("node", "text").mapInPandas(scan, "node long, shingles array<long>")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", result: str = "near") -> DataFrame:
    """``docs`` with a struct column ``result``: ``n_shingles``, ``component_id``, ``kept``."""
    prepared(docs.sparkSession)
    texts = texts_of(docs, id_col, text_col)
    rows = stored(signed(texts, size), "signed")
    # ids may be missing or repeated, so a class is told by its set alone
    node = F.xxhash64("set_a", "set_b", "n").alias("node")
    classes = stored(
        rows.filter("n > 0").groupBy("set_a", "set_b", "n").agg(F.min(F.struct("doc", "sig")).alias("first"), F.min_by("bands", "doc").alias("bands"))
        .select(node, "n", "first", "bands"),
        "classes",
    )
    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))

    # the first in an order that all buckets share, so that those of a group choose alike
    drawn = F.min(F.struct(F.xxhash64("node").alias("h"), "node", "n")).alias("hub")
    hubs = banded.groupBy("bucket").agg(drawn, F.count(F.lit(1)).alias("size"), F.min("node").alias("low"), F.max("node").alias("high"))
    members = stored(banded.join(hubs.filter("low < high").drop("low", "high"), "bucket"), "bucket-members")
    tested = stored(_pairs(members, percent), "pairs")
    compared = classes.select("node", "first.doc", "first.sig").join(members.select("node").distinct(), "node", "left_semi")
    sets = stored(_sets_of(texts, compared, size), "sets")
    links = stored(similar(tested, sets, percent), "links")
    comps = components(links)
    # who shares the most buckets with the most others is closest to the middle of its group
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    members = stored(members.select("bucket", "node", "n").join(weights, "node"), "weighted-members")

    def widened(found: DataFrame) -> tuple[DataFrame, DataFrame]:
        fresh = stored(found.join(tested, ["a", "b"], "left_anti"), "pairs")
        more = stored(similar(fresh, sets, percent), "links")
        return tested.union(fresh), links if more.isEmpty() else links.union(more)

    placed = _open(members, comps)
    hub_comp = comps.select(F.col("node").alias("hub_node"), F.col("comp").alias("hub_comp"))
    apart = placed.join(hub_comp, F.col("hub.node") == F.col("hub_node"), "left").filter(F.col("comp") != F.coalesce("hub_comp", "hub.node"))
    tested, now = widened(_pairs(apart, percent))
    if now is not links:
        links, comps = now, components(now)
        placed = _open(members, comps)
    _, now = widened(across(placed.select("node", "n", "comp").distinct(), sets, percent))
    if now is not links:
        comps = components(now)
    # only now the ids: a component is named after its first document
    linked = stored(classes.select("node", "first").join(comps, "node"), "linked")
    tops = linked.groupBy("comp").agg(F.min("first").alias("top"))
    tops = stored(linked.select("node", "comp").join(tops, "comp").select("node", "top"), "tops")
    by_class = classes.select("node", "first").join(tops, "node", "left").select("node", F.coalesce("top", "first").alias("top"))
    sized = rows.select("doc", "sig", "n", node).dropDuplicates(["doc", "sig"])
    own = F.struct("doc", "sig")
    placed = sized.join(by_class, "node", "left").withColumn("top", F.coalesce("top", own))
    placed = placed.select("doc", "sig", "n", F.col("top.doc").alias("component"), (F.col("top") == own).alias("kept"))
    return with_classes(docs, placed, id_col, text_col, result)


def deduplicated(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each class of near-duplicates, and one of repeated rows."""
    (near,) = unused(docs, "near")
    kept = near_duplicates(docs, size, percent, id_col, text_col, near).filter(F.col(near)["kept"]).drop(near)
    ids = docs.groupBy(identity(docs, id_col).alias("doc")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    # texts are only shuffled by id where ids repeat at all
    return kept if ids.isEmpty() else kept.dropDuplicates([id_col, text_col])


def with_classes(docs: DataFrame, placed: DataFrame, id_col: str, text_col: str, result: str) -> DataFrame:
    doc, sig, out = unused(docs, "doc_key", "text_sig", result)
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    left = docs.withColumns({doc: identity(docs, id_col), sig: F.xxhash64(text)})
    value = F.struct(
        F.col("n").alias("n_shingles"),
        F.when(F.col("component") != NO_ID, F.col("component")).alias("component_id"),
        "kept",
    )
    right = placed.select(F.col("doc").alias(doc), F.col("sig").alias(sig), value.alias(out))
    return left.join(right, [doc, sig]).select(*besides(docs, result), F.col(out).alias(result))
