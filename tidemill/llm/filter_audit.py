"""How filters act together: survival words, counted by carry-save adders.

Five filters give 32 subsets. A document's survival word has a bit for each
subset, set if the document passes all filters of the subset. Added up bit by
bit over the documents of a part (a positional popcount), the words tell how
many survive any subset, and so what every filter removes in every order of the
five: survivors before it less survivors after it.

1. One row per document with the filters that it fails. Filter E, "same text as a
   smaller id", needs the least id of every text: texts are grouped by digest, with
   partial sums, and rows look up the least id. Digests that hold more than a
   thousandth of the rows are at most a thousand; they are looked up by broadcast,
   the others by a shuffle, so no group of copies meets in one task.
2. Rows look up their labels by id.
3. Each batch adds up its words for each part and label with carry-save adders: of
   three words of a weight, one word of sums stays at this weight and one word of
   carries goes on to the next, until each weight holds two words at most. All parts
   of a batch are added at once. Counts of batches are added up by Spark.
4. Every part gives one row for each order and step, from its 32 counts.

Null texts are empty. A null part and an empty one are the same part. A null id is
larger than any other and has no labels. Rows with equal id and text don't remove
each other, as neither id is smaller; each counts as a document. A document is
good or toxic if any of its label rows says so. Without documents, no rows.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import NO_ID, identity, prepared, stored
from tidemill.llm.common import col as named

NAMES = "ABCDE"
SUBSETS = 1 << len(NAMES)
#: A digest with more than this share of all rows is looked up by broadcast; there are fewer such digests than this.
HOT_SHARE = 1000
#: Words of which group are added up: all documents, good ones, toxic ones.
ALL, GOOD, TOXIC = 0, 1, 2
STEPS = (
    "part string, filter_order string, step int, filter string, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def words_in(text: Column) -> Column:
    """The maximal runs of anything but space and \\t \\n \\v \\f \\r, as an array."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def failures(text: Column, words: Column) -> Column:
    """Bits 0 to 3: the document fails filter A, B, C, D. ``words`` are the words of ``text``."""
    n = F.size(words)
    capitals = F.regexp_count(text, F.lit("[A-Z]"))
    failed = [
        n < 50,
        F.size(F.array_distinct(words)) * 100 < n * 65,
        capitals.cast("long") * 100 > F.length(text).cast("long") * 5,
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((f.cast("int") * (1 << i) for i, f in enumerate(failed)), F.lit(0))


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc, part, failed`` of every row: bits 0 to 4 are the filters it fails."""
    prepared(docs.sparkSession)
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    rows = docs.select(identity(docs, id_col).alias("doc"), F.coalesce(named(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("words", words_in(F.col("text")))
    rows = stored(rows.select("doc", "part", F.unhex(F.sha2("text", 256)).alias("digest"), failures(F.col("text"), F.col("words")).alias("failed")), "judged-alone")
    total = rows.count()
    again = stored(rows.groupBy("digest").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "copies")
    is_hot = F.col("n") * HOT_SHARE > total
    hot = again.filter(is_hot).select("digest", F.col("least").alias("hot_least"))  # fewer than HOT_SHARE rows
    cold = again.filter(~is_hot).select("digest", F.lit(0).alias("salt"), "least")
    marked = rows.join(F.broadcast(hot), "digest", "left")
    marked = marked.withColumn("salt", F.when(F.col("hot_least").isNotNull(), F.lit(1) + F.pmod(F.xxhash64("doc"), F.lit(1 << 20))).otherwise(0).cast("int"))
    met = marked.join(cold, ["digest", "salt"], "left")
    copy = F.coalesce(F.col("doc") > F.coalesce("hot_least", "least"), F.lit(False))
    return met.select("doc", "part", (F.col("failed") + copy.cast("int") * 16).alias("failed"))


def survival_word(failed: np.ndarray) -> np.ndarray:
    """The 32-bit word of every set of failures: bit s is set if subset s holds none of them."""
    subsets = np.arange(SUBSETS)
    table = np.array([sum(1 << int(s) for s in subsets if not s & f) for f in range(SUBSETS)], np.uint32)
    return table[failed]


def positional_popcounts(words: np.ndarray, group: np.ndarray, groups: int) -> np.ndarray:
    """How often each bit is set in the words of each group (rising in ``group``): an array of groups x 32."""
    counts = np.zeros((groups, 32), np.int64)
    weight = 1
    while len(words):
        carries, of = [], []
        while True:  # three words of a weight become one sum of this weight and one carry of the next
            size = np.bincount(group, minlength=groups)
            thirds = size // 3
            if not thirds.any():
                break
            start = np.cumsum(size) - size
            rank = np.arange(len(words)) - start[group]
            third = thirds[group]
            first = rank < third
            at = np.flatnonzero(first)
            step = third[at]
            a, b, c = words[at], words[at + step], words[at + 2 * step]
            half = a ^ b
            carries.append((a & b) | (half & c))
            of.append(group[at])
            rest = rank >= 3 * third
            words, group = np.concatenate((half ^ c, words[rest])), np.concatenate((group[at], group[rest]))
            order = np.argsort(group, kind="stable")
            words, group = words[order], group[order]
        bits = (words[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        np.add.at(counts, group, bits.astype(np.int64) * weight)
        words = np.concatenate([np.zeros(0, np.uint32), *carries])
        group = np.concatenate([np.zeros(0, np.int64), *of]).astype(np.int64)
        order = np.argsort(group, kind="stable")
        words, group = words[order], group[order]
        weight *= 2
    return counts


def survivors(rows: DataFrame) -> DataFrame:
    """``part, label, n``: the 32 counts of survivors, by ``failed``, ``good`` and ``toxic`` of the rows."""

    def add_up(batches):
        for pdf in batches:
            words = survival_word(pdf["failed"].to_numpy())
            code, parts = pd.factorize(pdf["part"])
            good, toxic = pdf["good"].to_numpy(bool), pdf["toxic"].to_numpy(bool)
            group = np.concatenate((code * 3 + ALL, code[good] * 3 + GOOD, code[toxic] * 3 + TOXIC))
            order = np.argsort(group, kind="stable")
            n = positional_popcounts(np.concatenate((words, words[good], words[toxic]))[order], group[order], 3 * len(parts))
            yield pd.DataFrame({"part": np.repeat(np.asarray(parts, object), 3), "label": np.tile([ALL, GOOD, TOXIC], len(parts)), "n": list(n)})

    found = rows.select("part", "failed", "good", "toxic").mapInPandas(add_up, "part string, label int, n array<long>")
    return found.groupBy("part", "label").agg(F.array(*[F.sum(F.col("n")[s]) for s in range(SUBSETS)]).alias("n"))


def by_order(counts: DataFrame) -> DataFrame:
    """One row per part, order and step, from the counts of survivors of each part."""
    orders = ["".join(p) for p in permutations(NAMES)]
    bit = np.array([[1 << NAMES.index(f) for f in o] for o in orders])  # orders x steps
    before = np.cumsum(bit, axis=1) - bit
    after = before + bit
    everything = SUBSETS - 1

    def tell(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            n = np.stack(pdf["n"].to_numpy()).reshape(len(pdf), 3, SUBSETS)  # parts x labels x subsets
            every = n[:, ALL]
            removed = every[:, before] - every[:, after]
            fails = every[:, [0]] - every[:, 1 << np.arange(len(NAMES))]
            unique = every[:, everything ^ (1 << np.arange(len(NAMES)))] - every[:, [everything]]
            shapley = np.stack([_over_orders(every, 1 << f) for f in range(len(NAMES))], axis=1)
            which = np.log2(bit).astype(int)
            lost = n[:, :, before] - n[:, :, after]
            each = len(orders) * len(NAMES)
            yield pd.DataFrame({
                "part": np.repeat(pdf["part"].to_numpy(object), each),
                "filter_order": np.tile(np.repeat(np.array(orders, object), len(NAMES)), len(pdf)),
                "step": np.tile(np.arange(1, len(NAMES) + 1, dtype=np.int32), len(pdf) * len(orders)),
                "filter": np.tile(np.array(list("".join(orders)), object), len(pdf)),
                "kept": every[:, after].ravel(),
                "removed": removed.ravel(),
                "redundant": (fails[:, which] - removed).ravel(),
                "unique_fails": unique[:, which].ravel(),
                "good_lost": lost[:, GOOD].ravel(),
                "toxic_lost": lost[:, TOXIC].ravel(),
                "shapley": shapley[:, which].ravel(),
            })

    zeros = F.array(*[F.lit(0).cast("long")] * SUBSETS)
    of = lambda label: F.coalesce(F.max(F.when(F.col("label") == label, F.col("n"))), zeros)
    return counts.groupBy("part").agg(F.concat(of(ALL), of(GOOD), of(TOXIC)).alias("n")).mapInPandas(tell, STEPS)


def _over_orders(survive: np.ndarray, bit: int) -> np.ndarray:
    """What a filter removes, summed over all orders: after each set of others it stands in |set|! (4 - |set|)! of them."""
    out = np.zeros(len(survive), np.int64)
    for s in range(SUBSETS):
        if not s & bit:
            k = s.bit_count()
            out += factorial(k) * factorial(len(NAMES) - 1 - k) * (survive[:, s] - survive[:, s | bit])
    return out


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """What the five filters do to each part of ``docs``, in all orders."""
    failed = judged(docs, id_col, text_col, part_col)
    known = labels.select(named(id_col).cast("long").alias("doc"), F.lit(0).alias("lone"), (F.col("quality") == 1).alias("q"), (F.col("toxic") == 1).alias("t"))
    known = stored(known.filter("doc is not null").groupBy("doc", "lone").agg(F.max("q").alias("good"), F.max("t").alias("bad")), "labels-by-id")
    # rows without an id have no labels; they are spread by what else is known of them
    lone = F.when(F.col("doc") == NO_ID, F.lit(1) + F.pmod(F.monotonically_increasing_id(), F.lit(1 << 20))).otherwise(0).cast("int")
    rows = failed.withColumn("lone", lone).join(known, ["doc", "lone"], "left")
    rows = rows.select("part", "failed", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("bad", F.lit(False)).alias("toxic"))
    return by_order(survivors(rows))
