"""Mixing sources to target weights.

1. The texts of a source, in the order of their ids, are packed into blocks of
   ``block`` words; a block may hold several texts and a text several blocks.
2. Sources get targets by weight, at most ``epochs`` times their size; what is
   over is shared again among the others. A source's target, in whole words, gives its
   slots: every block in full rounds, then a part of them in a last round, the last
   slot cut to the words still owed. So what is taken meets the target to the word.
3. The mix has shards of ``shard_slots`` slots. Each shard draws its counts per
   source from a multinomial distribution, seeded by the shard. What a source
   drew beyond its slots is handed on to sources that drew less, so counts vary
   by shard and add up to the targets.
4. The n-th slot of a source takes the block that a pseudorandom permutation of
   its blocks gives for n (a Feistel network per source and round): in a round
   every block comes once, and no permutation is stored.
5. Slots join blocks by source and index, and so give pieces of texts.

Only totals per source are gathered on the driver. The same rows and seed give
the same mix, whatever the partitions. Null sources are one source, the last.
Null and empty texts have size 0 and are never taken; a null id sorts last.
Repeated rows count as rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemill.functions.ordered import BLOCK, range_blocks, running_total
from tidemill.llm import rolling as R
from tidemill.llm.common import NO_ID, identity, prepared, stored
from tidemill.llm.common import col as named

WORD = r"[^\x20\x09-\x0D]+"
#: Totals per source are kept on the driver up to so many sources (about 200 bytes each).
MOST_SOURCES = 1_000_000
#: Up to so many rows (of some 60 bytes) the source table is sent to all tasks.
FEW_SOURCES = 100_000


@dataclass
class Source:
    name: str | None
    total: int
    weight: float
    target: float = 0.0
    before: int = 0  # words of the sources before it
    blocks: int = 0
    slots: int = 0
    upto: int = 0  # words of the last slot's block that it takes


def share_out(sources: list[Source], words: float, epochs: float) -> None:
    """Set the targets: ``words`` by weight, none above ``epochs`` times its size."""
    free, left = [s for s in sources if s.total], float(words)
    while free:
        each = left / sum(s.weight for s in free)
        over = [s for s in free if each * s.weight > epochs * s.total]
        if not over:
            for s in free:
                s.target = each * s.weight
            return
        for s in over:
            s.target = float(epochs * s.total)
            left -= s.target
        done = set(map(id, over))
        free = [s for s in free if id(s) not in done]


def plan(totals: list[tuple[str | None, int]], weights: list[float], share: float, epochs: int, block: int, seed: int) -> list[Source]:
    """Sources in code point order, null last, with targets, blocks and slots."""
    order = sorted(totals, key=lambda t: (t[0] is None, t[0] or ""))
    sources = [Source(n, t, weights[i % len(weights)]) for i, (n, t) in enumerate(order)]
    share_out(sources, share * sum(t for _, t in totals), epochs)
    before = 0
    for s in sources:
        s.before, s.blocks = before, -(-s.total // block)
        before += s.total
    _count_slots(sources, epochs, block, seed)
    return sources


def _count_slots(sources: list[Source], epochs: int, block: int, seed: int) -> None:
    """Set the slots of every source, and how far its last slot goes."""
    some = [i for i, s in enumerate(sources) if s.total]
    total = np.array([sources[i].total for i in some], np.int64)
    words = np.minimum(np.rint([sources[i].target for i in some]).astype(np.int64), epochs * total)
    blocks, rounds = -(-total // block), words // np.maximum(total, 1)
    left, lacking = words - rounds * total, -total % block  # the last block lacks some words
    place = permuted(blocks - 1, blocks, round_key(np.array(some, np.int64), rounds, seed), inverse=True)
    slots = -(-left // block)
    passed = place < slots  # the short block stands among them
    slots = np.where(passed, -(-(left + lacking) // block), slots)
    given = slots * block - np.where(passed, lacking, 0)
    last = np.where(place == slots - 1, block - lacking, block)
    for i, full, n, per, upto in zip(some, rounds.tolist(), slots.tolist(), blocks.tolist(), (last - (given - left)).tolist(), strict=True):
        sources[i].slots, sources[i].upto = full * per + n, upto if n else block


def round_key(sid: np.ndarray, turn: np.ndarray, seed: int) -> np.ndarray:
    """The key of a source's permutation in a round."""
    return R.mixed(sid.astype(R.U64) * R.U64(0x1000003) + turn.astype(R.U64) + R.mixed(np.array([seed], R.U64))[0])


def permuted(at: np.ndarray, size: np.ndarray, key: np.ndarray, inverse: bool = False) -> np.ndarray:
    """A pseudorandom permutation of ``range(size)`` at places ``at``, for each ``key``; all arrays alike long.

    Or its ``inverse``: the place at which ``at`` stands.
    """
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(size, 2))) / 2 + 0.5).astype(np.int64)).astype(R.U64)
    mask = (R.U64(1) << half) - R.U64(1)
    out = at.astype(R.U64)
    todo = np.arange(len(at))
    while len(todo):  # a value outside the range is permuted again: the cycle leads back into it
        left, right = out[todo] >> half[todo], out[todo] & mask[todo]
        for r in reversed(range(4)) if inverse else range(4):
            turn = lambda x: R.mixed(R.mixed(x + R.U64(r << 56)) ^ key[todo]) & mask[todo]  # noqa: B023, E731
            left, right = (right ^ turn(left), left) if inverse else (right, left ^ turn(right))
        out[todo] = (left << half[todo]) | right
        todo = todo[out[todo] >= size[todo].astype(R.U64)]
    return out.astype(np.int64)


def slots_of(spark, sources: list[Source], shard_slots: int, seed: int, block: int) -> DataFrame:
    """``shard, slot, sid, block, upto``: which block of which source stands where, and how much of it."""
    ends = np.array([s.upto for s in sources], np.int64)
    quota = np.array([s.slots for s in sources], np.int64)
    blocks = np.array([s.blocks for s in sources], np.int64)
    total = int(quota.sum())
    shards = -(-total // shard_slots)

    def draw(batches):
        for pdf in batches:
            rows = []
            for shard in pdf["id"].tolist():
                n = min(shard_slots, total - shard * shard_slots)
                counts = np.random.default_rng([seed, shard]).multinomial(n, quota / total)
                start = np.cumsum(counts) - counts
                rows += [(shard, i, int(c), int(at)) for i, (c, at) in enumerate(zip(counts, start, strict=True)) if c]
            yield pd.DataFrame(rows, columns=["shard", "sid", "n", "at"])

    drawn = stored(spark.range(shards).mapInPandas(draw, "shard long, sid long, n long, at long"), "draws")
    counts = np.zeros(len(sources), np.int64)
    for r in drawn.groupBy("sid").agg(F.sum("n").alias("n")).collect():  # one row per source
        counts[r.sid] = r.n
    over, under = np.maximum(counts - quota, 0), np.maximum(quota - counts, 0)
    over_at, under_end = np.cumsum(over) - over, np.cumsum(under)

    def place(batches):
        for pdf in batches:
            n = pdf["n"].to_numpy()
            inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            sid = np.repeat(pdf["sid"].to_numpy(), n)
            j = inner + np.repeat(pdf["ahead"].to_numpy(), n)
            extra = j >= quota[sid]
            handed = over_at[sid[extra]] + j[extra] - quota[sid[extra]]
            to = np.searchsorted(under_end, handed, side="right")
            j[extra] = counts[to] + handed - (under_end[to] - under[to])
            sid[extra] = to
            size = blocks[sid]
            yield pd.DataFrame({
                "shard": np.repeat(pdf["shard"].to_numpy(), n),
                "slot": inner + np.repeat(pdf["at"].to_numpy(), n),
                "sid": sid,
                "block": permuted(j % size, size, round_key(sid, j // size, seed)),
                "upto": np.where(j == quota[sid] - 1, ends[sid], block),
            })

    return placed_draws(drawn).mapInPandas(place, "shard long, slot long, sid long, block long, upto long")


def placed_draws(drawn: DataFrame, run: int = 4096) -> DataFrame:
    """``ahead``: what the earlier shards drew of the same source, added up by runs of shards."""
    by_run = drawn.withColumn("run", F.floor(F.col("shard") / run))
    before = W.partitionBy("sid").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    runs = by_run.groupBy("sid", "run").agg(F.sum("n").alias("m")).select("sid", "run", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("base"))
    inside = W.partitionBy("sid", "run").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    local = by_run.withColumn("inner", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return local.join(runs, ["sid", "run"]).select("shard", "sid", "n", "at", (F.col("base") + F.col("inner")).alias("ahead"))


@dataclass
class Mix:
    """``rows``: one per input row, with its place ``start`` in its source; ``pieces``: what stands in each slot."""

    rows: DataFrame
    pieces: DataFrame

    def taken(self) -> DataFrame:
        """Per input row: ``doc_id, source, size, source_size, target, taken``."""
        used = self.pieces.groupBy("sid", "start").agg(F.sum(F.col("b") - F.col("a")).alias("taken"))
        joined = self.rows.join(used, (self.rows.sid == used.sid) & (self.rows.start == used.start) & (self.rows.size > 0), "left").drop(used.sid, used.start)
        doc = F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id")
        return joined.select(doc, "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (3, 1, 2), share: float = 1.5, epochs: int = 2, block: int = 128, shard_slots: int = 4096, seed: int = 11, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> Mix:
    """Mix ``docs`` to ``share`` times their words; weights go round the sources in code point order."""
    spark = prepared(docs.sparkSession)
    text = F.coalesce(named(text_col).cast("string"), F.lit(""))
    sized = stored(
        docs.select(identity(docs, id_col).alias("doc"), F.xxhash64(text).alias("sig"), named(source_col).cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")),
        "sized",
    )
    totals = sized.groupBy("source").agg(F.sum("size").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sources = plan([(r.source, r.n) for r in totals], list(weights), share, epochs, block, seed)
    table = spark.createDataFrame(
        [(s.name, i, s.total, s.target, s.before) for i, s in enumerate(sources)], "source string, sid long, source_size long, target double, before long"
    ).withColumnRenamed("source", "name")
    table = F.broadcast(table) if len(sources) <= FEW_SOURCES else table
    known = sized.join(table, F.col("source").eqNullSafe(F.col("name"))).drop("name")
    rows = running_total(range_blocks(known, "sid", "doc", "sig"), BLOCK, ["sid", "doc", "sig"], {"end": F.col("size")})
    rows = stored(rows.withColumn("start", F.col("end") - F.col("size") - F.col("before")).drop(BLOCK, "end", "before"), "rows")
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    cut = rows.filter("size > 0").select("sid", "doc", "sig", "size", "start", F.explode(F.sequence(first, last)).alias("block"))
    cut = cut.withColumns({
        "a": F.greatest(F.col("block") * block - F.col("start"), F.lit(0)),
        "b": F.least((F.col("block") + 1) * block - F.col("start"), F.col("size")),
    }).drop("size")
    if not sum(s.slots for s in sources):
        none = F.lit(0).cast("long")
        return Mix(rows, cut.withColumns({"shard": none, "slot": none, "upto": none}).limit(0))
    slots = slots_of(spark, sources, shard_slots, seed, block)
    # the size of slots is estimated from the draws they are spread from, thousands of times too low
    pieces = slots.hint("merge").join(cut, ["sid", "block"])
    owed = F.col("upto") - (F.col("start") + F.col("a") - F.col("block") * block)  # of the words from ``a`` on
    return Mix(rows, pieces.withColumn("b", F.least("b", F.col("a") + owed)).filter("b > a"))
