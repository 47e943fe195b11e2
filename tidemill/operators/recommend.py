"""Recommender from interactions: features, holdout, models, hit rate, promotion."""

from __future__ import annotations

import math
from dataclasses import dataclass
from datetime import datetime, timezone

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.latest import first_per_key, top_per_key
from tidemill.functions.ordered import last_known, numbered
from tidemill.functions.vectors import dot, sigmoid
from tidemill.session import stored

# What an event is worth. Every other kind counts 1.
EVENT_WEIGHTS = {"purchase": 3, "click": 2}
OTHER_WEIGHT = 1
# The factorisation's settings.
RANK, ITERATIONS, REGULARISATION, SEED = 20, 10, 0.1, 42
TOP = 10
BLOCK_PAIRS = 500_000
# Users and items that small blocks share a task up to, and the scores a task holds at a time.
TASK_USERS, TASK_ITEMS, TILE = 8192, 8192, 1 << 20


def feature_table(events: DataFrame, weights: dict[str, int] | None = None) -> DataFrame:
    """Interaction score per user and item."""
    weight = F.lit(OTHER_WEIGHT)
    for kind, value in (EVENT_WEIGHTS if weights is None else weights).items():
        weight = F.when(F.col("event_type") == kind, value).otherwise(weight)
    return events.groupBy("user_id", "item_id").agg(F.sum(weight).alias("interaction_score"))


def feature_stats(features: DataFrame) -> DataFrame:
    """Size, score range and density of the user x item matrix."""
    cells = F.col("users").cast("double") * F.col("items")
    return features.agg(
        F.count("*").alias("pairs"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
        F.min("interaction_score").alias("min_score"),
        F.max("interaction_score").alias("max_score"),
        F.round(F.sum("interaction_score") / F.count("*"), 4).alias("mean_score"),
    ).withColumn("density", F.round(F.col("pairs") / cells, 6))


def index_ids(df: DataFrame, column: str, name: str) -> DataFrame:
    """The distinct ids of a column, numbered from 0 in sorted order."""
    return numbered(df.select(column).distinct(), column, name=name)


def indexed_features(features: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Features with dense integer ids, and the two id tables.

    Both kinds of ids are numbered in one go, users before items.
    """
    none = F.lit(None)
    users = features.select("user_id", none.cast(features.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("kind"))
    items = features.select(none.cast(features.schema["user_id"].dataType).alias("user_id"), "item_id", F.lit(1).alias("kind"))
    distinct = users.distinct().unionByName(items.distinct()).checkpoint()  # ranges are drawn from it, then it is split
    ids = numbered(distinct, "kind", "user_id", "item_id").checkpoint()
    n_users = ids.filter("kind = 0").count()
    users = ids.filter("kind = 0").select("user_id", F.col("position").alias("user_idx"))
    items = ids.filter("kind = 1").select("item_id", (F.col("position") - n_users).alias("item_idx"))
    return features.join(users, "user_id").join(items, "item_id"), users, items


def holdout_split(features: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Train, and one held-out row per user: the highest score, then the smallest item.

    Train is everything else, found by an anti-join on the full pair. A user
    with a single pair has no training row.
    """
    held = first_per_key(features, ["user_id"], [F.desc("interaction_score"), F.asc("item_id")])
    train = features.join(held.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")
    return train, held


def popular_items(train: DataFrame, k: int = TOP, by: Column | None = None) -> DataFrame:
    """The ``k`` items with the highest total score (or another measure)."""
    measure = F.sum("interaction_score") if by is None else by
    return (
        train.groupBy("item_id").agg(measure.cast("long").alias("score"))
        .orderBy(F.desc("score"), "item_id").limit(k)
    )


def recommend_popular(users: DataFrame, popular: DataFrame) -> DataFrame:
    """The same few items for every user; the list is a single scalar value."""
    items = popular.agg(F.collect_list(F.struct("item_id", "score")).alias("items"))
    return users.select("user_id", F.inline(items.scalar()))


def hit_rate(recommendations: DataFrame, holdout: DataFrame) -> DataFrame:
    """Held-out pairs that were recommended, and their share."""
    hits = recommendations.select("user_id", "item_id", F.lit(1).alias("hit")).distinct()
    return (
        holdout.select("user_id", "item_id")
        .join(hits, ["user_id", "item_id"], "left")
        .agg(F.count("hit").alias("hits"), F.count("*").alias("holdout_rows"))
        .withColumn("hit_rate", F.coalesce(F.col("hits") / F.nullif("holdout_rows", F.lit(0)), F.lit(0.0)))
    )


def popular_hit_rate(popular: DataFrame, holdout: DataFrame) -> DataFrame:
    """The hit rate of one list for all users: a join with the few items of the list."""
    listed = popular.select("item_id", F.lit(1).alias("hit"))
    return (
        holdout.select("item_id").join(F.broadcast(listed), "item_id", "left")  # as many rows as the list is long
        .agg(F.count("hit").alias("hits"), F.count("*").alias("holdout_rows"))
        .withColumn("hit_rate", F.coalesce(F.col("hits") / F.nullif("holdout_rows", F.lit(0)), F.lit(0.0)))
    )


def fit_als(train: DataFrame, rank: int = RANK, iterations: int = ITERATIONS, reg: float = REGULARISATION,
            seed: int = SEED, blocks: int | None = None) -> ALSModel:
    """Implicit-feedback factorisation on ``user_idx`` and ``item_idx``.

    The number of blocks follows the number of pairs, without a limit, unless
    the caller names it: the library's fixed ten are too few for a large table
    and mostly overhead for a small one.
    """
    if blocks is None:
        blocks = max(1, -(-train.count() // BLOCK_PAIRS))
    als = ALS(
        numUserBlocks=blocks, numItemBlocks=blocks,
        userCol="user_idx", itemCol="item_idx", ratingCol="interaction_score", implicitPrefs=True,
        rank=rank, maxIter=iterations, regParam=reg, seed=seed, coldStartStrategy="drop",
    )
    ints = train.select(
        F.col("user_idx").cast("int"), F.col("item_idx").cast("int"), F.col("interaction_score").cast("float")
    )
    return als.fit(ints)


def top_items(model: ALSModel, users: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """The best ``k`` items for each of ``users``, under the original ids.

    ``users`` may be all of the id table or the part to predict for. Items a
    user has already met may appear.
    """
    wanted = users.select(F.col("user_idx").cast("int").alias("id"))
    recs = dot_topk(
        model.userFactors.join(wanted, "id", "left_semi").select(F.col("id").cast("long").alias("user_id"), F.col("features").alias("vec")),
        model.itemFactors.select(F.col("id").cast("long").alias("item_id"), F.col("features").alias("vec")),
        k,
    ).select(F.col("user_id").alias("user_idx"), F.col("item_id").alias("item_idx"), "score")
    return recs.join(users, "user_idx").join(items, "item_idx").select("user_id", "item_id", "score")


def score_pairs(pairs: DataFrame, users: DataFrame, items: DataFrame, weight: float = 1.0,
                bias: float = 0.0) -> DataFrame:
    """Probability for given (user, item) pairs: a logistic layer over the dot product of their vectors."""
    return (
        pairs.join(users.withColumnRenamed("vec", "_u"), "user_id")
        .join(items.withColumnRenamed("vec", "_v"), "item_id")
        .withColumn("score", sigmoid(F.lit(weight) * dot("_u", "_v") + F.lit(bias)))
        .drop("_u", "_v")
    )


def without_seen(recommendations: DataFrame, train: DataFrame) -> DataFrame:
    """Leave out items the user has already met."""
    return recommendations.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def negative_pairs(train: DataFrame, n_users: int, n_items: int, short: str = "raise") -> DataFrame:
    """One unknown (user, item) pair for every training pair, none of them twice.

    Cells of the grid are numbered ``user_idx * n_items + item_idx``. If the
    j-th known cell (from 0) has number p, then p - j unknown cells lie before
    it. So the r-th unknown cell is r plus the number of known cells whose
    p - j is at most r: one lookup along a sorted axis, without building
    the grid and without rejected draws. The unknown cells are cut into as many
    strips as there are draws, strip j from ``j * free div n`` to
    ``(j + 1) * free div n``; each draw takes one cell of its strip, so the
    draws cover all of the grid in proportion.

    With fewer unknown cells than known ones there is no such set: ``short``
    says whether to raise an error or to ``keep`` all unknown cells.

    Known cells that touch share one p - j and are counted together first,
    so neither dense users nor long runs meet in one task.
    """
    cells = train.select((F.col("user_idx") * F.lit(n_items) + F.col("item_idx")).cast("long").alias("cell"))
    known = numbered(cells, "cell", name="j").checkpoint()  # counted, drawn from and stepped through
    n = known.count()
    free = n_users * n_items - n
    if free < n and short != "keep":
        raise ValueError(f"{n} pairs are asked for, {max(free, 0)} are unknown")
    draws = min(n, free)
    if draws <= 0:
        return train.sparkSession.createDataFrame([], "draw long, user_idx long, item_idx long")
    j = F.col("j")
    # products of two counts may pass 64 bits
    edge = lambda i: F.call_function("div", i.cast("decimal(19,0)") * F.lit(free).cast("decimal(19,0)"), F.lit(draws).cast("decimal(19,0)"))
    drawn = known.filter(j < draws).select(j.alias("draw"), edge(j).alias("lo"), edge(j + 1).alias("hi")).select(
        "draw",
        (F.col("lo") + (F.col("draw") * 7919) % (F.col("hi") - F.col("lo"))).alias("at"),
        F.lit(1).alias("side"),
        F.lit(None).cast("long").alias("passed"),
    )
    steps = (
        known.groupBy((F.col("cell") - j).alias("at"))
        .agg((F.max("j") + 1).alias("passed"))
        .select(F.lit(None).cast("long").alias("draw"), "at", F.lit(0).alias("side"), "passed")
    )
    placed = last_known(steps.unionByName(drawn), ["at", "side", "draw"], "passed", "ahead").filter("side = 1")
    cell = F.col("at") + F.coalesce("ahead", F.lit(0))
    return placed.withColumn("cell", cell).select(
        "draw",
        F.expr(f"cell div {n_items}").alias("user_idx"),
        F.expr(f"cell % {n_items}").alias("item_idx"),
    )


def training_pairs(train: DataFrame, negatives: DataFrame) -> DataFrame:
    """Known pairs labelled by score over the highest score, and the unknown ones labelled 0."""
    top = train.agg(F.max("interaction_score").alias("top")).scalar()
    positives = train.select("user_idx", "item_idx", (F.col("interaction_score") / top).alias("label"))
    return positives.unionByName(negatives.select("user_idx", "item_idx", F.lit(0.0).alias("label")))


def _strips_by_norm(items: DataFrame, n_items: int, strip_rows: int) -> DataFrame:
    """Items with ``norm`` and their ``strip``: strips of ``strip_rows`` rows, the largest norms first."""
    norm = F.sqrt(dot("vec", "vec"))
    held = items.select("item_id", "vec", F.when(F.isnan(norm), F.lit(math.inf)).otherwise(norm).alias("norm"))
    if n_items <= strip_rows:
        return held.withColumn("strip", F.lit(0))
    placed = numbered(held.withColumn("_less", -F.col("norm")), "_less", "item_id")
    return stored(placed.withColumn("strip", F.floor(F.col("position") / strip_rows).cast("int")).drop("_less", "position"), "items-by-norm")


def _matrix(vectors: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as rows of a matrix."""
    held = vectors.combine_chunks()
    sizes = pc.unique(pc.list_value_length(held)).to_pylist()
    if len(sizes) > 1 or sizes == [None]:
        raise ValueError("all vectors must have the same length")
    return held.flatten().to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(len(held), *sizes)


def _first_k(found: list[np.ndarray], k: int) -> list[np.ndarray]:
    """Of ``(row, less, rank, item)``, ``less`` the negative score, the ``k`` first of every row."""
    row, less, rank, item = found
    order = np.lexsort((rank, less, row))
    row = row[order]
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, int)
    within = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
    return [x[order[within < k]] for x in found]


def _strip_best(u: pa.Table, v: pa.Table, k: int, item_rows: int) -> pa.Table:
    """The ``k`` best items of a strip for each of some users, and a row without ids that counts the scored pairs.

    Blocks of ``item_rows`` are scored in order of norm; a user who reaches the k-th score so far with none
    of what follows is done. Only tiles of ``TILE`` scores are held, and at most ``k`` items a user and tile.
    """
    u = u.filter(pc.is_valid(u["user_id"]))
    names = ["user_id", "item_id", "score", "scored"]
    row, less, item, scored = np.zeros(0, int), np.zeros(0), np.zeros(0, int), 0
    if u.num_rows and v.num_rows:
        v = v.take(pc.sort_indices(v, [("norm", "descending"), ("item_id", "ascending")]))
        rank = np.empty(v.num_rows, int)  # among equal scores the smaller id comes first
        rank[pc.sort_indices(v["item_id"]).to_numpy()] = np.arange(v.num_rows)
        left, right = _matrix(u["vec"]), _matrix(v["vec"])
        norms, most = u["norm"].to_numpy(), v["norm"].to_numpy()
        reached = u["reached"].to_numpy() if "reached" in u.column_names else np.full(len(left), np.nan)
        floor = np.where(np.isnan(reached), -np.inf, reached)
        top = np.full((len(left), k), -np.inf)  # the k best scores met here
        live, held, size = np.arange(len(left)), [], 0
        wide = min(item_rows, TILE // 256)
        for at in range(0, len(right), wide):
            with np.errstate(invalid="ignore"):  # no bound is known where a length is infinite
                live = live[~(norms[live] * most[at] * (1 + 1e-12) + 2e-9 < floor[live])]
            if not len(live):
                break
            block = right[at : at + wide]
            scored += len(live) * len(block)
            for some in range(0, len(live), high := max(1, TILE // len(block))):
                rows = live[some : some + high]
                scores = left[rows] @ block.T
                unknown = np.isnan(scores)
                scores[unknown] = -np.inf
                near = scores >= (floor[rows] * (1 - 1e-12 * np.sign(floor[rows])) - 2e-9)[:, None]
                hit = near.any(axis=1)
                if not hit.any():
                    continue
                scores, near, rows = scores[hit], near[hit], rows[hit]
                cut = min(k, scores.shape[1])
                both = np.concatenate([top[rows], np.partition(scores, -cut, axis=1)[:, -cut:]], axis=1)
                top[rows] = both = np.partition(both, -k, axis=1)[:, -k:]
                floor[rows] = np.maximum(floor[rows], both[:, 0])
                near &= scores >= (floor[rows] * (1 - 1e-12 * np.sign(floor[rows])) - 2e-9)[:, None]
                near &= ~unknown[hit]
                r, c = np.nonzero(near)
                new = [rows[r], -np.round(scores[r, c], 9), rank[at + c], at + c]
                held.append(_first_k(new, k) if len(r) > k * len(rows) else new)
                size += len(held[-1][0])
                if size > 2 * k * len(left) + TILE:
                    held = [_first_k([np.concatenate(x) for x in zip(*held, strict=True)], k)]
                    size = len(held[0][0])
        if held:
            row, less, _, item = _first_k([np.concatenate(x) for x in zip(*held, strict=True)], k)
    return pa.table([
        pa.concat_arrays([u["user_id"].combine_chunks().take(row), pa.nulls(1, pa.int64())]),
        pa.concat_arrays([v["item_id"].combine_chunks().take(item), pa.nulls(1, pa.int64())]),
        pa.concat_arrays([pa.array(0.0 - less), pa.nulls(1, pa.float64())]),
        pa.concat_arrays([pa.nulls(len(row), pa.int64()), pa.array([scored], pa.int64())]),
    ], names)


@dataclass
class TopItems:
    """``best``: ``user_id, item_id, score, place``. ``pairs`` of users and items there are, ``scored`` of them were scored."""

    best: DataFrame
    pairs: int
    scored: int


def bounded_topk(users: DataFrame, items: DataFrame, k: int = TOP, user_rows: int = 8192, item_rows: int = 32768,
                 task_users: int = TASK_USERS, task_items: int = TASK_ITEMS) -> TopItems:
    """The ``k`` items with the highest dot product for every user, without scoring every pair.

    No score is above the product of the two norms. Items are cut into blocks by
    norm, the largest first; a block is not scored for a user whose k-th score so far
    it cannot reach. What can tie is scored.

    Small blocks share a task, so that the copies of a vector that are shuffled depend
    on the size of tasks, not of blocks: a task takes a strip of blocks (``task_items`` rows
    or one block) and hashed users (``task_users`` or ``user_rows``). The first round takes the
    first strip, later ones twice as many strips each. Before a round every user drops the
    strips whose largest norm cannot reach the user's k-th score so far; within
    a strip the task does so block by block.

    A task is bounded: matrix products that keep ``k`` rows per user. What is shuffled
    is strips and partial winners, never scored pairs. Equal scores go to the smaller item id.
    """
    n_users, n_items = users.count(), items.count()
    strip_rows = max(1, task_items // item_rows) * item_rows
    groups = max(1, -(-n_users // max(user_rows, task_users)))
    placed = _strips_by_norm(items, n_items, strip_rows)
    n_strips = -(-n_items // strip_rows)
    if n_strips > 1:
        bounds = stored(placed.groupBy("strip").agg(F.max("norm").alias("most")), "strips")
    own = F.pmod(F.xxhash64("user_id"), F.lit(groups)).cast("int")
    norm = F.sqrt(dot("vec", "vec"))
    left = users.select("user_id", "vec", own.alias("ub"), F.when(F.isnan(norm), F.lit(math.inf)).otherwise(norm).alias("norm"))
    best, scored, at = None, 0, 0
    while at < n_strips:
        upto = min(n_strips, max(1, 2 * at))
        others = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
        right = placed.filter(F.col("strip").between(at, upto - 1)).withColumn("ub", others)
        if best is None:
            wanted = left.withColumn("strip", F.lit(0))
        else:
            last = F.when(F.isnan("score"), F.lit(math.inf)).otherwise(F.col("score"))
            reached = best.filter(F.col("place") == k).select("user_id", last.alias("reached"))
            bound = F.col("norm") * F.col("most") * (1 + 1e-12) + 1e-9  # scores are rounded to nine places
            ahead = F.broadcast(bounds.filter(F.col("strip").between(at, upto - 1)))  # one row a strip
            known = left.join(reached, "user_id", "left")
            wanted = known.join(ahead, F.col("reached").isNull() | (bound >= F.col("reached"))).drop("most")
            right = right.join(wanted.select("ub", "strip").distinct(), ["ub", "strip"], "left_semi")
        found = stored(
            wanted.groupBy("ub", "strip").cogroup(right.groupBy("ub", "strip"))
            .applyInArrow(lambda u, v: _strip_best(u, v, k, item_rows), "user_id long, item_id long, score double, scored long"),
            "best-of-strips",
        )
        scored += found.agg(F.coalesce(F.sum("scored"), F.lit(0)).alias("n")).first().n
        found = found.filter(F.col("user_id").isNotNull()).drop("scored")
        if best is not None:
            found = found.unionByName(best.drop("place"))
        best = top_per_key(found, ["user_id"], [F.desc("score"), F.asc("item_id")], k, "place")
        at = upto
        if at < n_strips:
            best = stored(best, "best-so-far")
    if best is None:
        best = users.sparkSession.createDataFrame([], "user_id long, item_id long, score double, place long")
    return TopItems(best, n_users * n_items, scored)


def dot_topk(users: DataFrame, items: DataFrame, k: int = TOP, user_rows: int = 8192, item_rows: int = 32768) -> DataFrame:
    """The ``k`` items with the highest dot product for every user, over all pairs (see ``bounded_topk``)."""
    return bounded_topk(users, items, k, user_rows, item_rows).best


RUN_SCHEMA = "run_id string, model string, params map<string,string>, metric string, value double, logged_at timestamp"


def log_run(path: str, metric: DataFrame, run_id: str, model: str, params: dict[str, object], name: str) -> None:
    """Append one run; ``metric`` is a one-row frame whose column ``name`` is the figure."""
    pairs = [x for k, v in params.items() for x in (F.lit(k), F.lit(str(v)))]
    metric.select(
        F.lit(run_id).alias("run_id"),
        F.lit(model).alias("model"),
        F.create_map(*pairs).cast("map<string,string>").alias("params"),
        F.lit(name).alias("metric"),
        F.col(name).cast("double").alias("value"),
        F.lit(datetime.now(timezone.utc)).alias("logged_at"),
    ).write.mode("append").parquet(path)


def promote(runs: DataFrame, champion: str, challenger: str) -> DataFrame:
    """Decide between the newest runs of two models; the challenger has to be strictly better.

    One row per model with its next role. Nothing is removed from the log.
    """
    newest = first_per_key(runs, ["model"], [F.desc("logged_at"), F.desc("run_id")])
    value = {
        m: F.max(F.when(F.col("model") == m, F.col("value"))).alias(f"{role}_value")
        for m, role in ((champion, "champion"), (challenger, "challenger"))
    }
    verdict = newest.agg(*value.values()).withColumn(
        "promoted", F.coalesce(F.col("challenger_value") > F.col("champion_value"), F.lit(False))
    )
    return verdict.select(
        F.lit(champion).alias("champion"),
        F.lit(challenger).alias("challenger"),
        "champion_value",
        "challenger_value",
        "promoted",
        F.when(F.col("promoted"), challenger).otherwise(champion).alias("next_champion"),
        F.round(F.abs(F.col("challenger_value") - F.col("champion_value")), 6).alias("margin"),
    )


DECISION_SCHEMA = (
    "champion string, challenger string, champion_value double, challenger_value double,"
    " promoted boolean, next_champion string, margin double, decided_at timestamp"
)


def record_decision(path: str, decision: DataFrame) -> None:
    """Append a promotion decision to the log of decisions."""
    decision.withColumn("decided_at", F.current_timestamp()).write.mode("append").parquet(path)
