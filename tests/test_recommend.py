from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemill.functions.latest import first_per_key, first_rows, ranked_per_key
from tidemill.functions.ordered import last_known, numbered, range_blocks, running_total
from tidemill.operators import recommend
from tidemill.session import work_path


@pytest.fixture(autouse=True)
def many_blocks(spark):
    """Keep the small test tables spread over all partitions."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def features(spark, pairs):
    return spark.createDataFrame([(u, i, s) for (u, i), s in pairs.items()], "user_id long, item_id long, interaction_score long")


def random_pairs(seed, users, items, n):
    rng = random.Random(seed)
    return {(rng.randrange(users), rng.randrange(items)): rng.randrange(1, 9) for _ in range(n)}


def test_weights(spark):
    events = spark.createDataFrame(
        [(1, 5, "purchase"), (1, 5, "click"), (1, 5, "view"), (2, 5, "signup")], "user_id long, item_id long, event_type string"
    )
    assert rows(recommend.feature_table(events)) == [(1, 5, 6), (2, 5, 1)]
    assert rows(recommend.feature_table(events, {"view": 10})) == [(1, 5, 12), (2, 5, 1)]


def test_split_is_whole(spark):
    f = features(spark, random_pairs(1, 30, 20, 300))
    train, held = recommend.holdout_split(f)
    assert rows(train.unionByName(held)) == rows(f)
    assert held.groupBy("user_id").count().filter("count <> 1").count() == 0
    assert held.count() == f.select("user_id").distinct().count()
    best = f.groupBy("user_id").agg(F.max("interaction_score").alias("m"))
    assert held.join(best, "user_id").filter("interaction_score < m").count() == 0
    assert rows(recommend.holdout_split(f.repartition(7))[1]) == rows(held)


@pytest.mark.parametrize("case", ["mixed", "one user holds a third", "full rows", "dense run", "more known than free"])
def test_negatives_against_brute_force(spark, case):
    if case == "mixed":
        pairs, users, items = random_pairs(3, 25, 40, 300), 25, 40
    elif case == "one user holds a third":
        pairs, users, items = {**random_pairs(4, 30, 400, 500), **{(7, i): 1 for i in range(250)}}, 30, 400
    elif case == "full rows":
        pairs, users, items = {(u, i): 1 for u in (0, 2) for i in range(12)}, 5, 12
    elif case == "dense run":
        pairs, users, items = {(u, i): 1 for u in range(3) for i in range(9)} | {(5, 2): 1}, 6, 9
    else:
        pairs, users, items = {(u, i): 1 for u in range(6) for i in range(10) if (u, i) not in {(1, 3), (4, 9)}}, 6, 10
    train = spark.createDataFrame([(u, i) for u, i in pairs], "user_idx long, item_idx long")
    free = [(u, i) for u in range(users) for i in range(items) if (u, i) not in pairs]
    n = len(pairs)
    if len(free) < n:
        with pytest.raises(ValueError, match=f"{n} pairs are asked for, {len(free)} are unknown"):
            recommend.negative_pairs(train, users, items)
        got = recommend.negative_pairs(train, users, items, short="keep").collect()
        assert sorted((r.user_idx, r.item_idx) for r in got) == free
        return
    got = [(r.user_idx, r.item_idx) for r in recommend.negative_pairs(train, users, items).orderBy("draw").collect()]
    assert len(got) == len(set(got)) == n
    assert set(got) <= set(free)
    # every stretch of the free cells gets its share, the last one too
    places = sorted(free.index(g) for g in got)
    for stretch in (2, 3, 5, 10):
        for k in range(stretch):
            lo, hi = len(free) * k / stretch, len(free) * (k + 1) / stretch
            assert abs(sum(lo <= p < hi for p in places) - n / stretch) <= 2


def test_no_negatives_in_a_full_grid(spark):
    train = spark.createDataFrame([(u, i) for u in range(3) for i in range(3)], "user_idx long, item_idx long")
    assert recommend.negative_pairs(train, 3, 3, short="keep").count() == 0
    assert recommend.negative_pairs(train.limit(0), 3, 3).count() == 0


def test_ids_are_dense(spark):
    f = features(spark, {(7, 100): 1, (3, 50): 2, (7, 50): 3})
    both, users, items = recommend.indexed_features(f)
    assert rows(users) == [(3, 0), (7, 1)] and rows(items) == [(100, 1), (50, 0)]
    assert rows(both.select("user_idx", "item_idx", "interaction_score")) == [(0, 0, 2), (1, 0, 3), (1, 1, 1)]


def test_popular_list_by_join(spark):
    f = features(spark, random_pairs(2, 30, 20, 300))
    train, held = recommend.holdout_split(f)
    popular = recommend.popular_items(train, 5)
    assert recommend.popular_hit_rate(popular, held).first() == recommend.hit_rate(recommend.recommend_popular(held, popular), held).first()


@pytest.mark.parametrize("blocks", [(8192, 32768), (7, 5)])
def test_dot_topk_against_brute_force(spark, blocks):
    rng = np.random.default_rng(5)
    u, v = rng.integers(-3, 4, (40, 4)).astype(float), rng.integers(-3, 4, (33, 4)).astype(float)  # many equal scores
    users = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(u)], "user_id long, vec array<float>")
    items = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "item_id long, vec array<float>")
    got = recommend.dot_topk(users, items, 4, *blocks)
    want = []
    for i, scores in enumerate(u @ v.T):
        for place, j in enumerate(sorted(range(33), key=lambda j: (-scores[j], j))[:4], 1):
            want.append((i, j, float(scores[j]), place))
    assert rows(got.select("user_id", "item_id", "score", "place")) == sorted(want, key=repr)


def test_hit_rate(spark):
    held = features(spark, {(1, 1): 1, (2, 2): 1, (3, 3): 1, (4, 4): 1})
    recs = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3), (3, 3)], "user_id long, item_id long")
    assert recommend.hit_rate(recs, held).first().asDict() == {"hits": 2, "holdout_rows": 4, "hit_rate": 0.5}
    assert recommend.hit_rate(recs, held.limit(0)).first().hit_rate == 0.0


def test_als_and_seen_items(spark):
    f = features(spark, random_pairs(9, 20, 15, 150))
    both, users, items = recommend.indexed_features(f)
    recs = recommend.top_items(recommend.fit_als(both, rank=4, iterations=3), users, items, k=5)
    assert recs.groupBy("user_id").count().filter("count <> 5").count() == 0
    fresh = recommend.without_seen(recs, f)
    assert fresh.join(f, ["user_id", "item_id"]).count() == 0
    assert fresh.count() + recs.join(f, ["user_id", "item_id"], "left_semi").count() == recs.count()


def test_promotion_needs_a_strictly_better_challenger(spark):
    path = work_path(spark, "runs")
    figure = spark.range(1).select(F.lit(0.5).alias("hit_rate"))
    recommend.log_run(path, figure, "r1", "old", {"k": 10}, "hit_rate")
    recommend.log_run(path, figure, "r2", "new", {"k": 10, "rank": 20}, "hit_rate")
    runs = spark.read.schema(recommend.RUN_SCHEMA).parquet(path)
    assert recommend.promote(runs, "old", "new").first().next_champion == "old"
    recommend.log_run(path, figure.withColumn("hit_rate", F.lit(0.6)), "r3", "new", {"k": 10}, "hit_rate")
    runs = spark.read.schema(recommend.RUN_SCHEMA).parquet(path)
    won = recommend.promote(runs, "old", "new").first()
    assert won.promoted and won.next_champion == "new" and won.margin == pytest.approx(0.1)
    assert runs.count() == 3
    assert recommend.promote(runs, "old", "missing").first().next_champion == "old"


# --- the helpers underneath ------------------------------------------------------

def test_numbering_is_dense_and_sorted(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("x"))
    got = numbered(df, "x").orderBy("x").collect()
    assert [r.position for r in got] == list(range(1000))


def test_last_known_crosses_blocks(spark):
    data = [(i, (i // 100) * 10 if i % 100 == 0 else None) for i in range(2, 1000)]
    df = spark.createDataFrame(data, "x long, v long")
    got = last_known(df, ["x"], "v", "seen").orderBy("x").collect()
    assert [r.seen for r in got] == [None if x < 100 else (x // 100) * 10 for x in range(2, 1000)]


def test_running_total(spark):
    df = spark.range(500).select("id", (F.col("id") % 13).alias("v"), F.floor(F.col("id") / 50).alias("b"))
    got = running_total(df, "b", "id", {"total": F.col("v"), "n": F.lit(1)}).orderBy("id").collect()
    assert [r.total for r in got] == np.cumsum([i % 13 for i in range(500)]).tolist()
    assert [r.n for r in got] == list(range(1, 501))


def test_range_blocks_split_a_hot_prefix(spark):
    """Blocks are cut inside a user that holds most rows, as the order goes on past the user."""
    df = spark.range(4000).select(F.when(F.col("id") < 3000, 1).otherwise(F.col("id")).alias("u"), F.col("id").alias("i"))
    sizes = [r["count"] for r in range_blocks(df, "u", "i").groupBy("_block").count().collect()]
    assert len(sizes) > 4 and max(sizes) < 1500


@pytest.mark.parametrize("n", [0, 1, 10, 333, 1000, 5000])
def test_first_rows(spark, n):
    far = 4 * 10**18
    keys = [*range(400), *range(far, far + 150), *{random.Random(i).randrange(10**18) for i in range(450)}]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    for buckets in (3, 10_000):
        assert [r.k for r in first_rows(df, "k", n, buckets).orderBy("k").collect()] == sorted(keys)[:n]


def test_rank_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 2), ("a", 1), ("b", 1)], "k string, v int")
    assert rows(ranked_per_key(df, ["k"], [F.desc("v")], 2, "r")) == [("a", 3, 1), ("a", 3, 1), ("b", 1, 1)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_key_with_a_third_of_the_rows(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    kept = first_per_key(df, ["k"], [F.asc("id")])
    # the limit runs before the shuffle, so the hot key sends one row per task
    assert plan(kept).count("WindowGroupLimit") == 2
    assert kept.count() == 20001
