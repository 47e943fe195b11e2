from __future__ import annotations

import numpy as np
import pytest

from tests.conftest import rows
from tidemill.operators import recommend


def frames(spark, u, v):
    users = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(u)], "user_id long, vec array<double>")
    items = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(v)], "item_id long, vec array<double>")
    return users, items


def plain(u, v, k):
    scores = np.round(np.asarray(u, float) @ np.asarray(v, float).T, 9)
    out = []
    for i, row in enumerate(scores):
        best = sorted(range(len(row)), key=lambda j: (-row[j], j))[:k]
        out += [(i, j, float(row[j]), p + 1) for p, j in enumerate(best)]
    return sorted(out)


def got(top):
    return sorted((r.user_id, r.item_id, r.score, r.place) for r in top.best.collect())


@pytest.mark.parametrize("scale", ["equal", "steep", "whole"])
def test_as_all_pairs(spark, scale):
    rng = np.random.default_rng(7)
    u, v = rng.normal(size=(60, 8)), rng.normal(size=(90, 8))
    if scale == "steep":
        v = v / np.linalg.norm(v, axis=1, keepdims=True) * (2.0 ** -np.arange(90))[:, None] * 1e6
    if scale == "whole":  # many ties, within blocks and across them
        u, v = rng.integers(-1, 2, size=(60, 3)), rng.integers(-1, 2, size=(90, 3))
    top = recommend.bounded_topk(*frames(spark, u, v), k=7, user_rows=20, item_rows=10)
    assert got(top) == plain(u, v, 7)
    assert top.pairs == 5400 and top.scored <= top.pairs
    if scale == "steep":
        assert top.scored < top.pairs / 2


def test_zero_vectors_and_few_items(spark):
    u, v = [[0, 0], [1, 2]], [[0, 0], [3, 1], [0, 0]]
    top = recommend.bounded_topk(*frames(spark, u, v), k=5, item_rows=1)
    assert got(top) == plain(u, v, 5) and top.scored == top.pairs == 6  # with fewer than k items none can be skipped


def test_no_users_or_items(spark):
    users, items = frames(spark, [[1, 2]], [[3, 4]])
    assert recommend.bounded_topk(users.limit(0), items).best.count() == 0
    assert recommend.bounded_topk(users, items.limit(0)).best.count() == 0


def test_all_users_done_early(spark):
    u, v = [[1, 0]] * 5, [[100 - i, 0] for i in range(40)]
    top = recommend.bounded_topk(*frames(spark, u, v), k=2, item_rows=4)
    assert got(top) == plain(u, v, 2) and top.scored == 5 * 4
    assert rows(recommend.dot_topk(*frames(spark, u, v), k=2).select("user_id", "item_id")) == [(i, j) for i in range(5) for j in (0, 1)]


@pytest.mark.parametrize("equal", [False, True])
def test_small_blocks_share_tasks(spark, equal, monkeypatch):
    """Sixty blocks in six strips and three groups of users: right, and handed out as strips, not block by block."""
    rng = np.random.default_rng(8)
    u, v = rng.normal(size=(30, 4)), rng.normal(size=(300, 4))
    if equal:
        v = np.repeat(v[:10], 30, axis=0)  # copies tie within strips and across them
    sent = []
    numbering = recommend.numbered
    monkeypatch.setattr(recommend, "numbered", lambda *a: sent.append(1) or numbering(*a))
    top = recommend.bounded_topk(*frames(spark, u, v), k=7, user_rows=5, item_rows=5, task_users=10, task_items=50)
    assert got(top) == plain(u, v, 7) and top.scored < top.pairs and sent == [1]
    # at the sizes of the jobs the same blocks are one strip, which needs no order and one round
    one = recommend.bounded_topk(*frames(spark, u, v), k=7, user_rows=5, item_rows=5)
    assert got(one) == plain(u, v, 7) and one.scored < one.pairs and sent == [1]
