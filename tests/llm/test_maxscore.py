"""Top k against plain integer arithmetic, over many shards and blocks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedline.llm import maxscore


def plain(ids, weights, query_ids, queries, k):
    scores = queries.astype(object) @ weights.astype(object).T
    out = []
    for i, line in zip(query_ids.tolist(), scores.tolist()):
        ranked = sorted((-s, c) for s, c in zip(line, ids.tolist()) if c != i)[:k]
        out += [(i, c, -s) for s, c in ranked]
    return sorted(out)


def drawn(rng, kind, n, dims, most):
    weights = rng.integers(-most, most + 1, size=(n, dims))
    if kind == "one vector often":
        weights[: n // 2] = weights[0]
    elif kind == "few terms":
        weights[rng.random(weights.shape) < 0.9] = 0
    elif kind == "all below zero":
        weights = -abs(weights)
    return weights


@pytest.mark.parametrize("most", [3, 160, 30_000, 10**8])
@pytest.mark.parametrize("kind", ["dense", "one vector often", "few terms", "all below zero"])
def test_search_is_plain_arithmetic(monkeypatch, kind, most):
    monkeypatch.setattr(maxscore, "STRETCH", 40)
    monkeypatch.setattr(maxscore, "AT_ONCE", 7)
    rng = np.random.default_rng(most)
    for dims, n in ((0, 9), (1, 100), (5, 400), (16, 400)):
        weights, ids = drawn(rng, kind, n, dims, most), rng.integers(0, 2 * n, size=n)
        largest = int((weights.astype(object) ** 2).sum(axis=1).max()) if dims else 0
        for number in ("f4", "f8", "i8"):
            if largest >= {"f4": 2**24, "f8": 2**52, "i8": 2**62}[number]:
                continue
            asking = maxscore.Search(ids[:30], weights[:30], number, 5)
            for part in np.array_split(rng.permutation(n), 3):
                asking.meet(maxscore.Postings(ids[part], weights[part], number))
            found = asking.found()
            assert sorted(zip(*(found.column(c).to_pylist() for c in range(3)))) == plain(ids, weights, ids[:30], weights[:30], 5)


def searched(spark, ids, weights):
    frame = spark.createDataFrame([(int(i), [int(x) for x in w]) for i, w in zip(ids, weights)], "vec_id bigint, v array<bigint>")
    return maxscore.search(frame, F.col("vec_id") % 3 == 0)


@pytest.mark.parametrize("most", [160, 2**15, 2**29])
def test_many_shards_and_blocks(spark, monkeypatch, most):
    monkeypatch.setattr(maxscore, "SHARD_VECTORS", 11)
    monkeypatch.setattr(maxscore, "QUERY_BLOCK", 9)
    monkeypatch.setattr(maxscore, "TASK_BYTES", 600)
    monkeypatch.setattr(maxscore, "TASKS", 24)
    rng = np.random.default_rng(3)
    ids, weights = np.arange(200), drawn(rng, "one vector often", 200, 5, most)
    asks = ids % 3 == 0
    got = sorted((r.query_id, r.vec_id, r.score) for r in searched(spark, ids, weights).collect())
    assert got == plain(ids, weights, ids[asks], weights[asks], 5)


def test_no_meeting_goes_through_the_driver(spark):
    out = searched(spark, np.arange(200), drawn(np.random.default_rng(4), "dense", 200, 5, 160))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "Broadcast" not in plan
