"""Hard negatives against plain integer arithmetic."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedline.llm import hard_negatives

ROWS = "vec_id bigint, embedding array<double>, label int, row string, v string, score string"


def mined(frame):
    rows = hard_negatives.relabelled(hard_negatives.prepared(frame))
    return sorted(map(tuple, hard_negatives.mine(rows, F.col("vec_id") % 50 == 0).collect()))


def plain(rows):
    used = {
        (i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in v))
        for i, v, label in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a, la, va in used:
        if a % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, label, v in used if i != a)
        for minus, p, _ in [s for s in scored if s[2] == la][:5]:
            ps = -minus
            hard = [(i, -m) for m, i, label in scored if label != la and 50 * ps <= 100 * -m <= 95 * ps]
            out += [(a, p, r + 1, i, ps, s) for r, (i, s) in enumerate(hard[:3])]
    return sorted(out)


@pytest.mark.parametrize("tile", [(8192, 4096), (30, 2)])
def test_mined_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(hard_negatives, "ROWS", tile[0])
    monkeypatch.setattr(hard_negatives, "ANCHORS", tile[1])
    monkeypatch.setattr(hard_negatives, "AT_ONCE", 3)
    rng = random.Random(2)
    rows = [(i, [round(rng.gauss(0.3, 0.5), 1) for _ in range(rng.choice([8, 8, 5]))], rng.choice([0, 1, 2, 9])) for i in range(420)]
    rows += [(1000 + i, rows[3][1], i % 3) for i in range(25)]  # ties
    rows += [(None, [1.0], 1), (2, None, 1), (50, [1.0], None), (51, [None], 1), (52, [float("nan")], 0), (53, [float("inf")], 0), (100, [], 3)]
    frame = spark.createDataFrame([(*r, "clash", "clash", "clash") for r in [*rows, rows[0], rows[5]]], ROWS)
    assert mined(frame) == plain(rows) and len(plain(rows)) > 50
    assert mined(frame.where("false")) == []


def test_scores_are_exact():
    rng = np.random.default_rng(0)
    for dims, most in ((1, 5), (64, 256), (700, 4000), (70, 2**25)):
        a, b = (rng.integers(-most, most + 1, (n, dims)) for n in (7, 11))
        a[0], b[0], b[1] = most, most, -most
        primes = hard_negatives.primes_for(dims * most**2)
        rows = hard_negatives.Rows(np.arange(11), np.zeros(11), b, primes)
        assert (rows.scores([hard_negatives.residues(a, p) for p in primes]) == a @ b.T).all()
    with pytest.raises(ValueError):
        hard_negatives.primes_for(2**62)
