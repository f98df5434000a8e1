import math
import random

import pytest
from pyspark.sql import functions as F

from fieldglass.llm import topk_search as S

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k):
    good = [(key, [math.floor(64 * x) for x in v]) for key, v, _ in rows if key is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for i, (q, v) in enumerate(good):
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, x)), key) for j, (key, x) in enumerate(good) if i != j and len(x) == len(v))
            for rank, (score, key) in enumerate(scored[:k], 1):
                yield q, rank, key, -score


@pytest.mark.parametrize("dims, k", [(64, 20), (6, 3), (1, 5)])
def test_same_as_brute_force(spark, monkeypatch, dims, k):
    monkeypatch.setattr(S, "BLOCK", 50)
    monkeypatch.setattr(S, "CELL", 150)
    monkeypatch.setattr(S, "QUERY_BLOCK", 16 if dims == 64 else 1000)
    rng = random.Random(dims)
    centre = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    rows = [(i, [float(c + rng.gauss(0, 0.3)) for c in rng.choice(centre)], 0) for i in range(400)]
    # float32 is what is stored
    rows = [(i, [float(x) for x in __import__("numpy").array(v, "float32")], c) for i, v, c in rows]
    rows += [(1000 + i, list(rows[i % 3][1]), 0) for i in range(60)]
    rows += [(2000, None, 0), (2001, [None] * dims, 0), (2002, [math.nan] * dims, 0), (2020, [math.inf] * dims, 0), (2003, [1.0, 2.0, 3.0], 0), (2040, [2.0, 2.0, 2.0], 0), (None, rows[0][1], 0), (2060, [], 0), (2061, [], 0), rows[5], rows[20]]
    rng.shuffle(rows)
    got = S.search(spark.createDataFrame(rows, SCHEMA).withColumn("v", F.lit("clash")), F.col("vec_id") % 20 == 0, k)
    assert sorted(map(tuple, got.collect())) == sorted(brute(rows, k))


def test_empty_table(spark):
    assert S.search(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_bounds_are_bounds_and_spare_products():
    import numpy as np

    rng = np.random.default_rng(1)
    wave = np.cumsum(rng.normal(size=(3000, 64)), axis=1)
    v = np.floor(64 * wave).astype(np.int64)
    ids = np.arange(3000)[:, None] * np.array([1, 1])
    own = S.Best(ids[:20], v[:20], 5)
    for at in range(0, 3000, 300):
        own.offer(ids[at : at + 300], v[at : at + 300])
    assert own.computed < own.seen / 2
    first = S.Best(ids[:20], v[:20], 5)
    first.offer(ids, v)
    assert first.computed < first.seen * 0.7
    full = v[:20] @ v.T
    for q in range(20):
        want = sorted((-s, j) for j, s in enumerate(full[q]) if j != q)[:5]
        assert sorted((-s, j) for s, j in zip(own.score[own.query == q], own.vec[own.query == q])) == want
