import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import embedding_dedup as D

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(vec_id, n_links, component_id, kept) of each row, from all pairs."""
    good = [k for k, (i, v, label) in enumerate(rows) if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for label, size in {(rows[k][2], len(rows[k][1])) for k in good}:
        own = [k for k in good if (rows[k][2], len(rows[k][1])) == (label, size)]
        u = np.array([rows[k][1] for k in own], float)
        u /= np.linalg.norm(u, axis=1)[:, None]
        for a, b in np.argwhere(u @ u.T >= 0.98):
            if a != b:
                links[own[a]].add(own[b])
    seen, out = set(), []
    for k in range(len(rows)):
        if k in seen:
            continue
        group, todo = {k}, [k]
        while todo:
            new = links[todo.pop()] - group
            group |= new
            todo += new
        seen |= group
        least = min((rows[x][0] for x in group), key=lambda i: (i is not None, i or 0))
        out += [(rows[x][0], len(links[x]), least, rows[x][0] == least) for x in group]
    return out


def unit(rng, dims):
    v = rng.normal(size=dims)
    return v / np.linalg.norm(v)


def near(rng, v, cosine):
    w = unit(rng, len(v))
    w -= (w @ v) * v
    return cosine * v + math.sqrt(1 - cosine**2) * w / np.linalg.norm(w)


def key(r):
    return tuple(map(repr, r))


def run(spark, rows):
    df = spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], label) for i, v, label in rows], SCHEMA)
    df = df.withColumns({"v": F.lit("clash"), "node": F.lit(1), "a.b": F.lit(0)})
    return sorted((tuple(r) for r in D.near_duplicates(df).select("vec_id", "n_links", "component_id", "kept").collect()), key=key)


@pytest.mark.parametrize("block", [1024, 20])
def test_same_as_all_pairs(spark, monkeypatch, block):
    """Groups of copies, near copies and chains; leaders in one block and in many."""
    monkeypatch.setattr(D, "BLOCK", block)
    rng = np.random.default_rng(3)
    rows = [(i, unit(rng, 64).astype("float32"), int(rng.integers(3))) for i in range(300)]
    centre = unit(rng, 64)
    rows += [(1000 + i, near(rng, centre, 0.994).astype("float32"), 1) for i in range(120)]
    rows += [(2000 + i, rows[5][1] * (1 + i % 2), 1 + i % 2) for i in range(40)]
    v = unit(rng, 64)
    for i in range(10):
        rows.append((3000 - i, v.astype("float32"), 0))
        v = near(rng, v, 0.996)
    zero = [0.0] * 64
    rows += [(4000, None, 1), (4001, zero, 1), (4002, zero, 1), (4003, [None, *zero[1:]], 1), (4004, [math.nan] * 64, 1), (4005, [math.inf] * 64, 1), (4006, rows[0][1], None), (4007, rows[0][1], None)]
    rows += [(None, rows[0][1], 0), (None, rows[0][1], 0), (7, rows[8][1], rows[8][2]), (7, rows[8][1], rows[8][2]), (4008, [1.0, 2.0], 1), (4009, [2.0, 4.0], 1), (4010, [], 1), (4011, [], 1)]
    random.Random(1).shuffle(rows)
    assert run(spark, rows) == sorted(brute(rows), key=key)


def test_sizes_of_components_play_no_part(spark):
    rows = [(1, [1e-30, 0.0], 1), (2, [3e38, 0.0], 1), (3, [0.0, 1e-38], 1)]
    assert run(spark, rows) == sorted([(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)], key=key)


def test_recall_of_single_pairs():
    """Pairs that stand alone share a cell: about 97 in 100 at the threshold itself, more above it."""
    rng = np.random.default_rng(5)
    for cosine, least in ((0.98, 0.95), (0.985, 0.98), (0.99, 0.995), (1 - 1e-9, 1)):
        a = np.stack([unit(rng, 64) for _ in range(3000)])
        b = np.stack([near(rng, v, cosine) for v in a])
        salt = np.zeros(len(a), np.uint64)
        one, two = D.cells(a, salt), D.cells(b, salt)
        assert (one[:, :, None] == two[:, None, :]).any((1, 2)).mean() >= least
    other = D.cells(np.stack([unit(rng, 64) for _ in range(3000)]), salt)
    assert not (one[:, :, None] == other[:, None, :]).any()


def test_decodes_to_the_nearest_lattice_point():
    rng = np.random.default_rng(1)
    y = rng.normal(0, 2, (2000, 8))
    point = D.decoded(y)
    whole = np.all(point == np.rint(point), axis=1)
    assert (whole | np.all(point + 0.5 == np.rint(point + 0.5), axis=1)).all() and (point.sum(1) % 2 == 0).all()
    at = ((y - point) ** 2).sum(1)
    assert all(at.max() <= 1 + 1e-9 and (((y - point - r) ** 2).sum(1) >= at - 1e-9).all() for r in D.roots())
    assert len({tuple(r) for r in D.roots()}) == 240 and np.allclose((D.roots() ** 2).sum(1), 2)


def test_least_reached():
    link = np.zeros((6, 6), bool)
    for a, b in itertools.pairwise((4, 2, 5, 0)):
        link[a, b] = link[b, a] = True
    assert D.least_reached(link, np.array([9, 8, 7, 6, 5, 11])).tolist() == [5, 8, 5, 6, 5, 5]


def test_no_rows(spark):
    assert run(spark, []) == []
