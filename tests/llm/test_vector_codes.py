import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows):
    """(codes, books) by comparing every part with every entry."""
    kept = [(i, label, [math.floor(256 * x) for x in v]) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    w = len(kept[0][2]) // 16
    part = lambda v, p: v[p * w : p * w + w]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:64]
    books = [[part(r[2], p) for r in first] for p in range(16)]

    def nearest(v):
        out = []
        for p in range(16):
            d = [sum((a - b) ** 2 for a, b in zip(part(v, p), entry, strict=True)) for entry in books[p]]
            out.append((min(d), d.index(min(d))))
        return out

    for _ in range(2):
        codes = [nearest(r[2]) for r in kept]
        for p in range(16):
            for k in range(len(books[p])):
                own = [part(r[2], p) for r, c in zip(kept, codes, strict=True) if c[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    codes = [nearest(r[2]) for r in kept]
    return [(i, label, bytes(k for _, k in c), sum(d for d, _ in c)) for (i, label, _), c in zip(kept, codes, strict=True)], books


def made(n, dims, seed, spread=0.2):
    rng = np.random.default_rng(seed)
    centre = rng.normal(0, 0.3, (9, dims))
    rows = [(int(i * 3 % 1009), [float(x) for x in (centre[rng.integers(9)] + rng.normal(0, spread, dims)).astype("float32")], int(rng.integers(4)) or None) for i in range(n)]
    return rows


@pytest.mark.parametrize("n, dims, spread", [(400, 64, 0.2), (300, 16, 0.01), (40, 32, 0.2), (1, 16, 0.2), (200, 48, 3.0)])
def test_same_as_comparing_all(spark, n, dims, spread):
    rows = made(n, dims, n, spread)
    rows += rows[: n // 4] + [(7, rows[0][1], 3), (None, rows[0][1], 1), (5000, [0.0] * dims, None), (5001, None, 1), (5002, [None] * dims, 1), (5003, [math.nan] * dims, 1), (5004, [math.inf] + [0.0] * (dims - 1), 1)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit("clash"), "code": F.lit(1), "need": F.lit(2), "a.b": F.lit(0)})
    codes, books = V.compress(df)
    want, want_books = brute(rows)
    assert books.tolist() == want_books
    key = lambda r: (repr(r[0]), repr(r[1]), r[2])
    assert sorted(((r.vec_id, r.label, bytes(r.code), r.error) for r in codes.collect()), key=key) == sorted(want, key=key)


def test_query_columns(spark, tmp_path):
    rows = made(150, 64, 3)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/embeddings.parquet")
    want, books = brute(rows)
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by = {}
    for _, label, _, error in want:
        by[label] = by.get(label, 0) + error
    got = V.op13_vector_codes(spark, str(tmp_path)).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()
    assert sorted(map(tuple, got)) == sorted((i, c.hex(), e, by[label], digest) for i, label, c, e in want)


def test_bounds_spare_comparisons_and_are_bounds():
    rng = np.random.default_rng(2)
    x = np.floor(256 * rng.normal(0, 0.3, (3000, 4))).astype(np.int64)
    book = x[:64].copy()
    part = V.Part.compared(x, book, 16)
    for n in range(4):
        count = np.bincount(part.own, minlength=64)
        total = np.zeros_like(book)
        np.add.at(total, part.own, x)
        new = np.where(count[:, None] > 0, total // np.maximum(count, 1)[:, None], book)
        need = part.moved(x, new, V.drifts(book[None], new[None])[0])
        book = new
        d = V.squares(x, book)
        assert (part.own == d.argmin(1)).all()
        near = np.sqrt(np.take_along_axis(d, part.near, axis=1))
        assert (part.bound[:, :-1] <= near).all()
        rest = d.astype(float)
        np.put_along_axis(rest, np.concatenate((part.own[:, None], part.near), axis=1), np.inf, axis=1)
        assert (part.bound[:, -1] <= np.sqrt(rest.min(1))).all()
        part.cut(16 - 2 * n)
    assert np.minimum(need, 64).mean() < 8  # of 64 entries


def test_decoded():
    books = np.arange(16 * 3 * 2).reshape(16, 3, 2)
    assert V.decoded(bytes([2] * 16), books)[:2].tolist() == [4 / 256, 5 / 256]


def test_no_rows_and_wrong_rows(spark):
    assert V.compress(spark.createDataFrame([], SCHEMA))[0].count() == 0
    assert V.compress(spark.createDataFrame([(1, None, 1)], SCHEMA))[0].count() == 0
    for rows in ([(1, [1.0] * 16, 0), (2, [1.0] * 32, 0)], [(1, [1.0] * 15, 0)], [(1, [], 0)], [(1, [1e6] * 16, 0)]):
        with pytest.raises(Exception, match="one length|can't be coded"):
            V.compress(spark.createDataFrame(rows, SCHEMA))
