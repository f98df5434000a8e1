"""Exact top-k search by inner product, with multi-resolution segment statistics.

Vectors become integers, floor(64 * x).  A vector cut into segments has in each a mean and a deviation (the norm of what
is left without the mean), and for two vectors

    q . x <= sum over segments of (length * mean_q * mean_x + deviation_q * deviation_x),

which is the lower bound |q|^2 + |x|^2 - 2 * bound on their squared distance.  Coarse segments first, then fine ones: a
candidate whose bound is under the k-th best score so far is done with, the survivors' products are computed exactly, in
integers.  In its first block, a query's k-th best score comes from the products of the k candidates of highest coarse
bounds.

Queries are a stated set and meet all rows in blocks: rows are packed into blocks, every block of queries meets every cell
of candidate blocks in one task, in which the k best so far carry over from block to block.  A task holds a block of
``QUERY_BLOCK`` queries, in parts of ``BLOCK`` rows, and one part of the candidates at a time; so a candidate travels once
for every ``QUERY_BLOCK`` queries, which is what the search shuffles.  Cells number ``CELLS`` at most, so a query has at most ``CELLS * k`` rows left for the last ranking.

Defined results: vectors that are null, or hold a null or a component that isn't finite, take no part, nor do rows without
a vec_id; each of several rows with one vec_id is a query and a candidate of its own, against all rows but itself; only
vectors as long as the query's are compared; equal scores rank by vec_id; components are meant to be under 2 ** 31 / 64 in
size, so that products fit into longs; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.llm._shared import stored

SEGMENTS = (4, 16)
QUERY_BLOCK = 16384
BLOCK = 2048
CELL = 8192
CELLS = 64
#: Products of smaller numbers are exact in double precision, sums of a million of them too.
EXACT = 1 << 16


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): vectors that take part, as integers."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).where(~F.coalesce(bad, F.lit(True)))
    v = F.transform("embedding", lambda x: F.floor(F.lit(64.0) * x.cast("double")))
    return good.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, row, vec_id, v) to blocks (key, dims, ids, values) of at most BLOCK rows; ids are pairs (row, vec_id)."""
    held: dict[tuple, list] = {}

    def block(key: tuple, rows: list) -> pa.RecordBatch:
        ids = np.array([x[:2] for x in rows], np.int64)
        return pa.RecordBatch.from_pydict({"key": pa.array([key[0]], pa.int32()), "dims": pa.array([key[1]], pa.int32()), "ids": [ids.tobytes()], "data": [np.array([x[2] for x in rows], np.int64).reshape(len(rows), key[1]).tobytes()]})

    for batch in batches:
        for key, row, vec_id, v in zip(*(batch.column(c).to_pylist() for c in ("key", "row", "vec_id", "v")), strict=True):
            own = held.setdefault((key, len(v)), [])
            own.append((row, vec_id, v))
            if len(own) == BLOCK:
                yield block((key, len(v)), held.pop((key, len(v))))
    for key, rows in held.items():
        yield block(key, rows)


_PACKED = "key int, dims int, ids binary, data binary"


def statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums and deviations of each vector's segments, and the segments' lengths."""
    cut = np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(np.int64)
    length = np.diff(cut).astype(np.float64)
    x = v.astype(np.float64)
    total = np.add.reduceat(x, cut[:-1], axis=1)
    square = np.add.reduceat(x * x, cut[:-1], axis=1) - total * total / length
    return total, np.sqrt(np.maximum(square, 0)), length


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    if max(np.abs(q).max(initial=0), np.abs(x).max(initial=0)) < EXACT:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


class Best:
    """The k best candidates so far of a block of queries."""

    def __init__(self, ids: np.ndarray, v: np.ndarray, k: int) -> None:
        self.ids, self.v, self.k = ids, v, k
        self.levels = [statistics(v, n) for n in SEGMENTS] if v.shape[1] else []
        self.query, self.vec, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), np.iinfo(np.int64).min)
        self.computed = self.seen = 0

    def offer(self, ids: np.ndarray, v: np.ndarray) -> None:
        """A block of candidates; ids are pairs (row, vec_id)."""
        rows, columns = np.arange(len(self.ids)), np.arange(len(ids))
        alive = self.ids[:, None, 0] != ids[None, :, 0]
        self.seen += int(alive.sum())
        floor = self.least.astype(np.float64)
        for (total, deviation, length), n in zip(self.levels, SEGMENTS, strict=False):  # none without components
            if len(columns) and len(rows):
                other, spread, _ = statistics(v[columns], n)
                bound = (total[rows] / length) @ other.T + deviation[rows] @ spread.T
                if n == SEGMENTS[0] and len(columns) > 4 * self.k:
                    floor = self.seeded(floor, bound, alive, v)
                # Bounds are rounded: they get a little more than they can have lost.
                alive = alive & (bound + 1e-9 * np.abs(bound) + 1e-6 >= floor[rows][:, None])
                keep_row, keep_column = alive.any(axis=1), alive.any(axis=0)
                rows, columns, alive = rows[keep_row], columns[keep_column], alive[keep_row][:, keep_column]
        if not len(rows) or not len(columns):
            return
        got = products(self.v[rows], v[columns])
        self.computed += got.size
        got[~alive] = np.iinfo(np.int64).min
        floor = self.least[rows]
        if len(columns) > self.k:
            floor = np.maximum(floor, np.partition(got, len(columns) - self.k, axis=1)[:, len(columns) - self.k])
        i, j = np.nonzero(alive & (got >= floor[:, None]))
        self.query = np.concatenate((self.query, rows[i]))
        self.vec = np.concatenate((self.vec, ids[columns[j], 1]))
        self.score = np.concatenate((self.score, got[i, j]))
        order = np.lexsort((self.vec, ~self.score, self.query))
        query = self.query[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        order = order[place < self.k]
        self.query, self.vec, self.score = self.query[order], self.vec[order], self.score[order]
        last = place[place < self.k] == self.k - 1
        self.least[self.query[last]] = self.score[last]

    def seeded(self, floor: np.ndarray, bound: np.ndarray, alive: np.ndarray, v: np.ndarray) -> np.ndarray:
        """floor, and for queries that have none yet the least product of the k candidates of highest bounds."""
        new = np.flatnonzero(self.least == np.iinfo(np.int64).min)
        if not len(new):
            return floor
        best = np.argpartition(np.where(alive[new], -bound[new], np.inf), self.k, axis=1)[:, : self.k]
        got = np.stack([v[best[i]] @ self.v[q] for i, q in enumerate(new)])
        self.computed += got.size
        out = floor.copy()
        out[new] = np.where(np.take_along_axis(alive[new], best, axis=1), got, np.iinfo(np.int64).min).min(axis=1)
        return out


def search(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest scores, its own row left out."""
    rows = stored(integers(vectors).withColumn("is_query", F.coalesce(is_query, F.lit(False))).withColumn("row", F.monotonically_increasing_id()), "integer-vectors")
    n, n_query = rows.agg(F.count(F.lit(1)), F.count_if("is_query")).first()
    blocks, cells = max(1, -(-n_query // QUERY_BLOCK)), min(CELLS, max(1, -(-n // CELL)))

    def packed(of: DataFrame, parts: int, salt: int) -> DataFrame:
        key = F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(parts)).cast("int")
        return of.select(key.alias("key"), "row", "vec_id", "v").repartition(parts, "key").mapInArrow(_pack, _PACKED)

    queries = packed(rows.where("is_query"), blocks, 1).withColumnRenamed("key", "block").withColumn("cell", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))))
    others = packed(rows, cells, 2).withColumnRenamed("key", "cell").withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    both = queries.withColumn("candidates", F.lit(False)).unionByName(others.withColumn("candidates", F.lit(True)))
    tasks = both.repartition(blocks * cells, "block", "cell").sortWithinPartitions("block", "cell", "dims", "candidates", F.xxhash64("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            for own in held:
                yield pa.RecordBatch.from_arrays([*(pa.array(own.ids[own.query, k]) for k in (0, 1)), pa.array(own.vec), pa.array(own.score)], ["query", "query_id", "vec_id", "score"])

        for batch in batches:
            for block, cell, dims, candidates, ids, data in zip(*(batch.column(c).to_pylist() for c in ("block", "cell", "dims", "candidates", "ids", "data")), strict=True):
                if at != (block, cell, dims):
                    yield from done()
                    at, held = (block, cell, dims), []
                ids = np.frombuffer(ids, np.int64).reshape(-1, 2)
                v = np.frombuffer(data, np.int64).reshape(len(ids), dims)
                if candidates:
                    for own in held:
                        own.offer(ids, v)
                else:
                    held.append(Best(ids, v, k))
        yield from done()

    found = tasks.mapInArrow(run, "query long, query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5_topk_search(spark, sf_dir: str) -> DataFrame:
    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
