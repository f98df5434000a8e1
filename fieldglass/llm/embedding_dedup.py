"""Near-duplicates among embeddings, by lattice hashing.

Vectors of one label are compared by cosine.  In each of ``TABLES`` tables a unit vector is projected at random to
``BLOCKS`` times eight dimensions, scaled by 1 / ``WIDTH``, and every eight are decoded to the nearest point of the E8
lattice: the points are the vector's cell.  A vector also takes the ``PROBES`` cells next to its own that are nearest to its
projection, each one lattice step away in one block.  Vectors that share a cell of a table are candidates.

So that a pair is compared once and a group of copies isn't written out in pairs, a cell is led by its least vector, and a
vector follows the leaders of its cells; most cells of a dense group have the same few leaders.  All followers of a leader
are compared with each other, in blocks of ``BLOCK`` rows, by matrix products in double precision; a pair counts where its
least common leader is met.  A task gives a row for each of its vectors: how many it is linked with, and the least vector of
its part of the graph.  A leader of many followers is dealt out over tasks by pairs of blocks.

Copies of one vector are one row from the start, with their number.  Hashes and cells are found by 64-bit hashes, so
results are exact but for their collisions, and for the pairs that share no cell: of pairs at a cosine of 0.98 about one in
forty that stand alone, fewer above it and hardly any within groups (the tests measure it against all pairs).

Defined results: a vector that is null, or zero, or holds a null or a component that isn't finite, and one without a label
or without a vec_id, links with nothing and is kept; only vectors of one length are compared; several rows with one vec_id
are rows of their own, and those with one vector link with each other; a row is kept if its vec_id is the least of its
component, so copies with that vec_id all are; other columns play no part; no rows give none.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._kernels import i64, mix
from fieldglass.llm._shared import Tables, stored
from fieldglass.llm.components import components

COSINE = 0.98
TABLES, BLOCKS, PROBES, WIDTH = 5, 2, 3, 1.1
SEED = 20240
#: Followers of a leader that are compared at once.
BLOCK = 1024


@cache
def roots() -> np.ndarray:
    """The 240 shortest vectors of E8: the steps from a lattice point to its nearest neighbours."""
    pairs = [(i, j, s, t) for i, j in itertools.combinations(range(8), 2) for s in (1, -1) for t in (1, -1)]
    whole = np.zeros((len(pairs), 8))
    for k, (i, j, s, t) in enumerate(pairs):
        whole[k, [i, j]] = s, t
    halves = np.array([x for x in itertools.product((0.5, -0.5), repeat=8) if np.prod(x) > 0])
    return np.concatenate((whole, halves))


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest points of whole components and an even sum: rounded, and where the sum is odd, the component that was
    rounded farthest the other way."""
    near = np.rint(y)
    off = y - near
    odd = np.flatnonzero(near.sum(1) % 2)
    k = np.abs(off[odd]).argmax(1)
    near[odd, k] += np.where(off[odd, k] >= 0, 1, -1)
    return near


def decoded(y: np.ndarray) -> np.ndarray:
    """The nearest lattice points of E8: even points, or those half a step aside."""
    a, b = _even(y), _even(y - 0.5) + 0.5
    return np.where((((y - a) ** 2).sum(1) <= ((y - b) ** 2).sum(1))[:, None], a, b)


@cache
def _tables(dims: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(projection, what each component of a doubled point adds to a cell's hash, what each step adds) by table."""
    out = []
    for table in range(TABLES):
        rng = np.random.default_rng([SEED, dims, table])
        projection = rng.normal(size=(dims, 8 * BLOCKS)) / WIDTH
        factor = rng.integers(1 << 63, size=(BLOCKS, 8), dtype=np.uint64) | np.uint64(1)
        steps = (2 * roots()).astype(np.int64).view(np.uint64)
        out.append((projection, factor, np.concatenate([(steps * f).sum(1, dtype=np.uint64) for f in factor])))
    return out


def cells(unit: np.ndarray, salt: np.ndarray) -> np.ndarray:
    """Hashes of the cells of unit vectors, TABLES * (1 + PROBES) each; vectors of another salt share none."""
    out = []
    for projection, factor, step in _tables(unit.shape[1]):
        y = unit @ projection
        key = salt.copy()
        gain = []
        for b in range(BLOCKS):
            point = decoded(y[:, 8 * b : 8 * b + 8])
            key += ((2 * point).astype(np.int64).view(np.uint64) * factor[b]).sum(1, dtype=np.uint64)
            gain.append((y[:, 8 * b : 8 * b + 8] - point) @ roots().T)
        gain = np.concatenate(gain, axis=1)
        # The nearest of the neighbouring points are those whose steps go farthest along what was rounded off.
        probe = np.argpartition(-gain, PROBES - 1, axis=1)[:, :PROBES]
        out.append(np.concatenate((key[:, None], key[:, None] + step[probe]), axis=1))
    turned = [mix(k + np.uint64(t)) for t, k in enumerate(out)]
    return np.concatenate(turned, axis=1)


def units(column: pa.Array) -> np.ndarray:
    """Unit vectors of rows of one length, in double precision."""
    v = column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)
    v /= np.abs(v).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def _nodes(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v, node): node is a hash of label and vector, null where the row links with nothing."""
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
    fine = F.forall("embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col("embedding").alias("v"), F.coalesce(good & fine, F.lit(False)).alias("good"))
    return rows.select("vec_id", "label", "v", F.when(F.col("good"), F.xxhash64("label", "v")).alias("node"))


def _celled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, cells) of rows (node, place, size, v) where size is the vector's length and place tells labels apart."""
    for batch in batches:
        size = batch.column("size").to_numpy()
        for n in np.unique(size):
            own = batch.filter(pa.array(size == n))
            found = cells(units(own.column("v")), mix(own.column("place").to_numpy().view(np.uint64)))
            at = pa.array(np.arange(len(found) + 1) * found.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([own.column("node"), pa.ListArray.from_arrays(at, i64(found.reshape(-1)))], ["node", "cells"])


def linked(unit: np.ndarray, block: np.ndarray, leads: list[np.ndarray], lead: int, apart: bool, cosine: float) -> np.ndarray:
    """Which of a leader's followers link and count here: at or above the cosine, without a lesser leader in common and, where
    two blocks meet, not of the same block."""
    link = unit @ unit.T >= cosine
    np.fill_diagonal(link, False)
    if apart:
        link &= block[:, None] != block[None, :]
    if link.any():
        row = np.repeat(np.arange(len(leads)), [len(x) for x in leads])
        all_ = np.concatenate(leads)
        lesser, place = np.unique(all_[all_ < lead], return_inverse=True)
        has = np.zeros((len(leads), len(lesser)), np.float32)
        has[row[all_ < lead], place] = 1
        has = has[:, has.sum(0) > 1]
        if has.shape[1]:
            link &= has @ has.T == 0
    return link


def least_reached(link: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node that each can reach by links."""
    out = node.copy()
    some = np.flatnonzero(link.any(1))
    near = link[np.ix_(some, some)]
    top = np.iinfo(np.int64).max
    while len(some):
        new = np.minimum(out[some], np.where(near, out[some][None, :], top).min(1))
        if (new == out[some]).all():
            break
        out[some] = new
    return out


_MEMBER = ("lead", "low", "high", "node", "block", "copies", "v", "leads")
_FOUND = "node long, links long, least long"


def _compared(batches: Iterator[pa.RecordBatch], cosine: float) -> Iterator[pa.RecordBatch]:
    """(node, links, least) of the rows of one task after another, which come sorted by lead, low and high."""

    def done(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(parts).combine_chunks()
        get = lambda c: rows.column(c).combine_chunks()
        at = get("leads").offsets.to_numpy()
        flat = get("leads").values.to_numpy()
        leads = [flat[a:b] for a, b in itertools.pairwise(at)]
        node = get("node").to_numpy()
        link = linked(units(get("v")), get("block").to_numpy(), leads, key[0], key[1] != key[2], cosine)
        some = link.any(1)
        links, least = link @ get("copies").to_numpy(), least_reached(link, node)
        yield pa.RecordBatch.from_arrays([pa.array(x[some]) for x in (node, links, least)], ["node", "links", "least"])

    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(c).to_numpy() for c in _MEMBER[:3]], axis=1)
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
        for a, b in itertools.pairwise(cuts):
            if key is not None and (keys[a] != key).any():
                yield from done(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield from done(held)


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of vectors (vec_id, embedding, label)."""
    spark = vectors.sparkSession
    rows = _nodes(vectors)
    with Tables(spark) as own:
        copies = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("v").alias("v"))
        nodes = own.stored(copies.select("node", "least_id", "copies", F.xxhash64("label", F.size("v")).alias("place"), F.size("v").alias("size"), "v"), "nodes")
        celled = own.stored(nodes.select("node", "place", "size", "v").mapInArrow(_celled, "node long, cells array<long>"), "cells").select("node", F.explode("cells").alias("cell"))
        crowded = celled.groupBy("cell").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").select("cell", "lead")
        led = own.stored(celled.join(crowded, "cell").select("node", "lead").distinct(), "led")
        own.drop("cells")
        # A block is about BLOCK followers of a leader; a task compares a block with itself or with another.
        blocks = led.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK)).cast("int").alias("blocks"))
        members = own.stored(led.groupBy("node").agg(F.collect_list("lead").alias("leads")).join(nodes, "node").select("node", "copies", "v", "leads"), "members")
        each = members.withColumn("lead", F.explode("leads")).join(blocks, "lead").withColumn("block", F.pmod(F.xxhash64("node", F.lit(SEED)), F.col("blocks")).cast("int"))
        other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
        tasks = each.withColumn("other", other).withColumn("low", F.least("block", "other")).withColumn("high", F.greatest("block", "other")).select(*_MEMBER)
        dealt = tasks.repartition("lead", "low", "high").sortWithinPartitions("lead", "low", "high", "node")
        found = own.stored(dealt.mapInArrow(lambda batches: _compared(batches, cosine), _FOUND), "found")
        label = components(found.select(F.col("node").alias("a"), F.col("least").alias("b")), own)
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        linked_ = label.join(nodes.select("node", "least_id"), "node")
        least = linked_.groupBy("label").agg(F.min("least_id").alias("component_id"))
        told = linked_.join(least, "label").join(links, "node").select("node", "links", "component_id")
        info = nodes.select("node", "least_id", "copies").join(told, "node", "left")
        info = stored(info.select("node", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id")), "linked-vectors")
    own_id = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "node").join(info, "node", "left").select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own_id.alias("component_id"), own_id.eqNullSafe(F.col("vec_id")).alias("kept"))


def op12_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
