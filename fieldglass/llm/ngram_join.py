"""N-gram Jaccard self-join of texts: a size-aware heavy-light join, and the groups that its links make.

A text stands for its set of distinct word shingles, as 64-bit hashes.  Equal sets are one class from the start, named by
the sum of their mixed hashes, so exact copies cost one row each and nothing more.

Two sets link when ``100 * |A & B| >= percent * |A | B|``.  With ``m`` the size of the smaller, their symmetric difference
is at most ``H(m) = floor((100 - percent) * m / percent)``.  This gives two ways to find candidates, and a boundary
between them:

* *Light* sets enumerate fixed-size subsets: of every size that a partner's common part can have, all subsets, named by
  sums of mixed hashes.  Linked sets share the subset that is their common part.
* *Heavy* sets are entered in inverted lists and the lists are scanned.  A list's key is not one shingle, since a shingle
  that a passage carries into a third of all texts would have a list of a third of all texts, but all of a set's
  shingles in one of ``H + 1`` (and a few spare) hash ranges: of so many ranges, one at least holds the same shingles in
  both sets.  Ranges depend on a size class; a set enters the lists of its own class and of the next lower one, and so
  meets any partner.  The spare ranges make up for empty ones; a set with more empty ranges than that also enters one
  list for each shingle of its prefix in hash order (the prefix filter), in which it meets its equals.

The boundary comes from the cost: a set is light while the subsets to enumerate are at most ``SCAN_COST`` times the lists
to enter.

A list never yields all its pairs.  In each, every member is checked against one leader; links join classes to groups,
and a list whose members are all in one group is done with.  What is still apart in the other lists is compared in blocks
of sets, which yield the links that join groups and not pairs.  Checks are exact intersections of the hash sets.  The
groups are thus those of all links, without a cap on lists, pairs or sizes.

Defined results: null or empty texts, and texts of white space, have no shingles and link with nothing; texts of fewer
words than a shingle have one; repeated rows are exact copies; a null id takes part, and its row gets the least id of its
group, or null.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import combinations
from math import ceil, comb, exp

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldglass.llm import _kernels as K
from fieldglass.llm._shared import IdMap, Tables, map_batches, slices, stored
from fieldglass.llm.components import components

#: Rows of subsets that cost as much as one entry in a list and its share of the scan.
SCAN_COST = 4
#: Sets, and bytes of their hashes, in a block that is compared as a whole.
BLOCK = 512
BLOCK_BYTES = 1 << 22
#: Entries of lists that a task adds up at a time.
COMBINED = 1 << 19
#: Ranges of keys that are looked at one after another, a power of two: each shuffles its share of the entries.
PASSES = 2


class Sizes:
    """What follows from the threshold: differences, the boundary, the size classes and their ranges."""

    def __init__(self, percent: int) -> None:
        self.percent = percent
        self.boundary = 1
        while self.subsets(self.boundary + 1) <= SCAN_COST * 2 * (self.difference(self.boundary + 1) + 2):
            self.boundary += 1

    def difference(self, smaller: int) -> int:
        return (100 - self.percent) * smaller // self.percent

    def largest(self, smaller: int) -> int:
        return 100 * smaller // self.percent

    def smallest(self, larger: int) -> int:
        return ceil(self.percent * larger / 100)

    def missing(self, n: int, smaller: int | None = None) -> int:
        """Most elements of a set of size n that a linked set of at most its size (and at most smaller) can lack."""
        sizes = range(self.smallest(n), min(n, smaller or n) + 1)
        return max(((self.difference(m) + n - m) // 2 for m in sizes if n - m <= self.difference(m)), default=0)

    def subsets(self, n: int) -> int:
        return sum(comb(n, j) for j in range(self.missing(n) + 1))

    @lru_cache(maxsize=None)  # noqa: B019
    def upper(self, k: int) -> int:
        """The largest size in class k."""
        low = self.boundary + 1 if k == 0 else self.upper(k - 1) + 1
        return max(low, self.largest(low))

    def classes(self, most: int) -> np.ndarray:
        """Upper ends of the classes up to the size most."""
        out = [self.upper(0)]
        while out[-1] < most:
            out.append(self.upper(len(out)))
        return np.array(out)

    def ranges(self, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Differences allowed in a class, and the number of its ranges."""
        most = (100 - self.percent) * upper // self.percent
        empty = exp(-self.percent / (100 - self.percent))
        return most, most + 2 + np.ceil(3 * empty * most).astype(np.int64)


def _seed(*of: int) -> np.uint64:
    h = np.zeros(1, np.uint64)
    for x in of:
        h = K.mix(h * np.uint64(31) + np.uint64(x & 0xFFFFFFFFFFFFFFFF) + np.uint64(1))
    return h[0]


def _light(h: np.ndarray, at: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(names of a set's subsets of every size that its common part with a light partner can have, the set)."""
    mixed, n = K.mix(h), np.diff(at)
    names, owners = [], []
    # The larger partner of a light set can lie just above the boundary.
    for i in np.flatnonzero((n > 0) & (n <= sizes.largest(sizes.boundary))):
        own = mixed[at[i] : at[i + 1]]
        total = own.sum(dtype=np.uint64)
        for j in range(sizes.missing(len(own), sizes.boundary) + 1):
            picked = list(combinations(range(len(own)), j))
            without = own[np.array(picked, dtype=np.int64).reshape(len(picked), j)].sum(axis=1, dtype=np.uint64)
            names.append(total - without + np.uint64(len(own) - j))
            owners.append(np.full(len(without), i))
    if not names:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return K.mix(np.concatenate(names)), np.concatenate(owners)


def _lists(h: np.ndarray, at: np.ndarray, sizes: Sizes) -> tuple[np.ndarray, np.ndarray]:
    """(keys of the lists that each set enters, the sets)."""
    n = np.diff(at)
    heavy = np.flatnonzero(n > sizes.boundary)
    if not len(heavy):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    upper = sizes.classes(int(n.max()))
    most, ranges = sizes.ranges(upper)
    cls = np.searchsorted(upper, n)
    mixed, high = K.mix(h ^ np.uint64(0x5851F42D4C957F2D)), h >> np.uint64(32)
    keys, owners = [], []
    for lower in (0, 1):
        which = heavy[cls[heavy] >= lower]
        if not len(which):
            continue
        c = cls[which] - lower
        k = ranges[c]
        length = n[which]
        element = K.gather(np.arange(len(h)), at[which], length)
        part = (high[element] * np.repeat(k, length).astype(np.uint64)) >> np.uint64(32)
        owner = np.repeat(np.arange(len(which)), length)
        slot = np.repeat(np.cumsum(k) - k, length) + part.astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        total = np.add.reduceat(mixed[element], start)
        of = owner[start]
        base = np.array([_class_seed(int(x), sizes.percent) for x in upper])[c]
        keys.append(K.mix(total + K.mix(base[of] + part[start])))
        owners.append(which[of])
        filled = np.bincount(of, minlength=len(which))
        for j in np.flatnonzero(filled <= most[c]):
            i = which[j]
            own = h[at[i] : at[i + 1]]
            prefix = own[: len(own) - sizes.smallest(len(own)) + 1]
            keys.append(K.mix(prefix + _seed(3, sizes.percent)))
            owners.append(np.full(len(prefix), i))
    return np.concatenate(keys), np.concatenate(owners)


@lru_cache(maxsize=4096)
def _class_seed(upper: int, percent: int) -> int:
    return _seed(2, percent, upper)


def _name(h: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Names of sets."""
    return K.mix(K.runs(K.mix(h + np.uint64(0x2545F4914F6CDD1D)), at) + np.diff(at).astype(np.uint64))


def _sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    for part in slices(batch, "text"):
        h, at = K.sets(*K.shingles(*K.words(part.column("text")), words))
        yield part, h, at, _name(h, at)


def members(docs: DataFrame, words: int) -> DataFrame:
    """(doc_id, n_shingles, set): the size and the name of each text's set; name null where the set is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, _, at, name in _sets(batch, words):
                n = np.diff(at)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n), pa.array(name.view(np.int64), mask=n == 0)], ["doc_id", "n_shingles", "set"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_shingles long, set long")


def entries(docs: DataFrame, words: int, percent: int, wanted: DataFrame | None = None, ends_of: int | None = None) -> DataFrame:
    """(key, set): subsets of the light sets and lists of the heavy ones; a task enters each set once.  Of the keys that
    aren't among wanted, if it is given, the map drops most.  With ends_of, one of the PASSES ranges of keys, the rows
    are those of _ends for these."""
    held = docs.sparkSession.sparkContext.broadcast(IdMap(wanted)) if wanted is not None else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes, seen = Sizes(percent), set()
        for batch in batches:
            for _, h, at, name in _sets(batch, words):
                fresh = np.zeros(len(name), dtype=bool)
                for i, x in enumerate(name.tolist()):
                    if x not in seen and at[i + 1] > at[i]:
                        seen.add(x)
                        fresh[i] = True
                keep = np.flatnonzero(fresh)
                length = np.diff(at)[keep]
                own, own_at, own_name = K.gather(h, at[:-1][keep], length), np.concatenate(([0], np.cumsum(length))), name[keep]
                for keys, owner in (_light(own, own_at, sizes), _lists(own, own_at, sizes)):
                    if ends_of is not None:
                        own_range = keys >> np.uint64(32) & np.uint64(PASSES - 1) == ends_of
                        keys, owner = keys[own_range], owner[own_range]
                    if held is not None:
                        may = held.value.may_hold(keys)
                        keys, owner = keys[may], owner[may]
                    yield pa.RecordBatch.from_arrays([K.i64(keys), K.i64(own_name[owner])], ["key", "set"])

    if ends_of is None:
        return docs.select("text").mapInArrow(run, "key long, set long")
    return docs.select("text").mapInArrow(lambda batches: _ends(run(batches)), "key long, low long, high long")


def _sketch(h: np.ndarray) -> bytes:
    """For each of B ranges of low bits, a power of two between 2 and 4 times the size of the set, whether its number of
    elements is odd.  Of two sets' sketches, brought to one length, as many bits differ as the sets do, or fewer."""
    bits = max(64, 1 << (2 * len(h) - 1).bit_length())
    return np.packbits((np.bincount((h & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).astype(np.uint8)).tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """The sketch of so many bytes of the same set."""
    while len(sketch) > size:
        sketch = sketch[: len(sketch) // 2] ^ sketch[len(sketch) // 2 :]
    return sketch


def candidate_sets(docs: DataFrame, wanted: DataFrame, words: int, make=np.ndarray.tobytes) -> DataFrame:
    """(set, n, data): the size of each wanted set and what make keeps of its hashes, once.  The map drops most other
    texts before their sets travel; the join settles the rest."""
    held = docs.sparkSession.sparkContext.broadcast(IdMap(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for _, h, at, name in _sets(batch, words):
                out, which = [], []
                for i in np.flatnonzero(held.value.may_hold(name) & (np.diff(at) > 0)):
                    if (x := int(name[i])) not in seen:
                        seen.add(x)
                        out.append(make(h[at[i] : at[i + 1]]))
                        which.append(i)
                if out:
                    yield pa.RecordBatch.from_arrays([K.i64(name[which]), pa.array(np.diff(at)[which]), pa.array(out, pa.binary())], ["set", "n", "data"])

    each = docs.select("text").mapInArrow(run, "set long, n long, data binary")
    return each.join(wanted, "set", "left_semi").groupBy("set").agg(F.first("n").alias("n"), F.first("data").alias("data"))


def _pairs_of(pairs: DataFrame, sets: DataFrame, keep) -> DataFrame:
    """Those of pairs (a, b) for which keep(size and data of a, size and data of b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (batch.column(c).to_numpy() for c in ("m", "n"))
            x, y = batch.column("x"), batch.column("y")
            ok = [keep(int(m[i]), x[i].as_buffer(), int(n[i]), y[i].as_buffer()) for i in range(batch.num_rows)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    of = lambda name, size, data: sets.select(F.col("set").alias(name), F.col("n").alias(size), F.col("data").alias(data))
    both = pairs.join(of("b", "n", "y"), "b").join(of("a", "m", "x"), "a")
    return both.select("a", "b", "m", "n", "x", "y").mapInArrow(run, "a long, b long")


def _may_link(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) that sizes and sketches leave possible; no link is lost."""

    def keep(m: int, x: pa.Buffer, n: int, y: pa.Buffer) -> bool:
        size = min(len(x), len(y))
        apart = int(np.bitwise_count(_folded(np.frombuffer(x, np.uint8), size) ^ _folded(np.frombuffer(y, np.uint8), size)).sum())
        return _near(m + n, max(apart, abs(m - n)), percent)

    return _pairs_of(pairs, sketches, keep)


def _near(total, apart, percent: int):
    """Whether sets of so many elements in total that differ in at least so many can link."""
    return 100 * (total - apart) >= percent * (total + apart)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose sets link."""

    def keep(m: int, x: pa.Buffer, n: int, y: pa.Buffer) -> bool:
        both = np.concatenate((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)))
        both.sort(kind="stable")
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= percent * (len(both) - common)

    return _pairs_of(pairs, sets, keep)


def _common(own: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """How many elements each of the rows left has in common with each of the rows right."""
    # Columns: the elements that two rows hold at least.  Products of 0/1 matrices count what rows have in common.
    element, column, times = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(own)), [len(x) for x in own])
    common = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    order = order[times[column[order]] > 1]
    place = np.cumsum(times > 1)[column[order]] - 1
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, 4096):
        own_part = order[np.searchsorted(place, low) : np.searchsorted(place, low + 4096)]
        cells = np.zeros((len(own), 4096), np.float32)
        cells[row[own_part], np.cumsum(times > 1)[column[own_part]] - 1 - low] = 1
        common += cells[left] @ cells[right].T
    return common


def _opened(table: pa.Table, column: str, kind: type) -> list[np.ndarray]:
    raw = table.column(column).combine_chunks()
    return [np.frombuffer(raw[i].as_buffer(), kind) for i in range(len(raw))]


def _block_counts(table: pa.Table, percent: int) -> pa.Table:
    """(set, links): how many links each set has in one or two blocks of a leader's lists, but for the pairs that also
    meet under a lower leader: there they are counted."""
    block, leader = table.column("block").to_numpy(), table.column("leader")[0].as_py()
    own = _opened(table, "data", np.uint64)
    lower = [np.array([y for y in x if y < leader], np.int64) for x in table.column("leaders").to_pylist()]
    n, name = np.array([len(x) for x in own]), table.column("set").to_numpy()
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    one = block.min() == block.max()
    # A block against another is a table of both; where one of them is empty, a block against itself has its own table.
    if one and table.column("low")[0].as_py() != table.column("high")[0].as_py():
        return pa.table({"set": pa.array([], pa.int64()), "links": pa.array([], pa.int64())})
    common = _common(own, left, right)
    either = n[left][:, None] + n[right][None, :] - common
    hit = 100 * common.astype(np.int64) >= percent * either.astype(np.int64)
    hit &= name[left][:, None] != name[right][None, :]
    if hit.any():
        hit &= _common(lower, left, right) == 0
    count = np.zeros(len(own), np.int64)
    count[left] += hit.sum(axis=1)
    if not one:
        count[right] += hit.sum(axis=0)
    held = count > 0
    return pa.table({"set": pa.array(name[held], pa.int64()), "links": pa.array(count[held], pa.int64())})


def _block_links(table: pa.Table, percent: int) -> pa.Table:
    """Links between members of different groups in one or two blocks of a leader's lists: as many as join their groups."""
    block = table.column("block").to_numpy()
    own = _opened(table, "data", np.uint64)
    n = np.array([len(x) for x in own])
    name, group = table.column("set").to_numpy(), table.column("group").to_numpy()
    left = np.flatnonzero(block == block.min())
    right = np.flatnonzero(block == block.max())
    common = _common(own, left, right)
    either = n[left][:, None] + n[right][None, :] - common
    hit = (100 * common.astype(np.int64) >= percent * either.astype(np.int64)) & (group[left][:, None] != group[right][None, :])
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    out = []
    for i, j in zip(*np.nonzero(hit), strict=True):
        p, q = root(int(group[left[i]])), root(int(group[right[j]]))
        if p != q:
            parent[p] = q
            out.append((int(name[left[i]]), int(name[right[j]])))
    return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([x for _, x in out], pa.int64())})


def _block_live(table: pa.Table, percent: int, apart: str) -> pa.Table:
    """The rows of one or two blocks of a leader's lists, without data, that sizes and sketches leave a possible link to a
    row of the other block that differs in the column apart."""
    block, n, kind = (table.column(c).to_numpy() for c in ("block", "n", apart))
    left, right = np.flatnonzero(block == block.min()), np.flatnonzero(block == block.max())
    sketches = _opened(table, "data", np.uint8)
    size = np.array([len(x) for x in sketches])
    shared = np.minimum(size[left][:, None], size[right][None, :])
    differ = np.abs(n[left][:, None] - n[right][None, :])
    for bytes_ in np.unique(shared):
        # +1 and -1: products of rows count the bits that agree less those that differ.
        signs = [1 - 2 * np.unpackbits(np.stack([_folded(sketches[i], bytes_) for i in side[size[side] >= bytes_]])).reshape(-1, 8 * bytes_).astype(np.float32) for side in (left, right)]
        rows, columns = size[left] >= bytes_, size[right] >= bytes_
        bits = np.zeros(shared.shape, np.int64)
        bits[np.ix_(rows, columns)] = (8 * bytes_ - signs[0] @ signs[1].T) / 2
        differ = np.where(shared == bytes_, np.maximum(differ, bits), differ)
    may = _near(n[left][:, None] + n[right][None, :], differ, percent) & (kind[left][:, None] != kind[right][None, :])
    live = np.union1d(left[may.any(axis=1)], right[may.any(axis=0)])
    return table.drop_columns(["n", "data"]).take(pa.array(live))


def _dealt(docs: DataFrame, words: int, member: DataFrame, sketches: DataFrame, percent: int, apart: str, own: Tables):
    """member (leader, set, ...), distinct, with the sets' sizes and hashes, in groups (leader, low, high): those pairs of
    blocks of a leader that can have links.

    Sets that share a list share its leader, so what a leader's lists hold is compared together.  It is dealt to blocks of
    about BLOCK sets by hash, and every two blocks are compared by a product of matrices, first of sketches, then, of the
    sets that these leave a possible link, of hashes: a set travels as often as its leaders have blocks, and no pair is a
    row."""
    sized = member.join(sketches.select("set", "n"), "set")
    blocks = sized.groupBy("leader").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") * 8 / BLOCK_BYTES)).cast("int").alias("blocks"))
    # A table of their own: joined to it, the sets of one leader can be split between tasks.
    blocks = own.stored(blocks.where("blocks > 1"), "blocks")
    dealt = member.join(blocks, "leader", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1))).withColumn("block", F.pmod(F.xxhash64("set"), F.col("blocks")).cast("int"))
    other = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keyed = other.select("*", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")).drop("blocks", "other")
    # Dealt out anew: by leader, all blocks of one would be in one task.
    full = keyed.join(sketches, "set").repartition("leader", "low", "high")
    live = own.stored(full.groupBy("leader", "low", "high").applyInArrow(lambda table: _block_live(table, percent, apart), full.drop("n", "data").schema), "live-blocks")
    sets = own.stored(candidate_sets(docs, live.select("set").distinct(), words), "live-sets")
    return live.join(sets.drop("n"), "set").repartition("leader", "low", "high").groupBy("leader", "low", "high")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, low, high): the least and the greatest set of each key, a row for each COMBINED entries that have it; high is
    null if it is low, as with most keys, which packs better."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def rows() -> pa.RecordBatch:
        key, name = (np.concatenate([x[k] for x in held]) for k in (0, 1))
        held.clear()
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        end = np.append(start[1:], len(key)) - 1
        low, high = name[start], name[end]
        return pa.RecordBatch.from_arrays([pa.array(key[start]), pa.array(low), pa.array(high, mask=low == high)], ["key", "low", "high"])

    for batch in batches:
        if batch.num_rows:
            # Copies: the batch's own memory is given back.
            held.append((batch.column("key").to_numpy().copy(), batch.column("set").to_numpy().copy()))
        if sum(len(x) for x, _ in held) >= COMBINED:
            yield rows()
    if held:
        yield rows()


def _led(docs: DataFrame, words: int, percent: int, own: Tables) -> tuple[DataFrame, DataFrame]:
    """(key, set, leader): the lists of several sets; (set, n, data): sizes and sketches of the sets in them.

    What a list needs to know of itself is an aggregate, added up before the shuffle, written, and joined back: a list's
    rows need not be in one task.  Most lists have one set; which have more is found out range by range, so that no
    shuffle holds all entries."""
    several = []
    for part in range(PASSES):
        # Dealt out before Spark aggregates: most keys occur once, and a map of them in each task would fill an executor.
        ends = entries(docs, words, percent, ends_of=part).repartition("key").groupBy("key").agg(F.min("low").alias("low"), F.max(F.coalesce("high", "low")).alias("high"))
        several.append(own.stored(ends.where("low <> high").select("key"), f"shared-keys-{part}"))
    keys = reduce(DataFrame.union, several)
    # Entered again rather than kept: the entries of most lists are not worth a table.
    shared = own.stored(entries(docs, words, percent, keys).join(keys, "key"), "shared-lists")
    own.drop(*(f"shared-keys-{part}" for part in range(PASSES)))
    sketches = own.stored(candidate_sets(docs, shared.select("set").distinct(), words, _sketch), "sketches")
    # The leader of a list is the member that meets most others in all its lists: an original rather than an edited copy.
    members_ = own.stored(shared.groupBy("key").agg(F.count(F.lit(1)).alias("members")), "list-sizes")
    weight = own.stored(shared.join(members_, "key").groupBy("set").agg(F.sum("members").alias("weight")), "weights")
    first = shared.join(weight, "set").groupBy("key").agg(F.max(F.struct("weight", "set")).alias("most")).select("key", F.col("most.set").alias("leader"))
    led = own.stored(shared.join(own.stored(first, "leaders"), "key"), "led-lists")
    own.drop("shared-lists", "list-sizes", "weights", "leaders")
    return led, sketches


def groups(docs: DataFrame, words: int, percent: int, own: Tables) -> DataFrame:
    """(set, group): the sets with a link to another one, and the least set that links lead to; stored among own."""
    led, sketches = _led(docs, words, percent, own)
    pairs = led.where("set <> leader").select(F.least("set", "leader").alias("a"), F.greatest("set", "leader").alias("b")).distinct()
    pairs = own.stored(_may_link(pairs, sketches, percent), "pairs")
    sets = own.stored(candidate_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct(), words), "candidate-sets")
    links = own.stored(_linked(pairs, sets, percent), "links")
    own.drop("pairs", "candidate-sets")
    labels = components(links, own, "first-labels")
    apart = own.stored(led.join(labels.select(F.col("node").alias("set"), "label"), "set", "left").select("key", "set", "leader", F.coalesce("label", "set").alias("group")), "grouped-lists")
    own.drop("led-lists")
    open_ = own.stored(apart.groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high")).where("low <> high").select("key"), "open-keys")
    apart = own.stored(apart.join(open_, "key").select("leader", "set", "group").distinct(), "apart-lists")
    own.drop("grouped-lists", "open-keys")
    compared = _dealt(docs, words, apart, sketches, percent, "group", own)
    more = own.stored(compared.applyInArrow(lambda table: _block_links(table, percent), "a long, b long"), "more-links")
    own.drop("apart-lists", "blocks", "sketches", "live-blocks", "live-sets")
    labels = components(links.union(more), own)
    return labels.select(F.col("node").alias("set"), F.col("label").alias("group"))


def classes(docs: DataFrame, words: int, percent: int, store=stored) -> DataFrame:
    """(doc_id, n_shingles, set, component_id, keeper): every row of docs with the name of its set, the least doc_id that
    links lead to, and the set that stands for the group: the least of those with that doc_id; kept by store."""
    with Tables(docs.sparkSession) as own:
        each = own.stored(members(docs, words), "members")
        named = each.where("set IS NOT NULL").groupBy("set").agg(F.min("doc_id").alias("first"))
        grouped = named.join(groups(docs, words, percent, own), "set", "left").withColumn("group", F.coalesce("group", "set"))
        least = own.stored(grouped.select("set", "group", "first"), "groups")
        root = own.stored(least.groupBy("group").agg(F.min(F.when(F.col("first").isNotNull(), F.struct("first", "set"))).alias("root")), "roots")
        of = least.join(root, "group").select("set", F.col("root.first").alias("component_id"), F.col("root.set").alias("keeper"))
        alone = F.when(F.col("set").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        return store(each.join(of, "set", "left").select("doc_id", "n_shingles", "set", alone.alias("component_id"), "keeper"), "classes")


def join(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n_shingles, component_id): every row of docs with the size of its set and the least doc_id that links
    lead to."""
    return classes(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def with_sets(docs: DataFrame, words: int, column: str, held: tuple[str, IdMap] | None = None) -> DataFrame:
    """docs with the name of each text's set in column, null where the set is empty; with held, a column of longs and a
    map, only the rows whose value there the map may hold."""
    map_ = docs.sparkSession.sparkContext.broadcast(held[1]) if held else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if held:
                ids = batch.column(held[0])
                batch = batch.filter(pa.array(map_.value.may_hold(ids.fill_null(0).to_numpy()) & ids.is_valid().to_numpy(zero_copy_only=False)))
            for part, _, at, name in _sets(batch, words):
                own = pa.array(name.view(np.int64), mask=np.diff(at) == 0)
                yield pa.RecordBatch.from_arrays([*part.columns, own], [*part.schema.names, column])

    return map_batches(docs, run, StructType([*docs.schema.fields, StructField(column, LongType())]))


def link_counts(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, class_id, n_links): every row of docs with the name of its class of equal sets, null where the set is
    empty, and the number of other classes that link to it.

    Linked sets share a list and thus a leader; all that a leader's lists hold is compared, and a pair is counted under the
    least of the leaders that its sets share."""
    with Tables(docs.sparkSession) as own:
        led, sketches = _led(docs, words, percent, own)
        member = own.stored(led.select("leader", "set").distinct(), "members-of-leaders")
        leaders = member.groupBy("set").agg(F.sort_array(F.collect_list("leader")).alias("leaders"))
        compared = _dealt(docs, words, own.stored(member.join(leaders, "set"), "members-with-leaders"), sketches, percent, "set", own)
        counted = compared.applyInArrow(lambda table: _block_counts(table, percent), "set long, links long")
        links = own.stored(counted, "link-counts").groupBy("set").agg(F.sum("links").alias("n_links"))
        each = members(docs, words).select("doc_id", F.col("set").alias("class_id"))
        return stored(each.join(links.withColumnRenamed("set", "class_id"), "class_id", "left").select("doc_id", "class_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")), "link-counts")


def op8_ngram_join(spark, sf_dir: str) -> DataFrame:
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, percent=85)


def op8_ngram_links(spark, sf_dir: str) -> DataFrame:
    return link_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=4, percent=85)
