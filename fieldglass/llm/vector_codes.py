"""Product codes of vectors, trained by k-means with the adaptive distance bounds of Drake and Hamerly.

Vectors become integers, floor(SCALE * x), cut into ``PARTS`` equal parts; each part position has a codebook.  A round
assigns every part to its nearest entry (squared distance in integers, ties to the lower index) and moves the entries to the
means of their parts, rounded down.

What a round has learnt is kept for the next one, in a table beside the vector: for each part its entry, the b closest other
entries with lower bounds of their distances in ascending order, and one outer bound for all that are left.  When the
codebook has moved, bounds fall by what their entries moved, the outer bound by the farthest move, and each bound is brought
down to the least one after it.  The distance to the part's own entry is computed; from the first bound that exceeds it on
nothing can be nearer or as near, so only the entries before that place are uncertain and are compared exactly, in integers;
if the outer bound doesn't exceed it either, all entries are.  Bounds are whole numbers, rounded down, moves rounded up, so
they never claim too much.  b starts at a quarter of the entries and shrinks as a task goes on: each batch is kept with the
least number that covers the uncertain entries of ``COVERED`` of the parts that the task has seen (the others will be
compared with all entries, so nothing is lost).

Every round is a scan that writes the next table and one that adds up parts by entry, which sends a sum for each entry and
component to the driver, 64 times the dimensions, as the codebooks themselves.  No vector is shuffled.

Defined results: rows whose vector is null or holds a null or a component that isn't finite take no part; a row without a
vec_id is coded like others and comes last among the first entries, equal vec_ids come there in the order of their vectors;
with fewer than 64 rows there is an entry for each; repeated rows are rows; a null label is a label; no rows, no codes.  The
vectors must be as long as the first entry's and that length a multiple of 16, and components must be under ``LIMIT`` in
size, so that sums fit into longs: anything else is an error, not a code.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import Tables, stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = float(1 << 15)
COVERED = 0.99
#: An outer bound when there is nothing outside.
FAR = (1 << 31) - 1


def integers(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, v): rows that take part, their vectors as integers."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    good = vectors.where(F.col("embedding").isNotNull()).where(~F.coalesce(bad, F.lit(True)))
    too_large = F.raise_error(F.lit(f"components of {LIMIT:.0f} and more can't be coded")).cast("int")
    whole = lambda x: F.floor(F.lit(float(SCALE)) * x).cast("int")
    v = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) < LIMIT, whole(x.cast("double"))).otherwise(too_large))
    return good.select("vec_id", "label", v.alias("v"))


def root(square: np.ndarray) -> np.ndarray:
    """Square roots rounded down."""
    r = np.sqrt(square.astype(np.float64)).astype(np.int64)
    r -= r * r > square
    return r


def squares(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all entries.  Components are under 2 ** 23, so the products are exact."""
    product = (x.astype(np.float64) @ book.T.astype(np.float64)).astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * product + (book * book).sum(1)


class Part:
    """What is known of one part of some vectors: entry own, near (n x b), their bounds (n x b) and the outer bound."""

    def __init__(self, own: np.ndarray, near: np.ndarray, bound: np.ndarray) -> None:
        """bound: n x (b + 1), the last the outer one."""
        self.own, self.near, self.bound = own, near, bound

    @classmethod
    def compared(cls, x: np.ndarray, book: np.ndarray, b: int) -> Part:
        """From all distances."""
        d = squares(x, book)
        order = np.argsort(d, axis=1, kind="stable")
        sorted_ = root(np.take_along_axis(d, order[:, 1 : b + 2], axis=1))
        if sorted_.shape[1] == b:
            sorted_ = np.concatenate((sorted_, np.full((len(x), 1), FAR)), axis=1)
        return cls(order[:, 0], order[:, 1 : b + 1], sorted_)

    def moved(self, x: np.ndarray, book: np.ndarray, drift: np.ndarray) -> np.ndarray:
        """Brought up to date with a codebook whose entries moved by at most drift.  Returns how many near entries of each
        row were uncertain, b + 1 where the outer bound was, too."""
        b = self.near.shape[1]
        bound = self.bound.copy()
        bound[:, :b] -= drift[self.near]
        bound[:, b] -= drift.max(initial=0) if len(book) > b + 1 else 0
        bound = np.maximum(np.minimum.accumulate(bound[:, ::-1], axis=1)[:, ::-1], 0)
        offset = x - book[self.own]
        mine = (offset * offset).sum(1)
        certain = mine[:, None] < bound * bound
        need = np.where(certain.any(1), certain.argmax(1), b + 1)
        for n in range(1, b + 1):
            rows = np.flatnonzero(need == n)
            if not len(rows):
                continue
            some = np.concatenate((self.own[rows, None], self.near[rows, :n]), axis=1)
            offset = x[rows, None] - book[some]
            d = (offset * offset).sum(2)
            order = np.lexsort((some, d), axis=1)
            some, d = np.take_along_axis(some, order, axis=1), np.take_along_axis(d, order, axis=1)
            self.own[rows], self.near[rows, :n] = some[:, 0], some[:, 1:]
            bound[rows, :n] = root(d[:, 1:])
        rows = np.flatnonzero(need > b)
        if len(rows):
            new = Part.compared(x[rows], book, b)
            self.own[rows], self.near[rows], bound[rows] = new.own, new.near, new.bound
        self.bound = bound
        return need

    def cut(self, b: int) -> None:
        """Only the b closest entries kept; the others' bounds join the outer one."""
        if b < self.near.shape[1]:
            self.near, self.bound = self.near[:, :b], np.concatenate((self.bound[:, :b], self.bound[:, b:].min(1, keepdims=True)), axis=1)


Books = np.ndarray  # part, entry, position in part


def _vectors(column: pa.Array) -> np.ndarray:
    """n x part x position in part."""
    flat = column.flatten().to_numpy().astype(np.int64)
    return flat.reshape(len(column), PARTS, -1)


def _fixed(column: pa.Array, kind, n: int) -> np.ndarray:
    """n x part x what each part holds, from bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(n, PARTS, -1).astype(np.int64)


def _binary(values: np.ndarray) -> pa.Array:
    """A row of bytes for each row of values."""
    rows = np.ascontiguousarray(values.reshape(len(values), -1))
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _bounds(values: np.ndarray) -> pa.Array:
    flat = values.reshape(len(values), -1)
    return pa.ListArray.from_arrays(pa.array(np.arange(len(flat) + 1) * flat.shape[1], pa.int32()), pa.array(flat.reshape(-1).astype(np.int32)))


_STATE = "code binary, near binary, bound array<int>"


def _state(batch: pa.RecordBatch, parts: list[Part]) -> pa.RecordBatch:
    stack = lambda c: np.stack([getattr(p, c) for p in parts], axis=1)
    columns = {"vec_id": batch.column("vec_id"), "label": batch.column("label"), "v": batch.column("v")}
    columns |= {"code": _binary(stack("own").astype(np.uint8)), "near": _binary(stack("near").astype(np.uint8)), "bound": _bounds(stack("bound"))}
    return pa.RecordBatch.from_pydict(columns)


def _first(rows: DataFrame, books: Books, b: int) -> DataFrame:
    """rows (vec_id, label, v) with what comparing all parts with all entries tells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _vectors(batch.column("v"))
                yield _state(batch, [Part.compared(x[:, p], books[p], b) for p in range(PARTS)])

    return rows.mapInArrow(run, _schema(rows, _STATE))


def _schema(rows: DataFrame, more: str) -> str:
    return ", ".join(f"{c} {dict(rows.dtypes)[c]}" for c in ("vec_id", "label", "v")) + ", " + more


def drifts(old: Books, new: Books) -> np.ndarray:
    """How far each entry moved, rounded up: part x entry."""
    square = ((new - old) ** 2).sum(2)
    r = root(square)
    return r + (r * r < square)


def _moved(batch: pa.RecordBatch, books: Books, drift: np.ndarray) -> tuple[np.ndarray, list[Part], np.ndarray]:
    n = batch.num_rows
    x, code = _vectors(batch.column("v")), _fixed(batch.column("code"), np.uint8, n)[:, :, 0]
    near = _fixed(batch.column("near"), np.uint8, n) if len(books[0]) > 1 else np.zeros((n, PARTS, 0), np.int64)
    bound = _vectors(batch.column("bound"))
    parts = [Part(code[:, p].copy(), near[:, p].copy(), bound[:, p]) for p in range(PARTS)]
    need = np.stack([part.moved(x[:, p], books[p], drift[p]) for p, part in enumerate(parts)], axis=1)
    return x, parts, need


def _even(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows, each batch of rows with the same b."""
    for batch in batches:
        width = pc.binary_length(batch.column("near")).to_numpy()
        for b in np.unique(width):
            yield batch.filter(pa.array(width == b))


def _next(rows: DataFrame, books: Books, drift: np.ndarray) -> DataFrame:
    """The table of the next round."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needs = np.zeros(ENTRIES + 2, np.int64)
        for batch in _even(batches):
            _, parts, need = _moved(batch, books, drift)
            needs += np.bincount(need.reshape(-1), minlength=len(needs))
            b = max(1, int(np.searchsorted(np.cumsum(needs), COVERED * needs.sum())))
            for part in parts:
                part.cut(b)
            yield _state(batch, parts)

    return rows.mapInArrow(run, _schema(rows, _STATE))


def _coded(rows: DataFrame, books: Books, drift: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error): the last assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _even(batches):
            x, parts, _ = _moved(batch, books, drift)
            error = sum(((x[:, p] - books[p][part.own]) ** 2).sum(1) for p, part in enumerate(parts))
            code = _binary(np.stack([part.own for part in parts], axis=1).astype(np.uint8))
            yield pa.RecordBatch.from_pydict({"vec_id": batch.column("vec_id"), "label": batch.column("label"), "code": code, "error": pa.array(error)})

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long")


def _sums(rows: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """(sums of the parts by part, entry and position; parts by part and entry)."""
    parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            if batch.num_rows:
                x, code = _vectors(batch.column("v")), _fixed(batch.column("code"), np.uint8, batch.num_rows)[:, :, 0]
                for p in range(parts):
                    np.add.at(total[p], code[:, p], x[:, p])
                    count[p] += np.bincount(code[:, p], minlength=entries)
        flat = np.concatenate((total.reshape(-1), count.reshape(-1)))
        yield pa.RecordBatch.from_pydict({"k": pa.array(np.arange(len(flat), dtype=np.int32)), "n": pa.array(flat)})

    added = rows.select("v", "code").mapInArrow(run, "k int, n long").groupBy("k").agg(F.sum("n").alias("n")).toArrow()
    flat = np.zeros(parts * entries * (width + 1), np.int64)
    flat[added.column("k").to_numpy()] = added.column("n").to_numpy()
    return flat[: -parts * entries].reshape(shape), flat[-parts * entries :].reshape(parts, entries)


def first_books(rows: DataFrame) -> Books | None:
    """The parts of the ENTRIES smallest vec_ids; None without rows."""
    first = [r["v"] for r in rows.orderBy(F.asc_nulls_last("vec_id"), "v").limit(ENTRIES).select("v").collect()]
    if not first:
        return None
    if len(first[0]) % PARTS or not first[0] or any(len(v) != len(first[0]) for v in first):
        raise ValueError(f"vectors must have one length, a multiple of {PARTS}")
    return np.array(first, np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2)


def compress(vectors: DataFrame) -> tuple[DataFrame, Books]:
    """((vec_id, label, code, error), codebooks): code has a byte for each part, the number of its entry, and error is the
    squared distance of the integers to what the code stands for.  vectors: vec_id, label, embedding."""
    rows = integers(vectors)
    books = first_books(rows)
    if books is None:
        kinds = dict(rows.dtypes)
        return rows.sparkSession.createDataFrame([], f"vec_id {kinds['vec_id']}, label {kinds['label']}, code binary, error long"), np.zeros((PARTS, 0, 0), np.int64)
    length = PARTS * books.shape[2]
    wrong = F.raise_error(F.lit(f"vectors must have one length, a multiple of {PARTS}")).cast("array<int>")
    rows = rows.withColumn("v", F.when(F.size("v") == length, F.col("v")).otherwise(wrong))
    b = min(max(ENTRIES // 4, 1), books.shape[1] - 1)
    with Tables(rows.sparkSession) as own:
        state = own.stored(_first(rows, books, b), "assigned")
        for n in range(ROUNDS):
            total, count = _sums(state, books.shape)
            moved = np.where(count[:, :, None] > 0, total // np.maximum(count, 1)[:, :, None], books)
            drift, books = drifts(books, moved), moved
            if n + 1 < ROUNDS:
                state = own.stored(_next(state, books, drift), "assigned")
        return stored(_coded(state, books, drift), "vector-codes"), books


def decoded(code: bytes, books: Books) -> np.ndarray:
    """The vector that a code stands for, in the units of the embeddings."""
    return np.concatenate([books[p][k] for p, k in enumerate(code)]) / SCALE


def op13_vector_codes(spark, sf_dir: str) -> DataFrame:
    codes, books = compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    by = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    both = codes.join(by, F.col("label").eqNullSafe(F.col("of_label")))
    return both.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
