"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the hashed 1- to ``ORDERS``-grams of every labelled document in the tasks (one dense array per language
and task), sums the non-zero cells in one shuffle and turns them into matrices of log-probabilities, of ``2**BITS`` rows
and a column for each of at most ``BLOCK`` languages.  One such matrix is broadcast; where there are more languages, the
matrices are files in the shared folder, which a task reads one after another.  The driver holds one at a time.

Scoring is sparse: a batch of texts becomes its non-zero cells (text, bucket, count), whose counts times the rows of the
matrix are added up by text, ``CELLS`` products at a time.  Long texts are counted piece by piece, so memory grows neither
with the length of a text nor with the number of languages.

Defined results: a null text or one without a letter is ``und`` with score 0; without any labelled row every text is;
repeated rows are scored alike; of languages with equal likelihood the alphabetically first is taken; texts of any length
are read whole; columns named lang_pred or score are replaced, other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._shared import Tables, columns, create, map_batches, new_path, opened, slices, texts

BITS = 14
ORDERS = 3
#: Languages in one matrix, of 64 MB at most.
BLOCK = 512
#: Characters that are hashed at a time, texts that are counted at a time, and products that are added up at a time.
PIECE = 1 << 18
TEXTS = 64
CELLS = 1 << 20
#: Log-likelihoods of longer texts are scaled to so many n-grams, so that a score keeps its meaning at any length.
EVIDENCE = 60
ALPHA = 0.5

_tables: list[np.ndarray] = []


def _code_tables() -> list[np.ndarray]:
    """By code point: whether it is a letter; its lower-case form if a letter, else a space."""
    if not _tables:
        letter, lower = np.zeros(0x110000, dtype=bool), np.full(0x110000, 32, dtype=np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                small = c.lower()
                letter[i], lower[i] = True, ord(small[0])
        _tables.extend((letter, lower))
    return _tables


def grams(pieces: list[str], starts: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the hash buckets of the n-grams of all pieces and the pieces that they are of: those within a piece
    that begin before its number in starts."""
    lower = _code_tables()[1]
    x = lower[np.frombuffer("".join(pieces).encode("utf-32-le", "replace"), dtype=np.uint32)]
    length = np.array([len(p) for p in pieces])
    of = np.repeat(np.arange(len(pieces)), length)
    place = np.arange(len(x)) - np.repeat(np.cumsum(length) - length, length)
    begins, left, h = place < np.array(starts)[of], length[of] - place, np.zeros(len(x), dtype=np.uint32)
    for n in range(ORDERS):
        shifted = x if not n else np.concatenate((x[n:], np.zeros(min(n, len(x)), np.uint32)))
        h = h * np.uint32(0x01000193) + (shifted + np.uint32(1)) * np.uint32(0x9E3779B1)
        use = begins & (left > n)
        yield (((h ^ (h >> np.uint32(15))) * np.uint32(0x85EBCA6B)) >> np.uint32(32 - BITS))[use], of[use]


def _has_letter(text: str) -> bool:
    letter = _code_tables()[0]
    # Most texts have one among the first characters.
    return any(letter[np.frombuffer(text[at : at + size].encode("utf-32-le", "replace"), np.uint32)].any() for at, size in ((0, 64), *((k, PIECE) for k in range(64, len(text), PIECE))))


def counted(docs: list[str]) -> Iterator[tuple[range, np.ndarray]]:
    """Some of the docs after another, and how often each of these has an n-gram in each bucket.  A doc counts as padded by
    a space on either side."""
    width = 1 << BITS

    def count(pieces: list[str], starts: list[int]) -> np.ndarray:
        return sum(np.bincount(of * width + h, minlength=len(pieces) * width) for h, of in grams(pieces, starts)).reshape(-1, width)

    at = 0
    while at < len(docs):
        to, size = at, 0
        while to < len(docs) and to - at < TEXTS and (to == at or size + len(docs[to]) <= PIECE):
            size += len(docs[to])
            to += 1
        padded = [f" {x} " for x in docs[at:to]]
        if size <= PIECE:
            yield range(at, to), count(padded, [len(x) for x in padded])
        else:
            # A piece goes on for the n-grams that begin in it.
            pieces = ((padded[0][k : k + PIECE + ORDERS - 1], PIECE) for k in range(0, len(padded[0]), PIECE))
            yield range(at, to), sum(count([x], [n]) for x, n in pieces)
        at = to


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    by: dict[str, np.ndarray] = {}

    def rows() -> Iterator[pa.RecordBatch]:
        for lang, cells in by.items():
            k = np.flatnonzero(cells)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(k), pa.string()), pa.array(k, pa.int32()), pa.array(cells[k])], ["lang", "bucket", "n"])
        by.clear()

    for batch in batches:
        for part in slices(batch, "text"):
            docs, langs = texts(part.column("text")), part.column("lang").to_pylist()
            for which, n in counted(docs):
                own = [langs[i] if _has_letter(docs[i]) else None for i in which]
                for lang in dict.fromkeys(x for x in own if x is not None):
                    if lang not in by and len(by) >= BLOCK:
                        yield from rows()
                    mine = [k for k, x in enumerate(own) if x == lang]
                    by[lang] = by.get(lang, 0) + n[mine].sum(axis=0)
    yield from rows()


class Model:
    """Languages in alphabetical order and, for BLOCK of them after another, matrices of log-probabilities: the one there
    is, or the files that hold them."""

    def __init__(self, langs: list[str], matrix: np.ndarray | None = None, files: list[str] = ()) -> None:
        self.langs, self.matrix, self.files = langs, matrix, list(files)

    def matrices(self) -> Iterator[np.ndarray]:
        if self.matrix is not None:
            yield self.matrix
        for at in self.files:
            with opened(at) as file:
                yield np.frombuffer(file.read(), np.float64).reshape(1 << BITS, -1)


def train(docs: DataFrame) -> Model:
    """The model of docs' text and lang.  Rows whose text or lang is null take no part."""
    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    with Tables(docs.sparkSession) as own:
        cells = own.stored(known.mapInArrow(_count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "language-cells")
        langs = sorted(r[0] for r in cells.select("lang").distinct().collect())
        made = []
        for at in range(0, len(langs), BLOCK):
            which = {x: k for k, x in enumerate(langs[at : at + BLOCK])}
            got = cells.where(F.col("lang").isin(*which)).toArrow()
            n = np.zeros((1 << BITS, len(which)))
            n[got.column("bucket").to_numpy(), [which[x] for x in got.column("lang").to_pylist()]] = got.column("n").to_numpy()
            matrix = np.log((n + ALPHA) / (n.sum(axis=0) + ALPHA * len(n)))
            if len(langs) <= BLOCK:
                return Model(langs, matrix)
            made.append(new_path(docs.sparkSession, "language-matrix"))
            with create(made[-1]) as file:
                file.write(matrix.tobytes())
    return Model(langs, files=made)


def _totals(cells: list[tuple[np.ndarray, np.ndarray, np.ndarray]], n_docs: int, matrix: np.ndarray) -> np.ndarray:
    """Log-likelihoods of the docs (rows) in the languages of a matrix, from (doc, bucket, count) cells by doc."""
    total = np.zeros((n_docs, matrix.shape[1]))
    step = max(1, CELLS // matrix.shape[1])
    for doc, bucket, n in cells:
        for at in range(0, len(doc), step):
            own = doc[at : at + step]
            start = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
            total[own[start]] += np.add.reduceat(matrix[bucket[at : at + step]] * n[at : at + step, None], start, axis=0)
    return total


def score_texts(docs: list[str], model: Model) -> tuple[list[str], np.ndarray]:
    """The language and score of each text."""
    if not docs or not model.langs:
        return ["und"] * len(docs), np.zeros(len(docs))
    cells, size = [], np.zeros(len(docs), np.int64)
    for which, n in counted(docs):
        row, bucket = np.nonzero(n)
        cells.append((row + which.start, bucket, n[row, bucket]))
        size[which.start : which.stop] = n.sum(axis=1)
    scale = np.minimum(1, EVIDENCE / np.maximum(size, 1))[:, None]
    best, most, rest, at = np.zeros(len(docs), np.int64), np.full(len(docs), -np.inf), np.zeros(len(docs)), 0
    for matrix in model.matrices():
        total = _totals(cells, len(docs), matrix) * scale
        top = total.argmax(axis=1)
        highest = np.maximum(most, total.max(axis=1))
        rest = rest * np.exp(most - highest) + np.exp(total - highest[:, None]).sum(axis=1)
        best = np.where(total.max(axis=1) > most, top + at, best)
        most, at = highest, at + matrix.shape[1]
    has = np.array([_has_letter(x) for x in docs])
    return [model.langs[k] if ok else "und" for k, ok in zip(best, has, strict=True)], np.where(has, 1 / rest, 0)


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """docs, or its columns in keep, with the columns lang_pred and score added (existing ones of these names are
    replaced)."""
    rest = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                names, share = score_texts(texts(part.column("text")), shared.value)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(names, pa.string()), pa.array(share)], [*rest, "lang_pred", "score"])

    schema = docs.select(*columns(rest)).schema.add("lang_pred", "string").add("score", "double")
    return map_batches(docs.select(*columns([*rest, "text"])), run, schema)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", held_out().alias("held_out"))
    model = train(docs.where(~F.col("held_out")))
    return identify(docs.select("doc_id", "held_out", "text"), model, keep=["doc_id", "held_out"])
