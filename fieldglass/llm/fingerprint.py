"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases' names into phrases again, and so on up to one name.  Where a phrase begins
depends only on a few symbols around: runs of one symbol become a block, deterministic coin tossing (the lowest bit in
which a symbol differs from its left neighbour, and its value there, over and over) brings the symbols down to six labels
of which neighbours differ, and phrases begin at local maxima.  So equal substrings get equal phrases inside, at any
offset and at every level.

The fingerprint is a sample of the names of the phrases from level ``LEVEL`` on (about 15 characters), and of the topmost
name: the ``SKETCH`` smallest of their 32-bit hashes, in hexadecimal.  The likeness of two is the share of names in both
among the smallest of their union, an estimate of the Jaccard likeness of the phrase sets, exact for short texts.

``with_edited`` sets each text against an edited one that ends in the next document's start.  Documents are dealt out by
ranges of doc_id; only the first documents of a range travel twice, to be next to the last one of the range before.

Defined results: a null text is an empty one and has an empty fingerprint, like only to another empty one; equal texts
have equal fingerprints; rows without a doc_id come first; rows with the same doc_id are ordered by their texts' hash; a
document alone is its own next one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm._kernels import mix
from fieldglass.llm._shared import columns, map_batches, slices, texts

LEVEL = 3
SKETCH = 64
_ONE = np.uint64(1)
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _tossed(cur: np.ndarray, prev: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which cur and prev differ, plus cur's value there."""
    diff = cur ^ prev
    bit = np.minimum(np.bitwise_count((diff & (~diff + _ONE)) - _ONE), 63)
    return (bit << 1).astype(np.uint8) + ((cur >> bit.astype(np.uint64)) & _ONE).astype(np.uint8)


_SMALL = np.arange(128, dtype=np.uint64)
_AGAIN = _tossed(np.repeat(_SMALL, 128), np.tile(_SMALL, 128)).reshape(128, 128)


def _left(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each symbol's left neighbour; at a text's first symbol, one that differs in the lowest bit."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[first] = x[first] ^ x.dtype.type(1)
    return out


def parse(x: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: names of the phrases of every text, each of which has a symbol at least, and the texts' offsets."""
    first = np.zeros(len(x), dtype=bool)
    first[at[:-1]] = True
    begins = np.ones(len(x), dtype=bool)
    np.not_equal(x[1:], x[:-1], out=begins[1:])
    start = np.flatnonzero(begins | first)
    if len(start) < len(x):
        length = np.diff(np.append(start, len(x)))
        x, first = x[start], first[start]
        many = length > 1
        x[many] = mix(x[many] * _ODD + length[many].astype(np.uint64))
    firsts = np.flatnonzero(first)
    label = _tossed(x, _left(x, firsts))
    for _ in range(3):
        label = _AGAIN[label, _left(label, firsts)]
    last = np.zeros(len(x), dtype=bool)
    last[firsts[1:] - 1] = last[-1] = True
    top = np.zeros(len(x), dtype=bool)
    top[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    phrase = np.flatnonzero((top & ~last) | first)
    length = np.diff(np.append(phrase, len(x)))
    place = np.arange(len(x)) - np.repeat(phrase, length)
    names = mix(np.add.reduceat(mix(x + place.astype(np.uint64) * _ODD), phrase) + length.astype(np.uint64))
    return names, np.append(np.searchsorted(phrase, firsts), len(phrase))


def sketches(docs: list[str]) -> list[np.ndarray]:
    """Each text's smallest hashes of names, ascending."""
    size = np.fromiter(map(len, docs), np.int64, len(docs))
    which = np.flatnonzero(size)
    if not len(which):
        return [np.zeros(0, np.uint32)] * len(docs)
    x = mix(np.frombuffer("".join(docs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + _ONE)
    at = np.append(0, np.cumsum(size[which]))
    found, level = [], 0
    while len(which):
        x, at = parse(x, at)
        level += 1
        n = np.diff(at)
        done = n == 1
        owner = np.repeat(which, n)
        if level < LEVEL:
            keep = np.repeat(done, n)
            owner, names = owner[keep], x[keep]
        else:
            names = x
        found.append((owner.astype(np.uint64) << np.uint64(32)) | (mix(names + np.uint64(level)) >> np.uint64(32)))
        if done.any():
            keep = ~done
            x, which, at = x[np.repeat(keep, n)], which[keep], np.append(0, np.cumsum(n[keep]))
    every = np.sort(np.concatenate(found))
    every = every[np.append(True, every[1:] != every[:-1])]
    names = (every & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    ends = np.searchsorted(every >> np.uint64(32), np.arange(len(docs) + 1, dtype=np.uint64))
    return [names[a : min(b, a + SKETCH)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]


def text_of(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    both = np.concatenate((a, b))
    both.sort()
    if not len(both):
        return 1.0
    same = np.append(both[1:] == both[:-1], False)
    twin = np.append(False, same[:-1])
    distinct = same[~twin][:SKETCH]
    return float(distinct.sum() / len(distinct))


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """docs' columns, map_batches, or those in keep, with fingerprint added."""
    rest = [c for c in keep or docs.columns if c != "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out = [text_of(x) for x in sketches(texts(part.column("text")))]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), pa.array(out, pa.string())], [*rest, "fingerprint"])

    return map_batches(docs.select(*columns([*rest, "text"])), run, docs.select(*columns(rest)).schema.add("fingerprint", "string"))


def edited(text: str, after: str) -> str:
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def in_order(docs: DataFrame, partitions: int) -> DataFrame:
    """docs' doc_id and text dealt out by ranges of doc_id and sorted, with the columns range, and guest: true for the
    rows of the document that follows the range's last one."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cuts = sorted({int(x) for x in given.where("doc_id IS NOT NULL").approxQuantile("doc_id", [k / partitions for k in range(1, partitions)], 0.1 / partitions)}) if partitions > 1 else []
    ranged = given.withColumn("range", F.coalesce(F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<long>"), lambda x: x <= F.col("doc_id"))), F.lit(0)) if cuts else F.lit(0))
    # A row for each range: its first document, null if a row without a doc_id is there.
    firsts = sorted((r["range"], None if r["none"] else r["first"]) for r in ranged.groupBy("range").agg(F.min("doc_id").alias("first"), F.bool_or(F.col("doc_id").isNull()).alias("none")).collect())
    to = {firsts[k][0]: firsts[k - 1][0] for k in range(len(firsts))}
    is_first = F.lit(False)
    if firsts:
        is_first = F.col("doc_id").eqNullSafe(F.create_map(*(F.lit(v).cast("long") for pair in firsts for v in pair))[F.col("range").cast("long")])
    place = F.struct(F.col("range").alias("range"), F.lit(False).alias("guest"))
    if firsts:
        before = F.create_map(*(F.lit(v) for pair in to.items() for v in pair))[F.col("range")]
        place = F.explode(F.when(is_first, F.array(place, F.struct(before.alias("range"), F.lit(True).alias("guest")))).otherwise(F.array(place)))
    dealt = ranged.select("doc_id", "text", place.alias("_place")).select("doc_id", "text", "_place.range", "_place.guest")
    return dealt.repartitionById(partitions, F.col("range")).sortWithinPartitions("range", "guest", "doc_id", F.xxhash64("text"))


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def with_edited(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    n = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def rows(given: list[tuple], new: list[str]) -> pa.RecordBatch:
        """given: (doc_id, text, its sketch, the next one's); new: the edited texts."""
        other = sketches(new)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array([x[0] for x in given], pa.int64()),
                "n_chars": pa.array([len(x[1]) for x in given], pa.int64()),
                "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in new],
                "fingerprint": [text_of(x[2]) for x in given],
                "edited_fingerprint": [text_of(x) for x in other],
                "near_edited": [likeness(x[2], y) for x, y in zip(given, other, strict=True)],
                "near_next": [likeness(x[2], x[3]) for x in given],
            }
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row: range, guest, doc_id, text, sketch
        for batch in batches:
            for part in slices(batch, "text"):
                own = texts(part.column("text"))
                seen = [*([held] if held else []), *zip(part.column("range").to_pylist(), part.column("guest").to_pylist(), part.column("doc_id").to_pylist(), own, sketches(own), strict=True)]
                given, new = [], []
                for this, after in zip(seen[:-1], seen[1:], strict=True):
                    if not this[1]:
                        given.append((this[2], this[3], this[4], after[4]))
                        new.append(edited(this[3], after[3]))
                held = seen[-1]
                if given:
                    yield rows(given, new)

    return in_order(docs, n).mapInArrow(run, _EDITED)


def op7_fingerprint(spark, sf_dir: str) -> DataFrame:
    return with_edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))
