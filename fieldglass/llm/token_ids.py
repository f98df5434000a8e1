"""Token ids in files: frequency-ranked ids in a byte-aligned variable-length code, read back by table lookup.

Texts are encoded by the tokenizers library, dealt to partitions by ranges of doc_id and sorted, and each partition writes
one file, so that the files in order hold the documents in order.  White space separates a tokenizer's words and is
dropped, so every distinct word of a task is encoded once and its ids are gathered for each occurrence.

A file is a sequence of blocks of at least ``BLOCK_IDS`` ids (but the last), each on its own:

    4 bytes FGT1, then little-endian: documents u32, ids u64, distinct ids u32, bytes of data u64
    distinct ids by falling frequency, ties by id                u32 each
    doc_id of each document i64, then 1 if it is null, else 0     u8 each
    number of ids of each document                               u32 each
    control: two bits for each id, the bytes of its rank less 1   a byte for 4 ids
    data: the ranks' bytes, least first                          1 to 4 bytes for each id

A rank is an id's place among the distinct ids of its block, so the 256 commonest ids of a block take a byte each.  A
block of its own table needs no earlier pass over the corpus, and its memory is bounded.

Files go to the folder that all executors share.  The table of files that a job writes at the end names those of the
tasks that counted: a lost executor's tasks write other files.  Where the next document's ids start comes from sums by
file, of which there are as many as partitions.

Defined results: a null or empty text has the end id alone; repeated rows are documents each, in the order of their
texts' hash; rows without a doc_id come first; an empty table gives no rows.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldglass.llm import _kernels as K
from fieldglass.llm._shared import create, new_path, opened, slices, stored

END_ID = 2
BLOCK_IDS = 1 << 21
_HEAD = struct.Struct("<4sIQIQ")
#: Of each control byte: the lengths of its four ranks, and which of their 16 bytes are there.
LENGTHS = np.array([[(c >> 2 * j & 3) + 1 for j in range(4)] for c in range(256)], dtype=np.uint8)
PRESENT = np.arange(4)[None, None, :] < LENGTHS[:, :, None]


class WordIds:
    """Ids of words by hash, each word encoded once and kept until LIMIT are held, then the memory is begun anew.

    White space is dropped and separates words for the tokenizer, and it lower-cases A-Z, so words that differ in that
    alone share an entry, unless they have a "|" and could be a special token."""

    LIMIT = 1_500_000

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.ends_word = np.array([(self.encoder.id_to_token(i) or "").endswith("</w>") for i in range(self.encoder.get_vocab_size())])
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.start = self.length = np.zeros(0, np.int64)
        self.flat = np.zeros(0, np.int32)

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after another, how many each has).  A word of letters alone is one run for the tokenizer,
        whose last id and no other marks a word's end, so many of them are one call."""
        out: list[np.ndarray] = [np.zeros(0, np.int32)] * len(words)
        letters = [k for k, x in enumerate(words) if x.lower().isalpha()]
        rest = set(range(len(words))).difference(letters)
        for low in range(0, len(letters), 4096):
            part = letters[low : low + 4096]
            ids = np.array(self.encoder.encode_batch_fast([" ".join(words[k] for k in part)], add_special_tokens=False)[0].ids, np.int32)
            cut = np.flatnonzero(self.ends_word[ids]) + 1
            if len(cut) != len(part):
                rest.update(part)
                continue
            for k, a, b in zip(part, [0, *cut[:-1].tolist()], cut.tolist(), strict=True):
                out[k] = ids[a:b]
        others = sorted(rest)
        for k, got in zip(others, self.encoder.encode_batch_fast([words[k] for k in others], add_special_tokens=False), strict=True):
            out[k] = np.array(got.ids, np.int32)
        return np.concatenate([*out, np.zeros(0, np.int32)]), np.fromiter(map(len, out), np.int64, len(out))

    def learn(self, h: np.ndarray, words: list[str]) -> None:
        """h: ascending, none of them known."""
        if len(self.known) + len(h) > self.LIMIT:
            self.clear()
        ids, length = self.encode(words)
        at = np.searchsorted(self.known, h)
        self.start = np.insert(self.start, at, len(self.flat) + np.cumsum(length) - length)
        self.length = np.insert(self.length, at, length)
        self.known = np.insert(self.known, at, h)
        self.flat = np.concatenate((self.flat, ids))

    def __call__(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words at these spans of data one after another, how many each has)."""
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        (h,) = K.span_hashes(data, (start, end))
        pipes = np.append(0, np.cumsum(data == ord("|")))
        special = np.flatnonzero(pipes[end] > pipes[start])
        h[special] = [xxhash.xxh3_64_intdigest(data[a:b].tobytes()) for a, b in zip(start[special], end[special], strict=True)]
        distinct, first, which = np.unique(h, return_index=True, return_inverse=True)
        for _ in range(2):  # a second time if the memory was begun anew
            at = np.minimum(np.searchsorted(self.known, distinct), max(len(self.known) - 1, 0))
            fresh = np.flatnonzero(self.known[at] != distinct) if len(self.known) else np.arange(len(distinct))
            if not len(fresh):
                break
            if len(self.known) + len(fresh) > self.LIMIT:
                self.clear()
                fresh = np.arange(len(distinct))
            k = first[fresh]
            self.learn(distinct[fresh], [data[a:b].tobytes().decode() for a, b in zip(start[k].tolist(), end[k].tolist(), strict=True)])
        length = self.length[at][which]
        return K.gather(self.flat, self.start[at][which], length), length


_loaded: dict[str, WordIds] = {}


def tokenizer(path: str) -> WordIds:
    """The words' ids by the tokenizer in a file, once a process."""
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


_MARK = np.isin(np.arange(256), list(b".,;:!?"))
_ALNUM = np.array([i < 128 and chr(i).isalnum() for i in range(256)])


def encode_texts(column: pa.Array, ids_of: WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts one after another, each followed by END_ID; how many each has)."""
    data, at = K.text_bytes(column)
    start, end = K.word_spans(data, at) if len(data) else (np.zeros(0, np.int64),) * 2
    if len(start):
        # A mark after a letter or digit is a run of its own for the tokenizer, so the word before it is a word.
        cut = np.flatnonzero((end - start > 1) & _MARK[data[end - 1]] & _ALNUM[data[end - 2]])
        start, end = np.insert(start, cut + 1, end[cut] - 1), np.insert(end - np.isin(np.arange(len(end)), cut), cut + 1, end[cut])
    ids, length = ids_of(data, start, end)
    ends = np.append(0, np.cumsum(length))[np.searchsorted(start, at)]
    return np.insert(ids, ends[1:], END_ID).astype(np.uint32), np.diff(ends) + 1


def block(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray) -> bytes:
    if len(ids) and ids.max() < 1 << 22:
        n = np.bincount(ids)
        distinct, which = np.flatnonzero(n), ids
        n = n[distinct]
        rank = np.empty(int(ids.max()) + 1, np.uint32)
    else:
        distinct, which, n = np.unique(ids, return_inverse=True, return_counts=True)
        rank = np.empty(len(distinct), np.uint32)
    order = np.argsort(-n, kind="stable")
    rank[distinct[order] if which is ids else order] = np.arange(len(order), dtype=np.uint32)
    ranks = rank[which]
    code = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    four = np.concatenate((code, np.zeros(-len(code) % 4, np.uint8))).reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    data = ranks.astype("<u4").view(np.uint8).reshape(-1, 4)[np.arange(4) <= code[:, None]]
    null = np.array([x is None for x in doc_ids], np.uint8)
    head = _HEAD.pack(b"FGT1", len(doc_ids), len(ids), len(distinct), len(data))
    return b"".join((head, distinct[order].astype("<u4").tobytes(), np.array([x or 0 for x in doc_ids], "<i8").tobytes(), null.tobytes(), counts.astype("<u4").tobytes(), control.astype(np.uint8).tobytes(), data.tobytes()))


def blocks(file) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
    """(doc ids, counts, ids) of each block of an open file."""

    def read(n: int, kind: str) -> np.ndarray:
        got = file.read(n * np.dtype(kind).itemsize)
        if len(got) != n * np.dtype(kind).itemsize:
            raise ValueError("the file ends within a block")
        return np.frombuffer(got, kind)

    while head := file.read(_HEAD.size):
        magic, docs, n, distinct, size = _HEAD.unpack(head)
        if magic != b"FGT1":
            raise ValueError("no block of token ids")
        table, doc_ids, null, counts = read(distinct, "<u4"), read(docs, "<i8"), read(docs, "u1"), read(docs, "<u4")
        control, data = read(-(-n // 4), "u1"), read(size, "u1")
        wide = np.zeros((n, 4), np.uint8)
        wide[PRESENT[control].reshape(-1, 4)[:n]] = data
        yield [None if x else k for k, x in zip(doc_ids.tolist(), null.tolist(), strict=True)], counts.astype(np.int64), table[wide.view("<u4").ravel()]


def write(docs: DataFrame, tokenizer_path: str, partitions: int | None = None) -> DataFrame:
    """(part, path, docs, ids): the files written, in the order of their documents."""
    spark = docs.sparkSession
    folder = new_path(spark, "token-ids")
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = given.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of, file, path = tokenizer(tokenizer_path), None, ""
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        docs_n = ids_n = 0

        def flush() -> None:
            nonlocal file, path, docs_n, ids_n
            if not held:
                return
            if file is None:
                path = f"{folder}/{uuid.uuid4().hex}.ids"
                file = create(path)
            names = [x for names, _, _ in held for x in names]
            counts, ids = (np.concatenate([x[k] for x in held]) for k in (1, 2))
            file.write(block(names, counts, ids))
            docs_n, ids_n = docs_n + len(names), ids_n + len(ids)
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", 1 << 21):
                ids, counts = encode_texts(part.column("text"), ids_of)
                held.append((part.column("doc_id").to_pylist(), counts, ids))
                if sum(len(x[2]) for x in held) >= BLOCK_IDS:
                    flush()
        flush()
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pydict({"part": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [path], "docs": [docs_n], "ids": [ids_n]})

    return stored(ordered.mapInArrow(run, "part int, path string, docs long, ids long"), "token-files")


def read(files: DataFrame, of: Callable[[list, np.ndarray, np.ndarray, int], pa.RecordBatch], schema: str) -> DataFrame:
    """What of makes from each block's (doc ids, counts, ids, number of ids before it in all files)."""
    rows, start = [], 0
    for r in sorted(files.select("part", "path", "ids").collect()):  # a row for each partition that was written
        rows.append((r["path"], start))
        start += r["ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, at in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                with opened(path) as file:
                    for doc_ids, counts, ids in blocks(file):
                        yield of(doc_ids, counts, ids, at)
                        at += len(ids)

    listed = files.sparkSession.createDataFrame(rows, "path string, start long")
    return listed.repartition(max(1, len(rows))).mapInArrow(run, schema)


def digests(doc_ids: list, counts: np.ndarray, ids: np.ndarray, start: int) -> pa.RecordBatch:
    ends = np.cumsum(counts)
    raw = ids.astype("<u4").tobytes()
    crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "start": pa.array(start + ends - counts), "n_tokens": pa.array(counts), "ids_crc32": pa.array(crc, pa.int64())})


def op10_token_ids(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = write(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("word_bpe_49k.json"))
    return read(files, digests, "doc_id long, start long, n_tokens long, ids_crc32 long")
