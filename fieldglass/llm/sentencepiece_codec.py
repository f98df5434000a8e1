"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reads a text once.  At each position it reports, along its output links, every piece that ends there,
longest first; each relaxes the best score of that position from the position where the piece begins.  A character that
no piece covers alone can be taken as unknown, at the lowest score less ``UNKNOWN``, and is written in byte pieces.  The
path of the highest total score is the encoding; of equal scores the one with the longer last piece.

No piece of the models meant here has a space mark behind another character, so the best path of a text is the best path
of each of its chunks (space marks, then others), one after another.  The ids of
chunks are held in memory of a fixed size and gathered for every occurrence.  A model with other pieces is run over whole texts.

Pieces and scores are read from a model file by the sentencepiece library, once a process; its path is a parameter.

Defined results: a null or empty text has no ids; a text's own U+2581 reads as a space, as in the library; ids that form
no UTF-8 decode to U+FFFD; null ids decode to an empty text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldglass.llm._shared import ChunkIds, columns, map_batches, slices, texts

SPACE = "▁"
UNKNOWN = 10.0
#: Chunks whose ids a process holds, some 250 bytes each.
HELD_CHUNKS = 200_000
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Model:
    def __init__(self, path: str) -> None:
        import sentencepiece

        own = sentencepiece.SentencePieceProcessor(model_file=path)
        n = own.get_piece_size()
        kind = [own.is_unknown(i) or own.is_control(i) or own.is_unused(i) for i in range(n)]
        self.bytes = {int(own.id_to_piece(i)[3:5], 16): i for i in range(n) if own.is_byte(i)}
        self.pieces = {own.id_to_piece(i): (i, own.get_score(i)) for i in range(n) if not kind[i] and not own.is_byte(i)}
        self.unknown_id, special = own.unk_id(), {i for i in range(n) if kind[i]}
        self.text = ["" if i in special else own.id_to_piece(i).replace(SPACE, " ") for i in range(n)]
        self.byte_of = np.full(n, -1)
        for byte, i in self.bytes.items():
            self.byte_of[i] = byte
        self._prepare()

    def _prepare(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, (i, score) in self.pieces.items():
            self.automaton.add_word(piece, (len(piece), i, score))
        self.automaton.make_automaton()
        self.unknown_score = min(s for _, s in self.pieces.values()) - UNKNOWN
        self.by_chunk = not any(re.search(f"[^{SPACE}]{SPACE}", x) for x in self.pieces)
        self.ids = ChunkIds(lambda chunks: [self.search(x) for x in chunks], HELD_CHUNKS)

    def search(self, chunk: str) -> list[int]:
        """The ids on the best path."""
        n = len(chunk)
        best: list[float | None] = [0.0] + [None] * n
        back: list[tuple[int, int]] = [(0, -1)] * (n + 1)
        at = 0  # positions up to here are settled
        single = False

        def settle(to: int) -> None:
            nonlocal at, single
            while at < to:
                if not single:
                    score = best[at] + self.unknown_score
                    if best[at + 1] is None or score > best[at + 1]:
                        best[at + 1], back[at + 1] = score, (at, -1)
                at += 1
                single = False

        for end, (length, i, score) in self.automaton.iter(chunk):
            if end > at:
                settle(end)
            start = end + 1 - length
            total = best[start] + score
            if length == 1:
                single = True
            if best[end + 1] is None or total > best[end + 1]:
                best[end + 1], back[end + 1] = total, (start, i)
        settle(n)
        out: list[int] = []
        while n:
            start, i = back[n]
            if i < 0:
                raw = chunk[start:n].encode("utf-8", "replace")
                out += [self.bytes[b] for b in reversed(raw)] if self.bytes else [self.unknown_id]
            else:
                out.append(i)
            n = start
        return out[::-1]

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if not self.by_chunk:
            return [SPACE + text.replace(" ", SPACE)]
        if "  " in text or text[0] == " " or text[-1] == " " or SPACE in text:
            return _CHUNK.findall(SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE)).split(" ")

    def encode(self, docs: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all docs one after another, their n + 1 offsets)."""
        each = [self.chunks(x) for x in docs]
        ids, length = self.ids([c for x in each for c in x])
        return ids, np.concatenate(([0], np.cumsum(length)))[np.cumsum([0, *map(len, each)])]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids."""
        as_bytes = self.byte_of[ids]
        if (as_bytes < 0).all():
            text = "".join(map(self.text.__getitem__, ids.tolist()))
        else:
            raw = b"".join(bytes((b,)) if b >= 0 else self.text[i].encode() for i, b in zip(ids.tolist(), as_bytes.tolist(), strict=True))
            text = raw.decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


_loaded: dict[str, Model] = {}


def model(path: str) -> Model:
    if path not in _loaded:
        _loaded[path] = Model(path)
    return _loaded[path]


def _encoded(batches: Iterator[pa.RecordBatch], path: str, rest: list[str]) -> Iterator[pa.RecordBatch]:
    own = model(path)
    for batch in batches:
        for part in slices(batch, "text"):
            ids, at = own.encode(texts(part.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), lists], [*rest, "ids"])


def _decoded(batches: Iterator[pa.RecordBatch], path: str, rest: list[str]) -> Iterator[pa.RecordBatch]:
    own = model(path)
    for batch in batches:
        column = batch.column("ids")
        flat, at = column.values.to_numpy(zero_copy_only=False), column.offsets.to_numpy()
        out = [own.decode(flat[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True)]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in rest), pa.array(out, pa.string())], [*rest, "decoded"])


def encode(docs: DataFrame, path: str) -> DataFrame:
    """docs' columns with ids (array<int>) added; a column of that name is replaced."""
    rest = [c for c in docs.columns if c != "ids"]
    return map_batches(docs.select(*columns([*rest, "text"])), lambda x: _encoded(x, path, rest), docs.select(*columns(rest)).schema.add("ids", T.ArrayType(T.IntegerType())))


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded's columns with decoded (string) added, the text of ids."""
    rest = [c for c in encoded.columns if c != "decoded"]
    return map_batches(encoded.select(*columns(rest)), lambda x: _decoded(x, path, rest), encoded.select(*columns(rest)).schema.add("decoded", "string"))


def checked(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, n_ids, decoded_sha256, round_trip): each text's ids, and whether they decode to the text.

    Both ways in one Python process, so that a task holds one model and not two."""
    want = F.sha2(F.regexp_replace(F.coalesce("text", F.lit("")), SPACE, " "), 256)
    given = docs.select("doc_id", want.alias("want"), "text")
    schema = given.drop("text").schema.add("ids", T.ArrayType(T.IntegerType())).add("decoded", "string")
    got = given.mapInArrow(lambda x: _decoded(_encoded(x, path, ["doc_id", "want"]), path, ["doc_id", "want", "ids"]), schema)
    got = got.withColumn("decoded_sha256", F.sha2("decoded", 256))
    return got.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "decoded_sha256", (F.col("decoded_sha256") == F.col("want")).alias("round_trip"))


def op1_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return checked(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
