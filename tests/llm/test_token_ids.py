import io
import sys
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from fieldglass.llm import token_ids as T

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", None, "a", "Ünïcode  é  x", "\x1cab\x1d c", "<|endoftext|> x<|startoftext|>", "it's we'll 123", " wide　", "😀 😀", "a\x85b", "<|ENDOFTEXT|> <|endoftext|>", "İ ǅ Σς", "it's. a.. b!? 5. é. x'. don't, 's", ". , a"]


def expected(rows):
    encoder = Tokenizer.from_file(PATH)
    start = 0
    for key, text in rows:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, T.END_ID]
        yield key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_words_alone_give_the_same_ids_as_whole_texts():
    spaces = [f"a{chr(i)}b" for i in range(sys.maxunicode + 1) if chr(i).isspace()]
    encoder, ids_of = Tokenizer.from_file(PATH), T.tokenizer(PATH)
    for text in [*ODD, *spaces]:
        ids, _ = T.encode_texts(pa.array([text], pa.string()), ids_of)
        assert ids.tolist() == [*encoder.encode(text or "", add_special_tokens=False).ids, T.END_ID], text


def test_memory_begun_anew_gives_the_same_ids():
    ids_of = T.WordIds(PATH)
    text = pa.array([" ".join(f"w{k % 700} É{k}" for k in range(3000))])
    want, _ = T.encode_texts(text, ids_of)
    ids_of.LIMIT = 100
    for _ in range(2):
        assert (T.encode_texts(text, ids_of)[0] == want).all()


def test_files_give_back_what_was_written(spark, documents, monkeypatch):
    texts = [*ODD, "word " * 5000, *["the same text"] * 5]
    docs = documents(texts).repartition(3)
    got = sorted(map(tuple, T.read(T.write(docs, PATH), T.digests, "doc_id long, start long, n_tokens long, ids_crc32 long").collect()))
    assert got == list(expected(enumerate(texts)))


def test_blocks_round_trip_and_broken_files_fail():
    ids = np.array([5, 7, 5, 70000, 2**31] + list(range(600)), np.uint32)
    raw = T.block([3, None], np.array([4, len(ids) - 4]), ids)
    (names, counts, back), again = list(T.blocks(io.BytesIO(raw * 2)))
    assert names == [3, None] and counts.tolist() == [4, len(ids) - 4] and (back == ids).all() and (again[2] == ids).all()
    with pytest.raises(ValueError):
        list(T.blocks(io.BytesIO(raw[:-1])))


def test_empty_table_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    assert T.read(T.write(documents([]), PATH), T.digests, schema).count() == 0
    docs = documents(["a b", "c"]).withColumn("ids", F.lit(1)).withColumn("path", F.lit("x"))
    assert T.read(T.write(docs, PATH), T.digests, schema).count() == 2
