"""Extra columns with names that need quotes pass through every operator that keeps columns."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import fingerprint, language_id, secret_scan, sentencepiece_codec, source_mix

ODD = ("a.b", "a`b", "a")


@pytest.fixture
def docs(documents):
    made = documents(["the cat sat on the mat", "", None, "token = Zq83hT0pLw5XvB9rKd2Y and more"])
    for name in ODD:
        made = made.withColumn(name, F.col("doc_id") * 2)
    return made


def kept(got, docs, more):
    rows = got.collect()
    assert set(got.columns) == {*docs.columns, *more}
    assert rows and all(r[name] == r["doc_id"] * 2 for r in rows for name in ODD)
    return rows


def test_encode_and_decode(docs):
    path = public_tokenizers.path("piece_bpe_32k.model")
    kept(sentencepiece_codec.decode(sentencepiece_codec.encode(docs, path), path), docs, ["ids", "decoded"])


def test_redact(docs):
    rows = kept(secret_scan.redact(docs), docs, [])
    assert {r["doc_id"]: r["text"] for r in rows}[3] == "token = <SECRET> and more"


def test_mix(docs):
    kept(source_mix.mix(docs, {"src0": 1.0}, size=12), docs, ["copy", "shuffle_key"])


def test_fingerprints(docs):
    kept(fingerprint.fingerprints(docs), docs, ["fingerprint"])


def test_identify(docs):
    kept(language_id.identify(docs, language_id.train(docs)), docs, ["lang_pred", "score"])


def test_stages_of_the_pipeline(spark, docs):
    import corpus_pipeline

    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns, name
        assert all(r[c] == r["doc_id"] * 2 for r in got.collect() for c in ODD), name
