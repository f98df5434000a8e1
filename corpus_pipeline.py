"""A corpus pipeline of five stages over documents: each is a function (spark, docs, sf_dir) that returns a DataFrame,
which is written as Parquet and read again as the next stage's docs.

1. language ID: documents whose language is undecided (no letter, or a score under ``LEAST_SCORE``) go; the model learns
   from the labelled documents of the stage's input.
2. n-gram Jaccard join: of each group of near-duplicates (five-word shingles, a Jaccard similarity of 0.8 or more) the
   document with the least doc_id stays, of several texts of that doc_id one.  Documents without shingles or without a
   doc_id stay; rows with the same doc_id and set are one.
3. secret scan: credentials, but for widely copied examples, are replaced in the texts; all documents stay.
4. mixing sources: documents are repeated or left out by Poisson counts, to the target weights.
5. SentencePiece: the texts' ids, and whether they decode to the texts.

Rows with a null text go in the first stage; extra columns are kept up to the fourth; an empty table passes through all.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.llm import language_id, ngram_join, secret_scan, sentencepiece_codec, source_mix
from fieldglass.llm._shared import IdMap, Tables, columns, free, quoted, stored

#: A score below one half means that no language has the odds on its side.
LEAST_SCORE = 0.5
WORDS, PERCENT = 5, 80


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language_id.identify(docs, language_id.train(docs))
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).select(*columns(docs.columns))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    id_, set_, touched_ = (free(docs, name) for name in ("_id", "_set", "_touched"))
    own = F.col("doc_id").cast("long").alias(id_)
    with Tables(spark) as work:
        groups = work.stored(ngram_join.classes(docs, WORDS, PERCENT, work.stored).where("doc_id IS NOT NULL"), "groups")
        spare = stored(groups.where("set IS NOT NULL AND NOT (doc_id <=> component_id AND set <=> keeper)").select(own, F.col("set").alias(set_)).distinct(), "pipeline-spare")
        repeated = groups.groupBy(own).count().where("count > 1").select(id_)
        ids_held = IdMap(spare.select(id_).union(repeated))
        held = spark.sparkContext.broadcast(ids_held)

    @F.pandas_udf("boolean")
    def touched(ids: pd.Series) -> pd.Series:
        return pd.Series(held.value.may_hold(ids.fillna(0).to_numpy(np.int64)) & ids.notna().to_numpy())

    # Only rows that the map holds are joined; texts of the others stay where they are.
    loose = docs.withColumn(touched_, touched(F.col("doc_id").cast("long"))).where(~F.col(touched_)).select(*columns(docs.columns))
    # Rows of one doc_id can have different texts: what goes is decided by doc_id and set.
    named = ngram_join.with_sets(docs.withColumn(id_, F.col("doc_id").cast("long")), WORDS, set_, (id_, ids_held))
    kept = named.join(spare, [id_, set_], "left_anti")
    # Rows with the same doc_id and set are copies, without shingles those with the same text: the one of the least hash stays.
    hashed = F.xxhash64(*(quoted(f.name) for f in docs.schema.fields if "map<" not in f.dataType.simpleString()))
    single = kept.groupBy(id_, F.coalesce(set_, F.xxhash64("text")).alias(set_)).agg(F.min_by(F.struct(*columns(docs.columns)), hashed).alias("row"))
    return loose.unionByName(single.select("row.*"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix(docs, source_mix.TARGETS, copy=free(docs, "copy"), shuffle_key=free(docs, "shuffle_key")).select(*columns(docs.columns))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.checked(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language ID", known_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("secret scan", without_secrets),
    ("mixing sources", mixed),
    ("SentencePiece", encoded),
]

#: Not SQL's work: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with Tables(spark) as own:
        for k, (_, stage) in enumerate(STAGES):
            last = k + 1 == len(STAGES)
            docs = stage(spark, docs, sf_dir)
            # A stage's table takes the place of the one before it.
            docs = stored(docs, "pipeline") if last else own.stored(docs, "stage")
    return docs
