import math
import random

from pyspark.sql import functions as F

from fieldglass.llm import source_mix as M


def test_steps_are_poisson_probabilities():
    for rate in (0.2, 3.0, 80.0):
        steps = M.steps(rate)
        assert abs(steps[0] - math.exp(-rate)) < 1e-12 and steps[-1] > 1 - 1e-9 and steps == sorted(steps)
    assert M.steps(0) == []


def test_shares_come_out_as_aimed_and_counts_are_poisson(spark):
    docs = spark.range(20000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("rare").alias("source"))
    got = M.mix(docs, {"big": 0.2, "mid": 0.3, "rare": 0.5})
    n = {r["source"]: r["count"] for r in got.groupBy("source").count().collect()}
    assert all(abs(n[s] / 20000 - w) < 0.02 for s, w in {"big": 0.2, "mid": 0.3, "rare": 0.5}.items())
    copies = got.where("source = 'rare'").groupBy("doc_id").count().select(F.var_samp("count")).first()[0]
    assert 3 < copies < 7  # mean and variance are 5


def test_high_rates_are_drawn_in_parts(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") < 300, "rare").otherwise("big").alias("source"))
    n = [r["count"] for r in M.mix(docs, {"rare": 1.0}, size=300 * 700.0).where("source = 'rare'").groupBy("doc_id").count().collect()]
    mean = sum(n) / len(n)
    assert len(n) == 300 and abs(mean - 700) < 8 and 500 < sum((x - mean) ** 2 for x in n) / len(n) < 950
    assert len(M.steps(M.PIECE)) < 500
    # Below PIECE a count is the one number's quantile.
    u = {r["doc_id"]: r["u"] for r in docs.select("doc_id", M.uniform(F.lit(str(M.SEED)), F.col("doc_id").cast("string")).alias("u")).collect()}
    got = {r["doc_id"]: r["count"] for r in M.mix(docs, {"rare": 1.0}, size=900).where("source = 'rare'").groupBy("doc_id").count().collect()}
    assert got == {k: c for k in range(300) if (c := sum(x <= u[k] for x in M.steps(3.0)))}


def test_copies_are_whole_and_order_is_mixed(documents):
    rng = random.Random(1)
    rows = [(k, None if k % 9 == 0 else f"t{k}", "en", rng.choice(["a", "b", None]), 1) for k in range(400)] + [(7, "t7", "en", "a", 1)]
    got = M.mix(documents(rows).withColumn("u", F.lit(1)), {"a": 1.0, "none": 3.0}).collect()
    assert all(r["text"] == (None if r["doc_id"] % 9 == 0 else f"t{r['doc_id']}") for r in got)
    by = {}
    for r in got:
        by.setdefault((r["doc_id"], r["source"]), []).append(r["copy"])
    assert all(sorted(set(x)) == list(range(max(x) + 1)) for x in by.values())
    assert all(len(by[k, s]) == 1 for k, _, _, s, _ in rows if s != "a")
    assert [r["doc_id"] for r in got] != sorted(r["doc_id"] for r in got)


def test_weights_of_zero_and_empty_tables(documents):
    assert M.mix(documents([]), {"a": 1.0}).count() == 0
    assert M.mix(documents(["x", "y"]), {"src0": 0.0, "z": 1.0}).count() == 0
    assert M.mix(documents(["x", "y"]), {}).count() == 2


def test_columns_of_the_same_names(spark, documents):
    docs = documents([(k, "x", "en", "src0", 1) for k in range(50)]).withColumn("copy", F.lit(77)).withColumn("_u", F.lit(5))
    got = M.mix(docs, {"src0": 1.0}, size=100)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "_u", "copy", "shuffle_key"] and {r["_u"] for r in got.collect()} == {5}
    kept = M.mix(docs, {"src0": 1.0}, size=100, copy="copy_", shuffle_key="k")
    assert {r["copy"] for r in kept.collect()} == {77} and sorted((r["doc_id"], r["copy_"]) for r in kept.collect()) == sorted((r["doc_id"], r["copy"]) for r in got.collect())
