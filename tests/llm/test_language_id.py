import math
import random
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldglass.llm import language_id as G

SYLLABLES = {"aa": ["th", "er", "ing", "on"], "bb": ["sch", "ung", "ei", "ü"], "cc": ["да", "не", "то"]}


def corpus():
    rng = random.Random(1)
    return [(k, " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(3)) for _ in range(rng.randint(3, 60))), lang, "s", 0) for k in range(300) for lang in [rng.choice(sorted(SYLLABLES))]]


def buckets(text):
    """A gram at a time."""
    x = [ord(c.lower()[0]) if c.isalpha() else 32 for c in f" {text} "]
    out, m = Counter(), 0xFFFFFFFF
    for n in range(1, G.ORDERS + 1):
        for i in range(len(x) - n + 1):
            h = 0
            for c in x[i : i + n]:
                h = (h * 0x01000193 + (c + 1) * 0x9E3779B1) & m
            out[((h ^ h >> 15) * 0x85EBCA6B & m) >> (32 - G.BITS)] += 1
    return out


def brute(labelled, text):
    """Multinomial naive Bayes, cell by cell."""
    if text is None or not any(c.isalpha() for c in text):
        return "und", 0.0
    by = {}
    for x, lang in labelled:
        by.setdefault(lang, Counter()).update(buckets(x))
    own = buckets(text)
    scale = min(1, G.EVIDENCE / sum(own.values()))
    total = {lang: scale * sum(k * math.log((n[b] + G.ALPHA) / (sum(n.values()) + G.ALPHA * 2**G.BITS)) for b, k in own.items()) for lang, n in by.items()}
    best = max(sorted(total), key=total.get)
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


@pytest.mark.parametrize("block, piece", [(512, 1 << 18), (2, 50)])
def test_same_as_naive_bayes_cell_by_cell(spark, documents, monkeypatch, block, piece):
    monkeypatch.setattr(G, "BLOCK", block)
    monkeypatch.setattr(G, "PIECE", piece)
    rows = corpus()[:40]
    model = G.train(documents(rows).where("doc_id % 3 <> 1"))
    assert len(list(model.matrices())) == (1 if block > 3 else 2)
    docs = [*(x for _, x, _, _, _ in rows[:12]), "", "12 ..", "é", "thingong " * 30, "a" * 200, "никто"]
    names, scores = G.score_texts(docs, model)
    for x, name, score in zip(docs, names, scores, strict=True):
        want = brute([(r[1], r[2]) for r in rows if r[0] % 3 != 1], x)
        assert name == want[0] and score == pytest.approx(want[1], rel=1e-9), x


def test_languages_kept_out_are_told_apart(spark, documents):
    rows = corpus()
    odd = [(1000, None), (1001, ""), (1002, "123 ... \n"), (1003, "THING " * 400000), (None, "ungung")]
    docs = documents(rows + [(k, x, None, "s", 0) for k, x in odd] + [rows[0]]).repartition(3)
    model = G.train(docs.where("doc_id % 3 <> 1"))
    assert model.langs == ["aa", "bb", "cc"]
    got = {r["doc_id"]: r for r in G.identify(docs.withColumn("score", F.lit("old")).withColumn("bucket", F.lit(1)), model).collect()}
    assert all(got[k]["lang_pred"] == lang for k, _, lang, _, _ in rows)
    assert [got[k]["lang_pred"] for k in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"] and got[1002]["score"] == 0
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[0]["text"] == rows[0][1] and got[0]["bucket"] == 1


def test_many_languages_are_no_error(spark, documents):
    rng = random.Random(4)
    alphabet = "abcdefghijklmnopqrstuvwxyz"
    rows = [(k, " ".join("".join(rng.sample(alphabet, 4)) for _ in range(20)), f"l{k:04d}", "s", 0) for k in range(G.BLOCK + 60)]
    model = G.train(documents(rows))
    assert len(model.langs) == len(rows) and len(model.files) == 2
    got = {r["doc_id"]: r["lang_pred"] for r in G.identify(documents(rows[::97]).coalesce(1), model).collect()}
    assert got == {r[0]: r[2] for r in rows[::97]}


def test_memory_does_not_grow_with_text_and_languages():
    langs = [f"l{k}" for k in range(512)]
    model = G.Model(langs, np.random.default_rng(1).normal(size=(1 << G.BITS, 512)))
    text = "some thing " * 900_000
    G.score_texts(["x"], model)
    tracemalloc.start()
    names, scores = G.score_texts([text], model)
    assert tracemalloc.get_traced_memory()[1] < 200e6 and 0 < scores[0] <= 1
    tracemalloc.stop()


def test_scores_of_a_text_do_not_depend_on_its_neighbours():
    model = G.Model(["aa", "bb"], np.random.default_rng(1).normal(size=(1 << G.BITS, 2)))
    docs = ["abc", "", "é", "long " * 100, "x"] * 30
    alone = [G.score_texts([x], model) for x in docs]
    names, scores = G.score_texts(docs, model)
    assert names == [n[0] for n, _ in alone] and abs(scores - [s[0] for _, s in alone]).max() < 1e-12


def test_without_labels_or_rows(spark, documents):
    model = G.train(documents([]))
    assert G.identify(documents([]), model).count() == 0
    assert [r["lang_pred"] for r in G.identify(documents(["abc", None]), model).collect()] == ["und", "und"]
