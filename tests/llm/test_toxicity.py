import random

import pytest

from fieldglass.llm import toxicity as X

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice(["th", "an", "er", "on", "re", "é"]) for _ in range(rng.randint(1, 4)))
    rows, labels = [], []
    for k in range(900):
        own = [word() for _ in range(rng.randint(5, 120))]
        toxic = k % 8 == 0
        for _ in range(2 + len(own) // 20 if toxic else 0):
            own.insert(rng.randrange(len(own)), rng.choice(["Scoundrel,", "rotten", "BLOCKHEAD!"]))
        rows.append((k, " ".join(own), "en", "s", 0))
        labels.append((k, 0, int(toxic)))
    return rows, labels


def test_documents_kept_out_are_told_apart(spark, documents, corpus):
    rows, labels = corpus
    rows = rows + [(5000, None, "en", "s", 0), (5001, "", "en", "s", 0), (5002, "...", "en", "s", 0), (None, "rotten", "en", "s", 0), rows[0]]
    known = spark.createDataFrame([x for x in labels if x[0] % 3] + [(1, 0, None), (None, 0, 1)], LABELS)
    docs = documents(rows).repartition(3)
    got = [r.asDict() for r in X.rate(docs, X.train(docs, known)).collect()]
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    by = {r["doc_id"]: r for r in got}
    held = [x for x in labels if x[0] % 3 == 0]
    assert sum(by[i]["predicted"] == t for i, _, t in held) >= 0.98 * len(held)
    assert by[5000]["predicted"] == by[5001]["predicted"] == by[5002]["predicted"] == 0 and by[None]["predicted"] == 1


def test_labels_of_the_least_hashes(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(X, "LABELLED", 300)
    labels = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    known = X.labelled(labels)
    want = {r[0] for r in labels.orderBy(F.xxhash64("doc_id")).limit(300).select("doc_id").collect()}
    assert set(known.ids.tolist()) == want and len(known.ids) == 300
    assert all((known.kind // 2 == h).sum() > 100 for h in (0, 1)) and (known.kind % 2 == known.ids % 2).all()


def test_counts_are_those_of_all_documents(spark, documents):
    import numpy as np

    docs = documents(["a b a", "b c", "c c"])
    got = X.counts(docs, X.Labels(np.array([0, 1]), np.array([1, 0]), np.array([0, 1]))).collect()
    assert sorted((r["total"], r["toxic_0"], r["toxic_1"], r["ordinary_0"], r["ordinary_1"]) for r in got) == [(2, 1, 0, 0, 1), (2, 2, 0, 0, 0), (3, 0, 0, 0, 1)]


def test_tables_without_documents_or_labels(spark, documents):
    none = spark.createDataFrame([], LABELS)
    assert X.rate(documents([]), X.train(documents([]), none)).count() == 0
    docs = documents(["a", "b"])
    assert [r["score"] for r in X.rate(docs, X.train(docs, none)).collect()] == [0, 0]


def test_ratios_are_those_of_exact_counts(spark, documents):
    import math
    from collections import Counter

    import numpy as np
    import pyarrow as pa

    rng = random.Random(9)
    texts = [" ".join(rng.choice(["common", "commonly", "commons", "rare", f"only{k}", "commonest", "z"]) for _ in range(20)) for k in range(60)]
    model = X.Model(X.counts(documents(texts), X.Labels(np.arange(40), (np.arange(40) % 4 == 0).astype(int), np.arange(40) % 3 % 2)))
    words = {c: Counter(w for k in range(40) if (k % 4 == 0) == (c == "toxic") for w in texts[k].split()) for c in ("toxic", "ordinary")}
    total = Counter(w for x in texts for w in x.split())
    stems = Counter()
    for w, n in total.items():
        stems[w[:6]] += n

    def p(c, w):
        n, d = words[c], X.DISCOUNT
        m = Counter(x[:6] for x in n)
        low = max(m[w[:6]] - d, 0) / len(n) + d * len(m) / len(n) * stems[w[:6]] / sum(stems.values())
        return max(n[w] - d, 0) / sum(n.values()) + d * len(n) / sum(n.values()) * low * total[w] / stems[w[:6]]

    for w in total:
        word, stem, _ = X.expressions(pa.array([w]))
        assert model.ratios(word, stem)[0] == pytest.approx(math.log(p("toxic", w) / p("ordinary", w)), abs=1e-5), w


def test_mild_words_count_for_and_ordinary_words_against(spark, documents):
    import numpy as np
    import pyarrow as pa

    texts = ["mild " * 3 + "plain " * 2 + "both " * 5, "mild " * 1 + "plain " * 4 + "both " * 5] * 20
    model = X.Model(X.counts(documents(texts), X.Labels(np.arange(40), (np.arange(40) % 2 == 0).astype(int), np.arange(40) % 3 % 2)))
    mild, plain, empty = model.evidence(pa.array(["mild mild both", "plain plain both", ""]))
    assert 0 < mild[0] < X.MARGIN and plain[0] < 0 and empty[0] == 0


def auc(pairs):
    """Of (score, label): how often a toxic document scores higher."""
    toxic, ordinary = ([s for s, t in pairs if t == k] for k in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in toxic for b in ordinary) / (len(toxic) * len(ordinary))


@pytest.mark.parametrize("few", [20, 60])
def test_few_labels(spark, documents, corpus, few):
    """Twenty labels, of which some are toxic, tell toxic documents apart; the rest are told by these."""
    rows, labels = corpus
    known = [x for x in labels if x[2]][: few // 4] + [x for x in labels if not x[2]][: 3 * few // 4]
    got = {r["doc_id"]: r["score"] for r in X.rate(documents(rows), X.train(documents(rows), spark.createDataFrame(known, LABELS))).collect()}
    assert auc([(got[i], t) for i, _, t in labels if (i, 0, t) not in known]) > 0.9


def test_a_half_without_a_class(spark, documents, corpus):
    """One toxic label is in one half, so only that half has evidence; one of each class leaves none of both."""
    rows, labels = corpus
    ordinary = [x for x in labels if not x[2]]
    for known in ([labels[0], *ordinary[:30]], [labels[0], ordinary[0]]):
        model = X.train(documents(rows), spark.createDataFrame(known, LABELS))
        assert model.known and model.curve[1:].min() >= 0 and model.curve[1:].max() > 0
        got = {r["doc_id"]: r["score"] for r in X.rate(documents(rows), model).collect()}
        assert auc([(got[i], t) for i, _, t in labels]) > 0.6


def test_long_texts_and_clashing_columns(spark, documents, corpus):
    rows, labels = corpus
    long = (7000, "plain words " * 100_000 + "rotten scoundrel blockhead " * 20_000, "en", "s", 0)
    docs = documents([*rows, long]).selectExpr("*", "'x' AS score", "1 AS predicted", "2 AS toxic", "3 AS word", "4 AS x", "5 AS `a.b`")
    got = {r["doc_id"]: r for r in X.rate(docs, X.train(docs, spark.createDataFrame(labels, LABELS))).collect()}
    assert got[7000]["predicted"] == 1 and got[7000]["toxic"] == 2 and got[7000]["x"] == 4 and got[7000]["a.b"] == 5 and isinstance(got[1]["score"], float)
