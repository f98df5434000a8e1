import random

import pytest

import corpus_pipeline as P
from tests.llm.test_ngram_join import brute, edited


@pytest.fixture
def rows():
    rng = random.Random(8)
    syllables = {"en": ["th", "er", "ing", "on"], "de": ["sch", "ung", "ei", "ü"]}
    out = []
    for k in range(60):
        lang = rng.choice(["en", "de"])
        words = ["".join(rng.choice(syllables[lang]) for _ in range(3)) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.choice([1, 1, 2, 3])):
            out.append((len(out), " ".join(edited(rng, words, rng.choice([0, 1, 2]))), lang, f"src{k % 3}", 0))
    out += [(900, None, "en", "src1", 0), (901, "12345 ...", "en", "src1", 9), (902, f"{out[0][1]} ending token = Zq83hT0pLw5XvB9rKd2Y", out[0][2], "src2", 0), out[3], (903, "", "de", "src1", 0)]
    return out


def test_stages_one_by_one(spark, documents, rows, tmp_path):
    docs = documents(rows).repartition(3)
    known = P.known_language(spark, docs, "")
    assert known.columns == docs.columns
    assert sorted(r["doc_id"] for r in known.collect()) == sorted(r[0] for r in rows if r[0] not in (900, 901, 903))

    known.write.parquet(f"file://{tmp_path}/a")
    left = [tuple(r) for r in spark.read.parquet(f"file://{tmp_path}/a").collect()]
    single = P.one_of_each_group(spark, spark.read.parquet(f"file://{tmp_path}/a"), "")
    want = sorted({k for (k, _, least) in brute([(r[0], r[1]) for r in left], 5, 80) if k == least})
    assert sorted(r["doc_id"] for r in single.collect()) == want and single.columns == docs.columns

    clean = P.without_secrets(spark, docs, "").collect()
    assert len(clean) == len(rows) and not any("Zq83hT0pLw5XvB9rKd2Y" in (r["text"] or "") for r in clean)
    mixed = P.mixed(spark, docs, "")
    assert mixed.columns == docs.columns and set(r["doc_id"] for r in mixed.collect()) <= {r[0] for r in rows}
    assert all(r["round_trip"] for r in P.encoded(spark, docs, "").collect())


def test_whole_run_and_empty_table(spark, documents, rows, tmp_path):
    documents(rows).write.parquet(f"file://{tmp_path}/one/documents.parquet")
    got = P.run(spark, f"file://{tmp_path}/one").collect()
    assert got and all(r["round_trip"] for r in got)
    documents([]).write.parquet(f"file://{tmp_path}/none/documents.parquet")
    assert P.run(spark, f"file://{tmp_path}/none").count() == 0


def test_texts_that_share_a_doc_id_are_kept_apart(spark, documents, tmp_path):
    rng = random.Random(2)
    one, two, three, four = (" ".join(f"{name}{rng.randrange(10**6)}" for _ in range(60)) for name in "abcd")
    rows = [(1, one), (5, one + " more"), (5, two), (5, two), (6, three), (6, four), (7, four + " more"), (8, three), (8, three + " more"), (None, one), (9, ""), (9, " ")]
    documents([(k, x, "en", "s", 0) for k, x in rows]).write.parquet(f"file://{tmp_path}/a")
    got = [(r["doc_id"], r["text"]) for r in P.one_of_each_group(spark, spark.read.parquet(f"file://{tmp_path}/a"), "").collect()]
    assert sorted(got, key=repr) == sorted([(1, one), (5, two), (6, three), (6, four), (None, one), (9, ""), (9, " ")], key=repr)
    near = [(3, one), (3, one + " more"), (4, one)]
    got = [r["doc_id"] for r in P.one_of_each_group(spark, documents([(k, x, "en", "s", 0) for k, x in near]), "").collect()]
    assert got == [3]
