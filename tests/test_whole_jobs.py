"""Whole jobs against brute force: every probe day, every line, every pair that evidence brings together."""

import collections
import itertools
import random
from collections import defaultdict

from fieldglass.operators import identity as I
from fieldglass.operators import joins as J
from fieldglass.operators import seasons as S
from fieldglass.operators import windows as W
from fieldglass.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"


def test_members_of_every_day(spark):
    spells = [r.asDict() for r in QUERIES["gaps_islands_spells"](spark, FOLDER).collect()]
    days = {d + 1 for s in spells for d in (s["first_day"], s["last_day"])} | {r["probe_day"] for r in QUERIES["membership_asof_day"](spark, FOLDER).collect()}
    got = {r["probe_day"]: (r["members"], r["who_sum"]) for r in QUERIES["membership_every_day"](spark, FOLDER).collect()}
    assert any((d - 1) % 3 for d in got)
    for day in days | set(got):
        held = [s["who"] for s in spells if s["first_day"] <= day and (s["until_day"] is None or s["until_day"] > day)]
        if held:
            assert got[day] == (len(held), sum(held))


def test_membership_has_no_join_on_a_constant(spark):
    spells = spark.createDataFrame([(1, 0, None), (2, 1, 3), (4, 3, 4)], "who long, first long, until long")
    got = W.membership(spells, spark.createDataFrame([(k,) for k in (-1, 0, 1, 2, 3, 4, 9)], "day long"), "first", "until", "day", {"s": "who"})
    assert sorted(map(tuple, got.select("day", "members", "s").collect())) == [(0, 1, 1), (1, 2, 3), (2, 2, 3), (3, 2, 5), (4, 1, 1), (9, 1, 1)]


def test_nearest_without_a_product_is_that_of_all_pairs(spark):
    rng = random.Random(3)
    left = [(k // 2 if k % 9 == 0 else k, rng.randrange(4), rng.randrange(60)) for k in range(300)]
    right = [(k, rng.randrange(3), rng.randrange(60)) for k in range(40)]
    got = J.nearest_sorted(spark.createDataFrame(left, "id long, k long, x long"), spark.createDataFrame(right, "part long, k long, y long"), ["k"], ["id"], "part", "x", "y", 5, 2)
    each = defaultdict(list)
    for i, k, x in left:
        each[i] += [(abs(x - y), part) for part, own, y in right if own == k]
    want = []
    for i, near in each.items():
        near.sort()
        if near and near[0][0] <= 5 and (len(near) == 1 or near[1][0] - near[0][0] >= 2):
            want.append((i, near[0][1], near[0][0]))
    assert sorted(tuple(r) for r in got.select("id", "part", "distance").collect()) == sorted(want)


def test_all_players_look_for_a_nearest_part(spark):
    got = QUERIES["nearest_with_separation_all"](spark, FOLDER).collect()
    some = QUERIES["nearest_with_separation"](spark, FOLDER).collect()
    assert any(r["player"] % 20 for r in got) and sorted(map(tuple, some)) == sorted(map(tuple, got))


def test_whole_texts_are_normalised(spark, tmp_path):
    text = "Nikola Jokić " * 10 + "O'Neal Jr."
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"file://{tmp_path}/documents.parquet")
    (got,) = QUERIES["name_normalise_folded"](spark, f"file://{tmp_path}").collect()
    assert got["key"] == "nikola jokic " * 10 + "oneal jr" and got["base"] == "nikola jokic " * 10 + "oneal" and got["bare"].endswith("oneal jr")


def test_no_pair_that_can_be_linked_is_left_out(spark):
    from pyspark.sql import functions as F

    from fieldglass.plans import models

    table = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    every = models._people(table, "").crossJoin(models._people(table, "c_")).withColumn("confirmed", F.col("c_id") % 2 == 0)
    every = every.where("abs(datediff(birthdate, c_birthdate)) <= 1 OR id % 7 = 0")
    want = {tuple(r) for r in I.score(every).where("decision IN ('propose', 'auto_link')").select("id", "c_id", "score").collect()}
    rows = QUERIES["identity_score"](spark, FOLDER).collect()
    got = [(r["id"], r["c_id"]) for r in rows]
    assert want <= {(r["id"], r["c_id"], r["score"]) for r in rows} and len(got) == len(set(got))
    assert {i for i, _ in got} == {r[0] for r in table("customer").select("c_custkey").collect()}
    far = spark.createDataFrame([(1, "Ann Lee", "1980-01-01"), (9000, "Ann Lee Jr.", None), (9001, "Bo", "1980-01-02")], "id long, name string, birthdate string").withColumn("birthdate", F.to_date("birthdate"))
    other = far.select(*(F.col(c).alias(f"c_{c}") for c in far.columns))
    pairs = sorted((r["id"], r["c_id"]) for r in I.candidate_pairs(far, other).collect())
    assert pairs == [(1, 1), (1, 9000), (1, 9001), (9000, 1), (9000, 9000), (9001, 1), (9001, 9001)]


def test_token_pairs_are_all_pairs_over_the_threshold(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abcdefghijk") for _ in range(rng.randint(1, 9))) for _ in range(120)]
    table = spark.createDataFrame(list(enumerate(texts)), "id long, s string")
    for least in (0.0, 0.5):
        want = []
        for b, y in enumerate(texts):
            for a, x in enumerate(texts[:b]):
                p, q = set(x.split(" ")), set(y.split(" "))
                if p & q and len(p & q) >= least * len(p | q):
                    want.append((a, b))
        got = I.token_pairs(table, "id", "s", least).collect()
        assert sorted((r["a"], r["b"]) for r in got) == sorted(want)


def test_lattice_of_units_of_any_length(spark):
    rng = random.Random(5)
    units = [(rng.randrange(2), [rng.randrange(12) for _ in range(n)], rng.randrange(9)) for n in (0, 1, 2, 5, 7, 11) for _ in range(3)] + [(0, None, 4)]
    got = S.lattice(spark.createDataFrame(units, "k int, m array<int>, v int"), ["k"], "m", ["v"], (1, 2, 5)).collect()
    want = collections.Counter()
    for k, m, v in units:
        for size in (1, 2, 5):
            for s in itertools.combinations(sorted(set(m or [])), size):
                want[k, "-".join(map(str, s)), size] += v
    assert {(r["k"], r["unit"], r["size"]): r["v"] for r in got} == dict(want)
    assert len(got) == len(want)
