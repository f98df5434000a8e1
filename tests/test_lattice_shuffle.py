"""Subsets that one unit alone has aren't shuffled; those that come again are added up."""

import collections
import itertools
import random

from fieldglass.operators import seasons as S


def summed(units, sizes):
    want = collections.Counter()
    for k, m, v in units:
        for n in sizes:
            for s in itertools.combinations(sorted(set(m or [])), n):
                want[k, "-".join(map(str, s)), n] += v
    return want


def test_only_units_with_a_pair_that_comes_again_are_added_up(spark, monkeypatch):
    rng = random.Random(8)
    # Of two keys: some units share pairs, most share single members only or nothing, one comes twice.
    units = [(g % 2, rng.sample(range(400), rng.randint(1, 7)), g) for g in range(150)]
    units += [(0, [1000, 1001, 1002], 5), (0, [1001, 1002, 1003], 7), (1, [1001, 1002], 9), (1, [], 3), (0, None, 3), (0, [1000, 1001, 1002], 1)]
    added = []
    rows = S._subset_rows
    monkeypatch.setattr(S, "_subset_rows", lambda of, *a: added.append(of) or rows(of, *a))
    for sizes in ((2, 3, 4, 5), (1, 3), (1,)):
        added.clear()
        got = S.lattice(spark.createDataFrame(units, "k int, m array<int>, v int"), ["k"], "m", ["v"], sizes).collect()
        want = summed(units, sizes)
        assert {(r["k"], r["unit"], r["size"]): r["v"] for r in got} == dict(want) and len(got) == len(want)
        if sizes == (2, 3, 4, 5):
            shared, alone = (of.count() for of in added)
            assert 3 <= shared < alone and shared + alone == len(units)
