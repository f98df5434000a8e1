import random
import re
from collections import Counter, defaultdict

import pytest

from fieldglass.llm import ngram_join as N


def brute(rows, words, percent):
    """rows: (doc_id, text)."""
    sets = []
    for _, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))} if own else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, own in enumerate(sets):
        for x, n in Counter(j for e in own for j in holders[e]).items():
            if 100 * n >= percent * (len(own) + len(sets[x]) - n):
                parent[root(i)] = root(x)
        for e in own:
            holders[e].append(i)
    least = defaultdict(list)
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)].append(key)
    return sorted(((k, len(own), min(least[root(i)], default=None)) for i, ((k, _), own) in enumerate(zip(rows, sets))), key=repr)


def edited(rng, words, edits):
    out = list(words)
    for _ in range(edits):
        k = rng.randrange(len(out))
        what = rng.random()
        out[k : k + 1] = [] if what < 0.3 and len(out) > 2 else [f"new{rng.randrange(10**6)}"] if what < 0.8 else [out[k], "more"]
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 4)))
    passage = [word() for _ in range(40)]
    texts = [None, "", " \t\n", "one", "One", "two words", "a b c d e f g h", "ÀÉ à"]
    for size in (3, 8, 9, 12, 14, 15, 16, 17, 18, 20, 30, 60, 150, 700):
        for _ in range(3):
            base = [word() for _ in range(size)]
            texts += [" ".join(edited(rng, base, e)) for e in (0, 0, 1, 1, 2, 3, 5, size // 20, size // 12)]
            texts.append(" ".join(passage + base))
    # A group of near copies, among them some that link to few others or none.
    base = [word() for _ in range(147)]
    texts += [" ".join(edited(rng, base, rng.randint(0, 9))) for _ in range(150)]
    rows = [(k if k % 50 else None, x) for k, x in enumerate(texts)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80), (1, 50)])
def test_groups_are_those_of_all_links(spark, documents, monkeypatch, words, percent):
    monkeypatch.setattr(N, "BLOCK", 40)
    rows = corpus(words)
    docs = documents([(k, x, "en", "s", 0) for k, x in rows]).repartition(3)
    got = sorted((tuple(r) for r in N.join(docs, words, percent).collect()), key=repr)
    assert got == brute(rows, words, percent)


def test_boundary_comes_from_the_cost():
    sizes = N.Sizes(85)
    assert sizes.subsets(sizes.boundary) <= N.SCAN_COST * 2 * (sizes.difference(sizes.boundary) + 2) < sizes.subsets(sizes.boundary + 1) * 2
    for n in range(1, 200):
        for m in range(sizes.smallest(n), n + 1):
            for common in range(m + 1):
                if 100 * common >= 85 * (n + m - common):
                    assert n + m - 2 * common <= sizes.difference(m) and n - common <= sizes.missing(n)


def test_empty_table_and_clashing_columns(spark, documents):
    from pyspark.sql import functions as F

    assert N.join(documents([]), 4, 85).count() == 0
    docs = documents(["a b c d e"] * 3).withColumn("set", F.lit(1)).withColumn("component_id", F.lit(9))
    assert {tuple(r) for r in N.join(docs, 4, 85).collect()} == {(0, 2, 0), (1, 2, 0), (2, 2, 0)}


@pytest.mark.parametrize("words, percent", [(4, 85), (1, 50)])
def test_links_are_those_of_all_pairs(spark, documents, monkeypatch, words, percent):
    monkeypatch.setattr(N, "BLOCK", 40)
    rows = corpus(words)
    docs = documents([(k, x, "en", "s", 0) for k, x in rows]).repartition(3)
    sets = []
    for _, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append(frozenset(tuple(own[i : i + words]) for i in range(max(1, len(own) - words + 1))) if own else frozenset())
    distinct = sorted({x for x in sets if x}, key=len)
    links = Counter()
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                links.update((a, b))
    got = N.link_counts(docs, words, percent).collect()
    assert sorted(((r["doc_id"], r["n_links"]) for r in got), key=repr) == sorted(((k, links[x]) for (k, _), x in zip(rows, sets)), key=repr)
    assert len({r["class_id"] for r in got if r["class_id"] is not None}) == len(distinct) and sum(links.values()) > 1000


def test_no_window_holds_a_whole_list(spark, documents):
    import inspect

    assert "Window" not in inspect.getsource(N)
