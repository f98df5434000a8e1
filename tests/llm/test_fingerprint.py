import hashlib
import random

import numpy as np
import pytest

from fieldglass.llm import fingerprint as P


def slow_tossed(cur, prev):
    bit = ((cur ^ prev) & -(cur ^ prev)).bit_length() - 1
    return 2 * bit + (cur >> bit & 1)


def slow_parse(x):
    """One level, a symbol at a time."""
    blocks = []
    for s in x:
        if blocks and blocks[-1][0] == s:
            blocks[-1][1] += 1
        else:
            blocks.append([s, 1])
    m64 = (1 << 64) - 1
    mixed = lambda v: int(P.mix(np.array([v & m64], np.uint64))[0])
    x = [s if n == 1 else mixed(s * int(P._ODD) + n) for s, n in blocks]
    label = x
    for _ in range(4):
        label = [slow_tossed(c, label[i - 1] if i else c ^ 1) for i, c in enumerate(label)]
    assert all(v < 6 for v in label) or len(label) < 6
    cut = [i for i in range(len(x)) if i == 0 or i < len(x) - 1 and label[i - 1] < label[i] > label[i + 1]] + [len(x)]
    return [mixed(sum(mixed(v + k * int(P._ODD)) for k, v in enumerate(x[a:b])) + b - a) for a, b in zip(cut, cut[1:])]


def slow_sketch(text):
    x = [int(v) for v in P.mix(np.array([ord(c) + 1 for c in text], np.uint64))]
    found, level = set(), 0
    while text:
        x = slow_parse(x)
        level += 1
        if level >= P.LEVEL or len(x) == 1:
            found |= {int(v) >> 32 for v in P.mix(np.array(x, np.uint64) + np.uint64(level))}
        if len(x) == 1:
            break
    return sorted(found)[: P.SKETCH]


TEXTS = ["", "a", "ab", "aaaa" * 300, "abab" * 200, "é日本😀" * 40, "the quick brown fox " * 30 + "x", "z"]


def made(seed, n):
    rng = random.Random(seed)
    return "".join(rng.choice("etaoin shrdlu") for _ in range(n))


def test_sketches_are_those_of_a_parse_symbol_by_symbol():
    docs = [*TEXTS, *(made(k, 37 * k) for k in range(30)), "tail"]
    assert [x.tolist() for x in P.sketches(docs)] == [slow_sketch(x) for x in docs]


def test_equal_substrings_share_names_at_any_offset():
    body = made(1, 4000)
    a, b, c = P.sketches([body, made(2, 7) + body, made(3, 4000)])
    assert P.likeness(a, b) > 0.9 and P.likeness(a, c) < 0.1 and P.likeness(a, a) == 1


@pytest.mark.parametrize("partitions", [1, 5])
def test_every_document_against_its_edited_text_and_the_next_one(spark, documents, partitions):
    rows = [(k * 3, made(k, 50 * k) if k % 7 else None, "en", "s", 0) for k in range(40)]
    rows += [(None, "first of all", "en", "s", 0), (117, made(39, 100), "en", "s", 0)]
    got = sorted(map(tuple, P.with_edited(documents(rows).repartition(4), partitions).collect()), key=repr)
    digest = lambda x: next(iter(documents([x]).selectExpr("xxhash64(text)").first()))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1]) if r[0] == 117 else 0))
    want = []
    for this, after in zip(order, order[1:] + order[:1]):
        text, other = this[1] or "", after[1] or ""
        k = len(text) // 4
        new = text[: len(text) - k] + other[:k]
        one, two, three = P.sketches([text, new, other])
        want.append((this[0], len(text), hashlib.sha256(new.encode()).hexdigest(), P.text_of(one), P.text_of(two), P.likeness(one, two), P.likeness(one, three)))
    assert got == sorted(want, key=repr)


def test_one_document_and_none(spark, documents):
    (only,) = P.with_edited(documents(["abcdefgh"])).collect()
    assert only["edited_sha256"] == hashlib.sha256(b"abcdefab").hexdigest() and only["near_next"] == 1
    assert P.with_edited(documents([])).count() == 0
    assert P.fingerprints(documents(["x", "x"])).select("fingerprint").distinct().count() == 1
