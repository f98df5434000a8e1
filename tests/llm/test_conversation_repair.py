import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from fieldglass.llm import conversation_repair as R

SCHEMA = "conv_id long, turn long, role string, text string"
SPACES = " \t\n\x0b\x0c\r"


def damaged(rows):
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(":".join(" " if x is None else str(x) for x in (conv, turn)).encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        yield from [(conv, turn, "user" if code == 4 else role, text)] * (0 if code == 0 else 2 if code == 3 else 1)


def least(rows, faults):
    """(cost, audit, turns) by a table over all rows and role sequences so far, no agenda."""
    best = {"": (0, "", [])}

    def offer(to, initials, cost, audit, turns):
        if re.fullmatch("s?(ua)*u?", initials):
            short = initials.replace("uaua", "ua")
            if short not in to or (cost, audit) < to[short][:2]:
                to[short] = cost, audit, turns

    def inserted(states):
        while True:
            new = dict(states)
            for initials, (cost, audit, turns) in states.items():
                for role in ("user", "assistant"):
                    offer(new, initials + role[0], cost + 3, audit + "I", [*turns, (role, "")])
            if new == states:
                return new
            states = new

    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for initials, (cost, audit, turns) in inserted(best).items():
            offer(after, initials, cost + 4, audit + "D", turns)
            if fault not in ("blank", "duplicate"):
                extra = 3 * (fault == "truncated")
                if role[:1] in ("s", "u", "a"):
                    offer(after, initials + role[0], cost + extra, audit + "K", [*turns, (role, text)])
                for other in ("user", "assistant"):
                    offer(after, initials + other[0], cost + 3 + extra, audit + "R", [*turns, (other, text)])
        best = after
    return min(v for k, v in inserted(best).items() if re.fullmatch("(s?(ua)+)?", k))


def brute(rows):
    order = lambda r: (r[1] is not None, r[1], r[2], hashlib.md5(f"{r[2]}\0{r[3]}".encode()).digest())
    after = list(damaged(rows))
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in after if r[0] == conv), key=order)
        faults = []
        for k, (_, _, role, text) in enumerate(own):
            end = text.rstrip(SPACES)
            again = any(r[2:] == (role, text) for r in own[:k])
            faults.append("blank" if not end else "duplicate" if again else "" if end[-1] in ".!?" else "truncated")
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(own))
        cost, audit, turns = least(own, faults)
        text = "\n".join(":".join(t) for t in turns)
        yield conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def made(n, seed, turns=12):
    rng = random.Random(seed)
    for conv in range(n):
        for turn in range(rng.randint(0, turns)):
            role = rng.choice(["user", "assistant"] * 4 + ["system", "tool", "User", None, ""])
            text = rng.choice(["a.", "b!", "so it ends", "c? \n\t", " ", "", None, "\u00a0", f"own {turn}.", f"own {turn}", "x" * 30 + "\n."])
            yield conv if conv % 40 else None, rng.choice([turn, turn, turn, None, turn + 2]), role, text


def got(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    df = df.withColumns({"same": F.lit("clash"), "kind": F.lit(1), "gone": F.lit(True), "a.b": F.lit(0)})
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted(map(tuple, R.digests(R.damaged(df)).select(*names).collect()), key=repr)


@pytest.mark.parametrize("long_rows, long_bytes", [(1024, 1 << 24), (3, 1 << 24), (1024, 60), (1, 0)])
def test_same_as_a_table_over_all_sequences(spark, monkeypatch, long_rows, long_bytes):
    """With every conversation whole, cut into pieces of three rows, and cut by its bytes."""
    monkeypatch.setattr(R, "LONG_ROWS", long_rows)
    monkeypatch.setattr(R, "LONG_BYTES", long_bytes)
    rows = list(made(160, 5)) + [(900, t, "user", "dropped") for t in range(4000) if zlib.crc32(f"900:{t}".encode()) % 20 == 0]
    rows += [(901, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(40)] + [(902, 3, "user", "again.")] * 9 + [(903, None, None, None)] * 3
    random.Random(1).shuffle(rows)
    assert got(spark, rows) == sorted(brute(rows), key=repr)


def test_long_texts_and_far_turns(spark):
    rows = [(1, 0, "system", "s" * 2_000_000 + "."), (1, 5, "user", "u" * 3_000_000 + " " * 1_000_000), (1, 1 << 62, "assistant", "."), (2, -(1 << 62), "user", "?"), (2, 1 << 62, "assistant", "!")]
    assert got(spark, rows) == sorted(brute(rows), key=repr)


def test_no_rows(spark):
    assert got(spark, []) == []


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi!"), (1, 2, "user", "Hi!"), (1, 3, "tool", "Hello."), (1, 4, "user", "Bye."), (2, 0, "user", " ")]
    turns = R.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("conv_id", "n").collect()
    assert [tuple(t) for t in turns] == [(1, 1, "K", "system", "Be kind."), (1, 2, "K", "user", "Hi!"), (1, 3, "R", "assistant", "Hello."), (1, 4, "K", "user", "Bye."), (1, 5, "I", "assistant", "")]


def test_the_agenda_finalises_in_order_and_stops_at_the_goal():
    popped = []

    def deduce(item, cost, audit):
        popped.append((cost, audit))
        if item < (9,):
            yield cost + 2, audit + "b", (item[0] + 1,)
            yield cost + 1, audit + "a", (item[0] + 1,)

    final = R.lightest([(0, "", (0,))], deduce, (4,))
    assert final[4,] == (4, "aaaa") and (5,) not in final and popped == sorted(popped)
