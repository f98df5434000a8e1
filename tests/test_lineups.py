"""Who is on the floor: choices among several incoming players, and the older feed's readings, against brute force."""

import itertools
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from fieldglass.operators import games, older_feed

# ------------------------------------------------------------------ several incoming players


def searched(actions, at, off):
    """The rule in plain words: look ahead from the substitution, action by action."""
    for a in actions[at + 1 :]:
        if a.kind == "substitution":
            if a.sub_kind == "out" and a.person in off:
                return a.person
            if a.sub_kind == "in" and a.candidates and set(a.candidates) == set(off):
                return None
            continue
        hit = [p for p in games.actors(a) if p in off]
        if hit:
            return hit[0]
    return None


def test_one_backward_pass_finds_what_a_search_per_substitution_finds():
    rng = random.Random(4)
    checked = found = 0
    for _ in range(800):
        actions = []
        for _ in range(rng.randint(1, 14)):
            kind = rng.choice(["substitution", "substitution", "2pt", "foul", "timeout", "rebound"])
            several = rng.sample(range(1, 6), rng.randint(1, 3)) if kind == "substitution" and rng.random() < 0.6 else None
            sub = rng.choice(["in", "out"]) if kind == "substitution" else rng.choice([None, "technical"])
            several = several if sub == "in" else None
            actions.append(SimpleNamespace(kind=kind, sub_kind=sub, person=several[0] if several else rng.randint(1, 6), candidates=several, assist=rng.choice([None, None, 2, 3]), steal=None, block=None))
        ahead = games.coming_acts(actions)
        for at, a in enumerate(actions):
            if a.kind == "substitution" and a.candidates and len(a.candidates) > 1:
                for n in range(2, len(a.candidates) + 1):
                    for off in itertools.combinations(a.candidates, n):
                        floor = games._Floor([], [])
                        floor.on["home"] = set(a.candidates) - set(off)
                        floor.due = {99: 1.0}
                        want = searched(actions, at, off)
                        assert floor.incoming(a, "home", ahead[at]) == (off[0] if want is None else want)
                        checked, found = checked + 1, found + (want is not None)
    assert checked > 500 and found > 100


PLAY = "game_id string, order_number long, period int, seconds_left double, kind string, sub_kind string, person long, points int, possession string, assist long, team string, text string"
BOX = "game_id string, person long, team string, starter boolean, seconds double, team_points int"
PLAYERS = "game_id string, team string, person long, name string, first string, family string"


def play(order, left, kind, person, sub=None, text=None, assist=None, team="home", game="g"):
    return game, order, 1, left, kind, sub, person, 0, None, assist, team, text


def floors(spark, plays, seconds, people):
    """(stints of the home side, reasons) where 1 to 5 start, 6 to 8 sit, and 11 to 15 are away."""
    box = [("g", p, "home", p < 6, seconds.get(p, 720.0 if p < 6 else 0.0), None) for p in range(1, 9)] + [("g", p, "away", True, 720.0, None) for p in range(11, 16)]
    actions = spark.createDataFrame(plays, PLAY)
    if people:
        actions = games.with_incoming(actions, spark.createDataFrame([("g", "home", *p) for p in people], PLAYERS))
    got = games.stints(actions, spark.createDataFrame(box, BOX)).orderBy("start_s").collect()
    return [(r["start_s"], r["home_ids"]) for r in got], {r["reasons"] for r in got}


SMITHS = [(6, "J. Smith", "John", "Smith"), (7, "A. Smith", "Al", "Smith"), (8, "B. O'Néal Jr.", "Bo", "O'Néal Jr."), (1, "One", "X", "One"), (5, "Five", "X", "Five")]


@pytest.mark.parametrize("after, who", [([("2pt", 7, None)], 7), ([("2pt", 6, None)], 6), ([("2pt", 1, 7)], 7), ([("foul", 7, "technical"), ("2pt", 6, None)], 6), ([("substitution", 7, "out")], 7)])
def test_a_shared_surname_is_told_by_the_next_act(spark, after, who):
    plays = [play(1, 600.0, "substitution", 5, "out", "Five replaced by Smith")]
    for n, (kind, person, x) in enumerate(after, 2):
        plays.append(play(n, 500.0, kind, person, x if isinstance(x, str) else None, "One replaced by One" if kind == "substitution" else None, x if isinstance(x, int) else None))
    stints, _ = floors(spark, plays, {}, SMITHS)
    assert (120.0, sorted([1, 2, 3, 4, who])) in stints


def test_a_shared_surname_without_evidence_goes_by_minutes_to_come(spark):
    plays = [play(1, 600.0, "substitution", 5, "out", "Five replaced by Smith"), play(2, 400.0, "2pt", 1)]
    for seconds, who in (({6: 600.0, 7: 10.0}, 6), ({6: 10.0, 7: 600.0}, 7)):
        assert (120.0, [1, 2, 3, 4, who]) in floors(spark, plays, {5: 120.0} | seconds, SMITHS)[0]


def test_incoming_names(spark):
    for text, who in (("Five replaced by A. Smith", 7), ("Five replaced by john smith", 6), ("Five replaced by O'Neal", 8), ("Five replaced by Bo O'Neal Jr.", 8)):
        stints, reasons = floors(spark, [play(1, 600.0, "substitution", 5, "out", text)], {5: 120.0, who: 600.0}, SMITHS)
        assert stints[-1] == (120.0, sorted([1, 2, 3, 4, who])) and reasons == {""}, text
    stints, reasons = floors(spark, [play(1, 600.0, "substitution", 5, "out", "Five replaced by Nobody"), play(2, 500.0, "2pt", 1)], {}, SMITHS)
    assert "1 incoming names without a player" in next(iter(reasons)) and "not five a side at 1 actions" in next(iter(reasons))
    # A game whose substitutions have both rows is left as it is.
    both = [play(1, 600.0, "substitution", 5, "out", "Five replaced by Smith"), play(2, 600.0, "substitution", 8, "in")]
    assert floors(spark, both, {}, SMITHS)[0][-1] == (120.0, [1, 2, 3, 4, 8])
    twice = [play(1, 600.0, "substitution", 5, "out", "Five replaced by One")]
    assert floors(spark, twice, {}, [*SMITHS, (2, "T. One", "T", "One")])[1].pop().startswith("1 substitutions of players of one name")


def test_what_makes_stints_unreliable(spark):
    def reasons(*plays, seconds=None):
        return floors(spark, plays, seconds or {}, None)[1]

    assert reasons(play(1, 600.0, "2pt", 1, assist=6)) == {"1 actions off the floor"}
    assert reasons(play(1, 600.0, "violation", 6), play(2, 590.0, "foul", 6, "personal technical")) == {""}
    # Eight of ten in the box agree; those on the floor without minutes there count, too.
    assert reasons(play(1, 600.0, "2pt", 1), seconds={1: 0.0, 2: 0.0}) == {"minutes match 8/10"}
    assert reasons(play(1, 600.0, "substitution", 5, "out"), play(2, 600.0, "substitution", 6, "in"), seconds={5: 120.0, 6: 600.0}) == {""}


# ------------------------------------------------------------------ the older feed


def every(events, names, five):
    """All readings: every five, every choice."""
    fives = [set(five)] if five is not None else [set(x) for x in itertools.combinations(range(len(names)), 5)]
    out = []

    def go(on, rest, begun, path):
        if not rest:
            out.append((begun, path))
            return
        kind, who, *more = rest[0]
        if who not in on:
            return
        if kind == "act":
            go(on, rest[1:], begun, path)
            return
        tier = next((t for t in more[0] if t - on), set())
        for came in sorted(tier - on):
            go(on - {who} | {came}, rest[1:], begun, (*path, came))

    for f in fives:
        if len(f) == 5:
            go(f, events, frozenset(f), ())
    return out


NAMES = ["al smith", "jo smith", "ann lee", "bo lee jr", "cy day", "di smith-day", "ed poe"]


def test_readings_are_those_of_all_fives():
    rng = random.Random(9)
    seen = {0: 0, 1: 0, 2: 0}
    for case in range(1500):
        n = rng.randint(5, 7)
        names = NAMES[:n]
        on, events = set(rng.sample(range(n), 5)), []
        five = set(on) if case % 3 == 0 else None
        for _ in range(rng.randint(0, 6)):
            who = rng.choice(sorted(on) if rng.random() < 0.95 else range(n))
            if rng.random() < 0.4 or n == 5:
                events.append(("act", who))
                continue
            came = rng.choice(sorted(set(range(n)) - on) or [0])
            text = rng.choice([names[came], names[came].split()[-1], names[came].split()[1], "lee jr", "smith jr", "al"])
            events.append(("sub", who, older_feed.tiers(text, names)))
            on = on - {who} | {came}
        want = every(events, names, five)
        count, only = older_feed.readings(events, five, n)
        assert count == min(2, len(want)), (events, five)
        if len(want) == 1:
            assert (frozenset(only[0]), only[1]) == want[0]
        seen[count] += 1
    assert min(seen.values()) > 100


EVENT = "game_id string, action_id long, period int, secs double, sub boolean, team string, person long, text string"
ROSTER = "game_id string, person long, team string, starter boolean, name string"


def older(spark, events, starters=5):
    box = [("g", p, "home", p <= starters, name) for p, name in enumerate(["A. One", "B. Two", "C. Three", "D. Four", "E. Five", "F. Smith", "G. Smith", "H. Šmid Jr."], 1)]
    box += [("g", p, "away", True, f"Away {p}") for p in range(11, 16)]
    got = older_feed.older_stints(spark.createDataFrame([("g", k, *e) for k, e in enumerate(events)], EVENT), spark.createDataFrame(box, ROSTER))
    return [tuple(r)[1:] for r in got.orderBy("period", F.col("start_secs").desc()).collect()]


def sub(secs, out, text, period=1):
    return period, secs, True, "home", out, f"SUB: {text} FOR X"


def act(secs, who, period=1):
    return period, secs, False, "home", who, None


AWAY = [11, 12, 13, 14, 15]


def test_older_game(spark):
    got = older(spark, [sub(500.0, 5, "Smid"), act(400.0, 8), sub(300.0, 8, "Five"), act(700.0, 5, period=2)])
    assert got == [
        (1, 720.0, 500.0, 0, 0, [1, 2, 3, 4, 5], AWAY, None),
        (1, 500.0, 300.0, 0, 2, [1, 2, 3, 4, 8], AWAY, None),
        (1, 300.0, 0.0, 2, 3, [1, 2, 3, 4, 5], AWAY, None),
        (2, 720.0, 0.0, 3, 3, [1, 2, 3, 4, 5], AWAY, None),
    ]


def test_a_name_of_two_is_told_by_what_follows(spark):
    got = older(spark, [sub(500.0, 5, "Smith"), act(400.0, 7)])
    assert [r[5] for r in got] == [[1, 2, 3, 4, 5], [1, 2, 3, 4, 7]]
    assert [r[-1] for r in older(spark, [sub(500.0, 5, "Smith"), act(400.0, 1)])] == ["home: several fives"]
    assert [r[-1] for r in older(spark, [sub(500.0, 5, "Nobody")])] == ["home: no five"]
    assert [r[-1] for r in older(spark, [sub(500.0, 6, "Smith")])] == ["home: no five"]
    assert {r[-1] for r in older(spark, [act(500.0, 1)], starters=4)} == {"home: started with 4"}


def test_a_period_that_begins_with_another_five(spark):
    new = [act(600.0, p, period=2) for p in (1, 2, 3, 6)]
    got = older(spark, [act(500.0, 1), *new, sub(500.0, 7, "Five", period=2)])
    assert [(r[0], r[5]) for r in got] == [(1, [1, 2, 3, 4, 5]), (2, [1, 2, 3, 6, 7]), (2, [1, 2, 3, 5, 6])]
    assert [(r[0], r[-1]) for r in older(spark, [act(500.0, 1), *new])] == [(2, "home: several fives")]


def test_minutes_of_the_older_feed(spark):
    stints = spark.createDataFrame([("g", 1, 720.0, 500.0, 0, 1, [1], [2], None), ("g", 1, 500.0, 0.0, 1, 2, [3], [2], None), ("h", 1, None, None, None, None, None, None, "no five")], older_feed.STINT)
    assert sorted(map(tuple, older_feed.minutes(stints).collect())) == [("g", 1, 220.0), ("g", 2, 720.0), ("g", 3, 500.0)]
