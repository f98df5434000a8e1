"""The ledger of active games, against rules worked out by hand and by brute force."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from fieldglass.operators import quota as Q

FIRST = date(2024, 10, 20)
LISTED = "season int, player long, team string, first_seen date, first_list date"
SIGNED = "season int, player long, day date, team string, source string, rank int"
ACTIVE = "season int, player long, team string, game long, day date, active boolean, played boolean, seconds long"
SCHEDULE = "season int, game long, day date, home string, away string, final boolean"


def day(n):
    return FIRST + timedelta(days=n)


def test_prorated(spark):
    # 100 days: the quota of 50 shrinks by a half each day, and halves go to the even number.
    df = spark.createDataFrame([(k, None if k is None else day(k), day(0), day(99)) for k in (None, -3, 0, 1, 2, 3, 50, 99, 100)], "k int, s date, f date, l date")
    got = {r["k"]: r["q"] for r in df.select("k", Q.prorated(50, F.col("s"), F.col("f"), F.col("l")).alias("q")).collect()}
    assert got == {None: 50, -3: 50, 0: 50, 1: 50, 2: 49, 3: 48, 50: 25, 99: 0, 100: 0}


def brute(listed, signings, active, schedule, quota, recent):
    out = []
    for season, player, team, seen, first_list in listed:
        days = [d for s, _, d, *_ in schedule if s == season]
        first, last = (min(days), max(days)) if days else (None, None)
        mine = [x for x in signings if x[0] == season and x[1] == player and player is not None and x[2]]
        top = min((x[5] for x in mine), default=None)
        pick = max(((x[2], x[3], x[4]) for x in mine if x[5] == top), default=None)
        if pick and (team is None or pick[1] == team):
            signed, source = pick[0], pick[2]
        elif seen and first_list and first and seen > first_list and seen > first:
            signed, source = seen, "list"
        else:
            signed, source = None, "none"
        if not signed or not first or signed <= first:
            limit = quota
        else:
            limit = 0 if signed > last else round(quota * ((last - signed).days + 1) / ((last - first).days + 1))
        games = sorted((d, g, f) for s, g, d, h, a, f in schedule if s == season and team is not None and team in (h, a))
        ahead = [(d, g) for d, g, f in games if not f]
        late = {g for d, g, f in [x for x in games if x[2]][-recent:]}
        if player is None or team is None:
            out.append((season, player, team, signed, source, limit, None, None, len(ahead), None, None, False, None, None, None, None))
            continue
        own = [x for x in active if x[:3] == (season, player, team)]
        used = sum(bool(x[5]) and x[4] >= (signed or first or date(1900, 1, 1)) for x in own)
        left = max(0, limit - used)
        at = ahead[left - 1] if 0 < left <= len(ahead) else (None, None)
        r = [x for x in own if x[3] in late]
        out.append((season, player, team, signed, source, limit, used, left, len(ahead), at[1], at[0], left <= len(ahead), len(late), sum(bool(x[5]) for x in r), sum(bool(x[6]) for x in r), sum(x[7] or 0 for x in r)))
    return out


def test_tracker_against_brute_force(spark):
    rng = random.Random(11)
    teams = ["A", "B", "C"]
    schedule, listed, signings, active = [], [], [], []
    for season in (1, 2):
        for game in range(60):
            home, away = rng.sample(teams, 2)
            schedule.append((season, 100 * season + game, day(game // 2), home, away, rng.choice([True, None, False]) if game > 25 else True))
        for player in range(12):
            listed.append((season, player, rng.choice(teams), day(rng.choice([-5, 0, 4, 9])), day(-5)))
            signings += [(season, player, rng.choice([day(rng.randrange(-3, 34)), None]), rng.choice(teams), rng.choice("xy"), rng.randrange(2)) for _ in range(rng.randrange(4))]
            for s, game, d, home, away, _ in schedule:
                if s == season and rng.random() < 0.6:
                    active.append((s, player, rng.choice([home, away]), game, d, rng.choice([True, True, False, None]), rng.choice([True, False]), rng.choice([None, 60, 300])))
        listed += [(season, None, "A", day(4), day(-5)), (season, 3, None, day(0), day(-5)), (season, 99, "D", None, None)]
    listed += [(3, 1, "A", day(4), day(-5)), listed[0]]
    got = Q.tracker(*(spark.createDataFrame(r, s) for r, s in ((listed, LISTED), (signings, SIGNED), (active, ACTIVE), (schedule, SCHEDULE))), 20, 5)
    got = sorted((tuple(r) for r in got.drop("first_seen", "first_list").collect()), key=repr)
    want = sorted(brute(listed, signings, active, schedule, 20, 5), key=repr)
    assert got == want
    assert {w[4] for w in want} >= {"x", "y", "list", "none"} and any(w[10] for w in want)


def test_empty_tables(spark):
    got = Q.tracker(*(spark.createDataFrame([], s) for s in (LISTED, SIGNED, ACTIVE, SCHEDULE)))
    assert got.count() == 0
