"""Names matched and linked without guessing, and measures of players' stints, on small tables."""

import random
from collections import defaultdict

import pytest

from fieldglass.operators import identity as I
from fieldglass.operators import lineup_measures as L


def test_namesakes_are_told_apart_by_who_is_playing(spark):
    names = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3), ("c", 4), ("c", 5), ("d", 6), ("d", 7), ("", 8), (None, 9), ("e", None)], "key string, player long")
    playing = spark.createDataFrame([(3,), (4,), (5,), (5,), (None,)], "player long")
    mentions = spark.createDataFrame([(k, n) for k, n in enumerate(["a", "b", "c", "d", "e", "", None, "x", "a"])], "id int, name string")
    got = {r["id"]: r["player"] for r in I.match_names(mentions, "name", names, playing).collect()}
    assert got == {0: 1, 1: 3, 2: None, 3: None, 4: None, 5: None, 6: None, 7: None, 8: 1}
    assert I.match_names(mentions, "name", names.limit(0), playing.limit(0)).where("player IS NOT NULL").count() == 0


def test_staged_links_and_the_rosters_veto(spark):
    staged = spark.createDataFrame(
        [("s1", "a", "X", 2), ("s1", "a", None, None), ("s2", "b", "X", 1), ("s3", "b", None, 1), ("s4", "c", "X", 1), ("s5", "d", "X", 1), ("s6", "e", "X", 1), ("s7", None, "X", 1), ("s8", "f", "Y", 1)],
        "source_id string, key string, team string, occurrences long",
    )
    names = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("c", 4), ("d", 5), ("e", 6), ("e", 7), ("f", 8)], "key string, player long")
    linked = spark.createDataFrame([("s5", 5), ("old", 7)], "source_id string, player long")
    roster = spark.createDataFrame([(1, "X", 2), (2, "X", 1), (2, "Y", 2), (8, "X", 1)], "player long, team string, day int")
    got = {r["source_id"]: (r["decision"], r["player"], r["why"], r["candidates"], r["occurrences"]) for r in I.staged_links(staged, names, linked, roster).collect()}
    assert got == {
        "s1": ("link", 1, "roster", 1, 3), "s2": ("review", 2, "other_team", 1, 1), "s3": ("link", 2, "roster", 1, 1), "s4": ("review", None, "namesakes", 2, 1),
        "s5": ("link", 5, "linked", 0, 1), "s6": ("link", 6, "no_roster", 1, 1), "s7": ("review", None, "unknown", 0, 1), "s8": ("link", 8, "no_roster", 1, 1),
    }


STINTS = "season int, home string, away string, home_ids array<int>, away_ids array<int>, seconds long, home_pts long, away_pts long, home_poss long, away_poss long, reliable boolean"


def test_measures_against_stint_by_stint(spark):
    rng = random.Random(4)
    people = {k: (rng.choice([None, k // 2, k // 2, k // 2]), rng.choice([None, 0, 78, 80, 82, 84, 84]) if k > 6 else 80, rng.choice(["C", "G", None]) if k > 6 else "F") for k in range(24)}
    stints = []
    for _ in range(400):
        pool = rng.sample(range(26), 10) if rng.random() < 0.5 else rng.sample(range(10), 10)
        stints.append((rng.randrange(2), *rng.sample("AB", 2), pool[:5], pool[5:], rng.randrange(200), *(rng.randrange(4) for _ in range(4)), rng.choice([True, True, False, None])))
    sums, whole, lost = defaultdict(lambda: [0] * 9), defaultdict(lambda: [0] * 5), defaultdict(int)
    for season, h, a, hf, af, sec, hp, ap, hq, aq, reliable in stints:
        for team, five, did in ((h, hf, (sec, hp, ap, hq, aq)), (a, af, (sec, ap, hp, aq, hq))) if reliable else ():
            whole[season, team] = [x + y for x, y in zip(whole[season, team], did)]
            tall = [people.get(p, (None, None, None))[1] for p in five]
            own = [people.get(p, (None, None, None))[0] for p in five]
            for k, p in enumerate(five):
                if own[k] is None:
                    lost[p] += sec
                    continue
                others = [people[q][2] for q, o in zip(five, own) if o is not None and o != own[k]]
                placed, measured = len(others) == 4 and None not in others, all(tall)
                more = (sec * placed, sec * (placed and "C" in others), sec * measured, sec * (measured and tall[k] == max(tall)))
                r = sums[season, team, own[k]]
                r[:] = [x + y for x, y in zip(r, did + more)]
    got = L.player_measures(*(spark.createDataFrame(r, s) for r, s in ((stints, STINTS), ([(k, *v) for k, v in people.items()], "person int, player long, height long, position string")))).collect()
    assert len(got) == len(sums)
    near = lambda x: None if x is None else pytest.approx(x)
    for g in got:
        r, t = sums[g["season"], g["team"], g["player"]], whole[g["season"], g["team"]]
        assert [g[c] for c in L.SUMS] == r[:5]
        sec, pf, pa, qf, qa, placed, centre, measured, tallest = r
        off = [x - y for x, y in zip(t, r)]
        on = 100 * pf / qf - 100 * pa / qa if qf and qa else None
        out = 100 * off[1] / off[3] - 100 * off[2] / off[4] if off[3] > 20 and off[4] > 20 else None
        assert (g["on_net"], g["off_net"]) == (near(on), near(out))
        assert g["on_off"] == near(None if on is None or out is None else on - out)
        assert (g["with_centre"], g["tallest"]) == (near(centre / placed if placed else None), near(tallest / measured if measured else None))
        assert (g["position_coverage"], g["height_coverage"]) == (near(placed / sec if sec else None), near(measured / sec if sec else None))
    assert any(g["with_centre"] for g in got) and any(g["tallest"] for g in got)
    ppl = spark.createDataFrame([(k, *v) for k, v in people.items()], "person int, player long, height long, position string")
    assert {r["person"]: r["seconds"] for r in L.unresolved(spark.createDataFrame(stints, STINTS), ppl).collect()} == dict(lost)
    assert L.player_measures(spark.createDataFrame([], STINTS), ppl).count() == 0
