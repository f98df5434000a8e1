"""Seasons of service against a walk over random careers, one player at a time."""

import datetime as dt
import random

import pytest

from fieldglass.operators import service_years as Y

SEASON, TODAY = "2019-20", dt.date(2019, 12, 1)
BOUNDS = {f"{y}-{(y + 1) % 100:02d}": (dt.date(y, 10, 20), dt.date(y + 1, 6, 10)) for y in range(2009, 2020) if y != 2011}
NAMES = {y[:4]: y for y in BOUNDS} | {"2011": "2011-12"}


def year_of(day):
    y = day.year - (day.month < 7)
    return f"{y}-{(y + 1) % 100:02d}"


def career(days, spells, teams, counted_two_way):
    """(season rows, assessment) of one player in plain steps."""
    spells = list(spells)
    for team in teams:
        if not [1 for kind, t, _, end in spells if kind == "two_way" and t == team and end is None]:
            spells.append(("two_way", team, BOUNDS[SEASON][0], None))
    rows = {}
    for s, (first, last) in sorted(BOUNDS.items()):
        alive = [x for x in spells if x[2] <= last and (x[3] is None or x[3] >= first)]
        if s not in {d[0] for d in days} | {year_of(x[2]) for x in spells if x[2] >= dt.date(2015, 7, 1)}:
            continue
        standard, other, with_ = 0, 0, set()
        for season, team, day in days:
            if season == s:
                code = Y.TEAMS.get(team, team)
                if [1 for kind, t, a, b in alive if kind == "two_way" and t == code and a <= day and (b is None or b >= day)]:
                    other += 1
                    with_.add(code)
                else:
                    standard += 1
        with_ |= {t for kind, t, a, _ in alive if kind == "two_way" and (year_of(a) == s or s == SEASON and t in teams)}
        signed = [1 for kind, _, a, _ in alive if kind == "standard" and year_of(a) == s]
        how = "games" if standard else "contract" if signed else "two-way" if counted_two_way and (other or with_) else None
        rows[s] = standard, other, sorted(with_), how
    past = {s: r for s, r in rows.items() if s < SEASON}
    counted = sorted(s for s, r in past.items() if r[3])
    yos = len(counted)
    idle = yos == 4 and any(r[3] == "contract" and r[1] == 0 for r in past.values())
    per_team = [t for r in rows.values() for t in r[2]]
    notes = []
    if counted and yos <= 5 and counted[0] < "2015-16":
        notes.append(Y.BEFORE_RECORDS)
    if counted and yos <= 5:
        lost = [NAMES[str(y)] for y in range(int(counted[0][:4]), int(counted[-1][:4])) if NAMES[str(y)] not in counted]
        notes += [Y.BETWEEN + ", ".join(lost)] if lost else []
    confidence = "medium" if notes else "high"
    notes += [Y.NO_GAMES] if idle else []
    notes += [Y.TWO_WAY_ONLY] if not counted_two_way and any(r[2] and not r[3] for r in past.values()) else []
    status, most = ("eligible", 2) if yos <= 2 else ("one_year", 1) if yos == 3 else ("exception", 1) if idle else ("ineligible", 0)
    now = bool(rows.get(SEASON, (0, 0, [], None))[3])
    return rows, (yos, yos + now, sum(bool(r[2]) for r in rows.values()), sorted({t for t in per_team if per_team.count(t) >= 3}), status, most, idle, confidence, notes)


def made(seed):
    rng = random.Random(seed)
    day = lambda: dt.date(rng.randint(2013, 2019), rng.randint(1, 12), rng.randint(1, 28))
    team = lambda: rng.choice(["BKN", "PHX", "DAL"])
    spells = []
    for _ in range(rng.randint(0, 5)):
        a = day()
        spells.append((rng.choice(["standard", "two_way"]), team(), a, rng.choice([None, a + dt.timedelta(rng.randint(0, 700))])))
    days = []
    for s in rng.sample(sorted(BOUNDS), rng.randint(0, 6)):
        for _ in range(rng.randint(1, 3)):
            days.append((s, rng.choice(["BRK", "BKN", "PHO", "DAL"]), BOUNDS[s][0] + dt.timedelta(rng.randint(-5, 200))))
    if rng.random() < 0.2:
        days.append(("2011-12", "DAL", dt.date(2011, 12, 30)))  # a season without bounds
    return days, spells, {team()} if rng.random() < 0.3 else set()


@pytest.mark.parametrize("two_way_counts", [False, True])
def test_same_as_a_walk_over_each_career(spark, two_way_counts):
    careers = {f"p{k}": made(k) for k in range(300)}
    days = spark.createDataFrame([(p, *d) for p, (x, _, _) in careers.items() for d in x], "player string, season string, team string, day date")
    spells = spark.createDataFrame([(p, *s) for p, (_, x, _) in careers.items() for s in x], "player string, type string, team string, start date, end date")
    listed = spark.createDataFrame([(p, t) for p, (_, _, x) in careers.items() for t in x], "player string, team string")
    bounds = spark.createDataFrame([(s, *b) for s, b in BOUNDS.items()], "season string, first date, last date")
    rows, told = Y.service(days, spells, listed, bounds, SEASON, TODAY, two_way_counts)
    want = {p: career(*c, two_way_counts) for p, c in careers.items() if any(c)}
    got = {(r["player"], r["season"]): (r["std_games"], r["tw_games"], r["tw_teams"], r["how"]) for r in rows.collect()}
    assert got == {(p, s): r for p, (x, _) in want.items() for s, r in x.items()}
    got = {r["player"]: tuple(r)[1:] for r in told.select("player", "yos", "yos_next", "tw_seasons", "blocked", "status", "max_years", "exception", "confidence", "notes").collect()}
    assert got == {p: a for p, (_, a) in want.items()}
    assert {a[4] for _, a in want.values()} >= {"eligible", "one_year", "ineligible"} and any(a[3] for _, a in want.values())


def test_an_exception_and_a_closed_team(spark):
    d = dt.date
    spells = [("x", "standard", "DAL", d(y, 8, 1), d(y + 1, 6, 1)) for y in (2015, 2016, 2017, 2018)] + [("y", "two_way", "DAL", d(y, 8, 1), d(y + 1, 6, 1)) for y in (2016, 2017, 2018)]
    rows, told = Y.service(
        spark.createDataFrame([("x", s, "DAL", BOUNDS[s][0]) for s in ("2015-16", "2016-17", "2017-18")], "player string, season string, team string, day date"),
        spark.createDataFrame(spells, "player string, type string, team string, start date, end date"), spark.createDataFrame([], "player string, team string"),
        spark.createDataFrame([(s, *b) for s, b in BOUNDS.items()], "season string, first date, last date"), SEASON, TODAY)
    got = {r["player"]: r for r in told.collect()}
    assert (got["x"]["yos"], got["x"]["status"], got["x"]["notes"], got["x"]["confidence"]) == (4, "exception", [Y.NO_GAMES], "high")
    assert (got["y"]["yos"], got["y"]["blocked"], got["y"]["tw_seasons"], got["y"]["notes"]) == (0, ["DAL"], 3, [Y.TWO_WAY_ONLY])
