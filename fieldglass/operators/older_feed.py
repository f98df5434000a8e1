"""Stints of the older feed, in which a substitution names the player who comes in only by surname.

What is known is a set of readings.  A reading of a side's period is the five that began it and a choice for each incoming
name, such that whoever goes out, or acts, is on the floor then, and whoever comes in isn't.  The first period begins with
the box's starters; a later one with the five that closed the one before, if that has a reading, as the feed doesn't tell
what happens between periods; else with any five of the roster.  A period with one reading gives stints; one with none, or
with several, makes the game fail: it gives a row that says so and no stints.

Any five aren't tried one by one: of each player it is known whether he began on the floor as soon as something happens to
him, and players of whom nothing is told are alike.  Readings that agree in what they know of everyone are carried as one
that was reached in several ways.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.functions.text import SUFFIX_RANK, fold_accents
from fieldglass.operators.folds import folded

STINT = "game_id string, period int, start_secs double, end_secs double, start_action long, end_action long, home_ids array<long>, away_ids array<long>, problem string"
# Teams whose abbreviation differs between the feed and the games.
FEED_TEAMS = {"BKN": "BRK", "CHA": "CHO", "PHX": "PHO", "NJN": "BRK", "NOH": "NOP", "SEA": "OKC", "VAN": "MEM"}
SIDES = ("home", "away")
#: A state of knowledge: of each player (was on at the start, is on now), None where nothing has told yet.
Known = tuple[tuple[bool | None, bool | None], ...]
UNTOLD = (None, None)


def team_of(x: Column) -> Column:
    """The games' abbreviation of a team of the feed."""
    return F.coalesce(F.create_map(*(F.lit(v) for pair in FEED_TEAMS.items() for v in pair))[x], x)


def feed_name(x: Column) -> Column:
    """A name as names are compared: lower-case, without accents, points and apostrophes, hyphens as spaces."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(fold_accents(x)), "[.'’]", ""), "-", " ")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def incoming_name(text: Column) -> Column:
    """Who comes in by "SUB: X FOR Y", as names are compared; empty if the text isn't one."""
    return F.coalesce(feed_name(F.regexp_extract(text, r"(?i)SUB:\s*(.+?)\s+FOR\s+(.+?)\s*$", 1)), F.lit(""))


def tiers(text: str, names: list[str]) -> list[set[int]]:
    """Players who go by a name, by place: those whose names end with it, those whose names end with it less its suffix, and
    those whose names hold its last word.  The first of these that has a player off the floor is meant."""
    if not text:
        return []
    words = text.split()
    base = " ".join(w for w in words if w not in SUFFIX_RANK)
    of = lambda part, test: {k for k, n in enumerate(names) if part and test(n, part)}
    return [of(text, str.endswith), of(base, str.endswith), of(words[-1], str.__contains__)]


def _told(known: Known, who: int, on: bool) -> Known | None:
    """known, with a player on the floor or off it just now; None if that can't be."""
    start, now = known[who]
    if now is not None:
        return known if now == on else None
    return (*known[:who], (on, on), *known[who + 1 :])


def _turned(known: Known, who: int, on: bool) -> Known:
    return (*known[:who], (known[who][0], on), *known[who + 1 :])


def _possible(known: Known) -> bool:
    on = sum(start is True for start, _ in known)
    return on <= 5 <= on + sum(start is None for start, _ in known)


def _brought_in(known: Known, names: list[set[int]]) -> Iterator[tuple[Known, int]]:
    """Every way in which a name can come in: the first tier with a player off the floor has him, so everyone of the tiers
    before is on the floor."""
    for tier in names:
        for who in sorted(tier):
            if (out := _told(known, who, False)) is not None:
                yield _turned(out, who, True), who
        known = reduce(lambda k, who: k and _told(k, who, True), sorted(tier), known)
        if known is None:
            return


def readings(events: list[tuple], five: set[int] | None, n: int) -> tuple[int, tuple | None]:
    """(how many readings, the one if it is the only one) of a side's period; counts beyond one are 2.  events: ("act", who)
    or ("sub", out, tiers), players by place, out None if unknown; five: who began, or None for any of n.  A reading is
    (who began, who came in at each substitution)."""
    begin = tuple((k in five,) * 2 if five is not None else UNTOLD for k in range(n))
    states: dict[Known, tuple[int, tuple]] = {begin: (1, ())} if _possible(begin) else {}
    for event in events:
        after: dict[Known, tuple[int, tuple]] = {}
        for known, (ways, path) in states.items():
            who = event[1]
            on = _told(known, who, True) if who is not None else None
            if on is None:
                continue
            if event[0] == "act":
                nexts = [(on, path)]
            else:
                nexts = [(_turned(k, who, False), (*path, came)) for k, came in _brought_in(on, event[2]) if came != who]
            for k, way in nexts:
                if _possible(k):
                    had = after.get(k, (0, way))
                    after[k] = min(2, had[0] + ways), had[1]
        states = after
    count, only = 0, None
    for known, (ways, path) in states.items():
        on = {k for k, (start, _) in enumerate(known) if start}
        rest = [k for k, (start, _) in enumerate(known) if start is None]
        lacks = 5 - len(on)
        count += ways * comb(len(rest), lacks)
        only = on | (set(rest) if lacks else set()), path
    return min(count, 2), only if count == 1 else None


def _length(period: int) -> float:
    return 720.0 if period <= 4 else 300.0


class _Side:
    """One side's players, and its floor in a period once that is read."""

    def __init__(self, box: list) -> None:
        box = sorted(box, key=lambda p: p["person"])
        self.ids, self.names = [p["person"] for p in box], [p["name"] or "" for p in box]
        self.at = {p: k for k, p in enumerate(self.ids)}
        self.five: set[int] | None = {k for k, p in enumerate(box) if p["starter"]}
        self.came: Iterator[int] = iter(())

    def read(self, events: list[dict], first: bool) -> str | None:
        """Sets the floor at the period's start and who comes in; what is wrong, if anything is."""
        if first and len(self.five) != 5:
            return f"started with {len(self.five)}"
        told = [("sub", self.at.get(e["person"]), tiers(e["incoming"], self.names)) if e["sub"] else ("act", self.at[e["person"]]) for e in events if e["sub"] or e["person"] in self.at]
        count, only = readings(told, self.five, len(self.ids)) if self.five is not None else (0, None)
        if not count and not first:
            count, only = readings(told, None, len(self.ids))
        if only is None:
            self.five = None
            return "several fives" if count else "no five"
        self.five, self.came = set(only[0]), iter(only[1])
        return None

    def substitute(self, out) -> None:
        self.five = self.five - {self.at[out]} | {next(self.came)}

    def on(self) -> list:
        return sorted(self.ids[k] for k in self.five)


def walked(game_id: str, events: list[dict], box: list[dict]) -> list[dict]:
    """Stints of one game, or its problems."""
    sides = {s: _Side([p for p in box if p["team"] == s]) for s in SIDES}
    out, problems = [], []
    period = None
    for at, e in enumerate(events):
        if e["period"] != period:
            first = period is None
            if not first:
                out += _stint(game_id, period, start, 0.0, action, e["action_id"], floor)
            period = e["period"]
            own = [x for x in events if x["period"] == period]
            for name, side in sides.items():
                problem = side.read([x for x in own if x["team"] == name], first)
                problems += [{"game_id": game_id, "period": period, "problem": f"{name}: {problem}"}] if problem else []
            start, action = _length(period), e["action_id"]
            floor = sides if all(s.five is not None for s in sides.values()) else None
        if e["sub"] and e["team"] in sides and floor:
            out += _stint(game_id, period, start, e["secs"], action, e["action_id"], floor)
            sides[e["team"]].substitute(e["person"])
            start, action = e["secs"], e["action_id"]
    out += _stint(game_id, period, start, 0.0, action, events[-1]["action_id"], floor)
    return problems or out


def _stint(game_id, period, start, end, action, end_action, floor) -> list[dict]:
    if not floor or start is None or end is not None and end >= start:
        return []  # no time passed, or the clock ran backwards
    return [{"game_id": game_id, "period": period, "start_secs": start, "end_secs": end, "start_action": action, "end_action": end_action, **{f"{s}_ids": floor[s].on() for s in SIDES}}]


def _game(rows: list) -> list[dict]:
    box, events = [r.box for r in rows if r.box], [r.event for r in rows if r.event]
    return walked(rows[0].game_id, events, box) if box and events else []


def older_stints(events: DataFrame, box: DataFrame) -> DataFrame:
    """Stints of the games of the older feed, and for a game that can't be read a row for each period and side with a
    problem instead.

    events: game_id, action_id, period, secs, sub (a substitution, else an action that takes being on the floor), team (home
    or away), person (who goes out, or acts) and text.  box: game_id, person, team, starter and name."""
    own = events.select("game_id", "action_id", F.struct("action_id", "period", "secs", F.coalesce("sub", F.lit(False)).alias("sub"), "team", "person", incoming_name(F.col("text")).alias("incoming")).alias("event"))
    lines = box.select("game_id", F.struct("person", "team", F.coalesce("starter", F.lit(False)).alias("starter"), feed_name(F.col("name")).alias("name")).alias("box"))
    return folded(own.unionByName(lines, allowMissingColumns=True), "game_id", ["action_id"], _game, STINT)


def minutes(stints_: DataFrame) -> DataFrame:
    """(game_id, person, seconds) that the stints give each player."""
    seconds = F.col("start_secs") - F.col("end_secs")
    each = stints_.where("problem IS NULL").select("game_id", seconds.alias("seconds"), F.explode(F.concat("home_ids", "away_ids")).alias("person"))
    return each.groupBy("game_id", "person").agg(F.sum("seconds").alias("seconds"))
