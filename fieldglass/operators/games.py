"""Folds over ordered game events: possessions, stints.  One group is one game, some hundreds of events."""

from __future__ import annotations

import re
from collections import Counter
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from fieldglass.functions.shots import LIVE_TURNOVERS, is_clutch, is_garbage, score_state
from fieldglass.functions.text import SUFFIX_RANK, fold_accents
from fieldglass.operators.folds import folded

# Event types that open a possession, those that say nothing, those between a basket and its free throw, and
# the part of a free throw's kind that tells its place.
OPENERS = ("made shot", "missed shot", "turnover", "free throw", "rebound", "heave")
SILENT = ("period", "timeout", "instant replay")
PASSED_OVER = ("period", "timeout", "instant replay", "substitution", "foul", "jump ball", "ejection", "violation", "")
_PLACE = re.compile(r"(\d+)\s+of\s+(\d+)")
POSSESSION = "game_id string, period int, poss_num int, off_team string, start_action long, end_action long, start_secs double, end_secs double, points int, end_reason string, start_type string, orebs int, pts_first int, pts_after_oreb int"
_AFTER = {"made_fg": "after_score", "made_ft": "after_score", "def_rebound": "def_rebound"}


class Game:
    """One game's possessions, event by event; what it holds can be kept between events."""

    def __init__(self, game_id: str) -> None:
        self.game_id, self.rows = game_id, []
        self.period, self.number, self.now = None, 0, None
        self.shooter, self.start_type, self.live = None, "period_start", False
        self.last = None

    def open(self, e) -> None:
        self.number += 1
        self.now = {"game_id": self.game_id, "period": self.period, "poss_num": self.number, "off_team": e.team, "start_action": e.action_id, "end_action": e.action_id, "start_secs": e.secs, "end_secs": e.secs, "points": 0, "end_reason": None, "start_type": self.start_type, "orebs": 0, "pts_first": 0, "pts_after_oreb": 0}

    def score(self, n: int) -> None:
        self.now["points"] += n
        self.now["pts_after_oreb" if self.now["orebs"] else "pts_first"] += n

    def close(self, e, reason: str) -> None:
        if self.now:
            self.now |= {"end_action": e.action_id, "end_secs": e.secs, "end_reason": reason}
            self.rows.append(self.now)
            self.now = None
        live = "live_turnover" if self.live else "dead_turnover"
        self.start_type = _AFTER.get(reason, live if reason == "turnover" else "period_start")

    def event(self, e, following) -> None:
        """following: the next event that can go on with a possession or end it."""
        if e.period != self.period:
            self.close(e, "period_end")
            self.period, self.number, self.shooter = e.period, 0, None
        kind = (e.kind or "").lower()
        if kind in SILENT:
            return
        if not self.now and e.team and kind in OPENERS:
            self.open(e)
        ours = bool(self.now) and self.now["off_team"] == e.team
        if kind == "made shot":
            self.shooter = e.team
            if ours:
                self.score(int(e.value or 2))
                and_one = following is not None and following.kind.lower() == "free throw" and following.team == e.team
                if not and_one:
                    self.close(e, "made_fg")
        elif kind in ("missed shot", "heave"):
            self.shooter = e.team
        elif kind == "rebound":
            # Without a team, or without a miss, it only ends the wait for a rebound.
            if self.shooter and e.team == self.shooter:
                if ours:
                    self.now["orebs"] += 1
            elif self.shooter and e.team:
                self.close(e, "def_rebound")
                self.open(e)
            self.shooter = None
        elif kind == "turnover":
            self.live, self.shooter = e.sub_kind in LIVE_TURNOVERS, None
            if ours:
                self.close(e, "turnover")
        elif kind == "free throw":
            made = e.result.lower() == "made" if e.result else "MISS" not in (e.text or "").upper()
            if made and ours:
                self.score(1)
            part = (e.sub_kind or "").lower()
            place = _PLACE.search(part)
            if "technical" in part or place and place[1] == place[2]:
                self.shooter = None if made else e.team
                if made:
                    self.close(e, "made_ft")


    def fold(self, events: list, ended: bool) -> int:
        """Events in order; how many are done with.  A basket waits for the next event that could be its free throw, unless
        the game has ended."""
        following, ahead = [None] * len(events), None
        for k in range(len(events) - 1, -1, -1):
            following[k] = ahead
            if (events[k].kind or "").lower() not in PASSED_OVER:
                ahead = events[k]
        for k, (e, after) in enumerate(zip(events, following, strict=True)):
            if after is None and not ended and (e.kind or "").lower() == "made shot":
                return k
            self.event(e, after)
            self.last = SimpleNamespace(action_id=e.action_id, secs=e.secs)
        if ended and self.last:
            self.close(self.last, "period_end")
        return len(events)


def fold_game(events: list) -> list[dict]:
    """Possessions of one game's events (game_id, action_id, period, secs, kind, sub_kind, team, value, result, text)."""
    game = Game(events[0].game_id)
    game.fold(events, True)
    return game.rows


def possessions(events: DataFrame) -> DataFrame:
    """A row for each possession of every game; see fold_game."""
    own = events.select("game_id", "action_id", "period", "secs", "kind", "sub_kind", "team", "value", "result", "text")
    return folded(own, "game_id", ["action_id"], fold_game, POSSESSION)


def possession_context(poss: DataFrame, games: DataFrame) -> DataFrame:
    """poss with def_team, the margin of the offence before it, and what follows from that.

    games: game_id, home, away, season, season_type."""
    own = poss.join(games, "game_id").withColumn("def_team", F.when(F.col("off_team") == F.col("home"), F.col("away")).otherwise(F.col("home")))
    before = Window.partitionBy("game_id").orderBy("period", "poss_num").rowsBetween(Window.unboundedPreceding, -1)
    home_lead = F.sum(F.when(F.col("off_team") == F.col("home"), F.col("points")).otherwise(-F.col("points"))).over(before)
    lead = F.coalesce(home_lead, F.lit(0))
    margin = own.withColumn("margin", F.when(F.col("off_team") == F.col("home"), lead).otherwise(-lead))
    p, s, m = F.col("period"), F.col("start_secs"), F.col("margin")
    return margin.select("*", is_clutch(p, s, m).alias("clutch"), is_garbage(p, s, m).alias("garbage"), score_state(m).alias("score_state"))


def opponent_tiers(poss: DataFrame, n: int = 10) -> DataFrame:
    """(season, team, net, tier): points per 100 possessions for and against in regular games, ranked in tiers."""
    from fieldglass.operators.windows import tiers

    regular = poss.where("season_type = 'regular'")
    side = lambda team, p: regular.groupBy("season", F.col(team).alias("team")).agg((100.0 * F.sum("points") / F.count(F.lit(1))).alias(p))
    net = side("off_team", "scored").join(side("def_team", "allowed"), ["season", "team"]).select("season", "team", (F.col("scored") - F.col("allowed")).alias("net"))
    return tiers(net, ["season"], "net", "team", n)


def possession_values(poss: DataFrame, key: list[str]) -> DataFrame:
    """Points per possession by how it starts, and what turnovers and offensive rebounds are worth."""
    is_ = lambda *kinds: F.col("start_type").isin(*kinds)
    pts = lambda test: F.sum(F.when(test, F.col("points")))
    n = lambda test: F.count_if(test)
    usual, live, dead = is_("after_score", "def_rebound"), is_("live_turnover"), is_("dead_turnover")
    share = lambda test: F.avg(test.cast("double"))
    a = poss.groupBy(*key).agg(
        F.count(F.lit(1)).alias("n"), F.avg("points").alias("ppp"),
        *(x for name, t in (("usual", usual), ("live", live), ("dead", dead)) for x in (pts(t).alias(f"pts_{name}"), n(t).alias(f"n_{name}"))),
        F.sum("pts_after_oreb").alias("after"), F.sum("orebs").alias("orebs"), share(F.col("clutch")).alias("clutch_share"), share(F.col("garbage")).alias("garbage_share"),
    )
    rate = lambda k: F.col(f"pts_{k}") / F.nullif(F.col(f"n_{k}"), F.lit(0))
    worth = lambda k: F.col("ppp") + (rate(k) - rate("usual"))
    both = (F.col("n_live") > 0) & (F.col("n_dead") > 0)
    mean = (worth("live") * F.col("n_live") + worth("dead") * F.col("n_dead")) / F.nullif(F.col("n_live") + F.col("n_dead"), F.lit(0))
    return a.select(*key, "n", "ppp", rate("usual").alias("ppp_usual"), worth("live").alias("tov_value_live"), worth("dead").alias("tov_value_dead"), F.when(both, mean).alias("tov_value"), (F.col("after") / F.nullif(F.col("orebs"), F.lit(0))).alias("oreb_value"), "clutch_share", "garbage_share")


STINT = "game_id string, period int, start_s double, end_s double, seconds double, home_ids array<long>, away_ids array<long>, home_pts int, away_pts int, home_poss int, away_poss int, reliable boolean, reasons string"


BOX_TALLIES = ("fgm", "fga", "fg3m", "fg3a", "ftm", "fta", "orb", "drb", "tov", "ast", "stl", "blk")
CHECKED = ("fga", "fgm", "fg3a", "fta")


def with_tallies(actions: DataFrame) -> DataFrame:
    """actions with own and other: the names of ``BOX_TALLIES`` that each adds to its team's and to the other team's line.

    Takes kind (2pt, 3pt, freethrow, rebound, turnover), sub_kind, result, person, and assist, block and steal (who did it,
    or null).  Rebounds of no person aren't counted, turnovers of a team are."""
    kind, made = F.lower("kind"), F.coalesce(F.lower(F.regexp_replace("result", "^[ :]+|[ :]+$", "")) == "made", F.lit(False))
    shot, three, by = kind.isin("2pt", "3pt"), kind == "3pt", lambda c: F.coalesce(F.col(c) != 0, F.lit(False))
    rebound, sub = (kind == "rebound") & by("person"), F.lower("sub_kind")
    own = {
        "fgm": shot & made, "fga": shot, "fg3m": three & made, "fg3a": three, "ftm": (kind == "freethrow") & made, "fta": kind == "freethrow",
        "orb": rebound & (sub == "offensive"), "drb": rebound & (sub == "defensive"), "tov": kind == "turnover", "ast": shot & made & by("assist"),
    }
    other = {"stl": (kind == "turnover") & by("steal"), "blk": shot & ~made & by("block")}
    names = lambda tests: F.array_compact(F.array(*(F.when(test, name) for name, test in tests.items())))
    return actions.withColumns({"own": names(own), "other": names(other)})


def factors_match(stints_: DataFrame, team_box: DataFrame) -> DataFrame:
    """(game_id, factors_match): whether tries and baskets of either side in the stints are those of team_box (game_id, side,
    and ``CHECKED``; missing ones are 0).  Games without a team box aren't judged."""
    sides = F.inline(F.array(*(F.struct(F.lit(s).alias("side"), *(F.col(f"{s}_{c}").alias(f"_{c}") for c in CHECKED)) for s in ("home", "away"))))
    sums = stints_.select("game_id", sides).groupBy("game_id", "side").agg(*(F.sum(f"_{c}").alias(f"_{c}") for c in CHECKED))
    same = F.lit(True)
    for c in CHECKED:
        same = same & (F.coalesce(F.col(f"_{c}"), F.lit(0)) == F.coalesce(F.col(c), F.lit(0)))
    return team_box.join(sums, ["game_id", "side"], "left").groupBy("game_id").agg(F.bool_and(same).alias("factors_match"))


# Kinds of action that tell that a person is on the floor.
ACTING = ("2pt", "3pt", "freethrow", "rebound", "turnover", "steal", "block", "foul", "jumpball")
HELPERS = ("assist", "steal", "block")


def actors(a) -> list:
    """Who an action shows to be on the floor, whoever it belongs to first: a technical foul shows nobody."""
    own = [a.person] if a.kind in ACTING and a.person and not (a.kind == "foul" and "technical" in (a.sub_kind or "")) else []
    return own + [who for c in HELPERS if (who := getattr(a, c, None))]


def _candidates(a) -> list:
    """Who a substitution may bring in."""
    several = getattr(a, "candidates", None)
    return list(several) if several is not None else [a.person]


def coming_acts(actions: list) -> dict[int, tuple[dict, dict]]:
    """For each substitution of a period with several candidates, by its place: where each of them next acts or goes out,
    and where each set of candidates next comes in.  One pass from the end, which holds every person's next act."""
    out, acts, sets = {}, {}, {}
    for at in range(len(actions) - 1, -1, -1):
        a = actions[at]
        if a.kind != "substitution":
            for place, who in reversed(list(enumerate(actors(a)))):
                acts[who] = at, place
        elif a.sub_kind == "out":
            acts[a.person] = at, 0
        else:
            several = _candidates(a)
            if len(several) > 1:
                out[at] = {c: acts[c] for c in several if c in acts}, dict(sets)
            sets[frozenset(several)] = at
    return out


class _Floor:
    """Who is on the floor of one game, and the stints that follow from it."""

    def __init__(self, actions: list, box: list) -> None:
        self.actions, self.due = actions, {p.person: float(p.seconds or 0) for p in box}
        self.team = {p.person: p.team for p in box}
        self.starters = {s: [p.person for p in box if p.team == s and p.starter] for s in ("home", "away")}
        self.faults: Counter = Counter()
        self.played: Counter = Counter()
        self.stints: list[dict] = []
        self.on: dict[str, set] = {"home": set(), "away": set()}
        self.pts, self.poss = Counter(), Counter()
        self.line: Counter = Counter()

    def left(self, person) -> float:
        """Seconds in the box that aren't accounted for yet."""
        return self.due.get(person, 0.0) - self.played[person]

    def inferred(self, own: list) -> dict[str, set]:
        """The first five of each side to act, or to be taken out, before they are brought in; the rest from the last
        five, those with most minutes to come first."""
        seen: dict[str, list] = {"home": [], "away": []}
        late = set()
        for a in own:
            if a.kind == "substitution" and a.sub_kind == "in":
                late.add(a.person)
                continue
            for who in [a.person] if a.kind == "substitution" else actors(a):
                side = seen.get(self.team.get(who))
                if side is not None and who not in late and who not in side and len(side) < 5:
                    side.append(who)
        for side, five in seen.items():
            spare = sorted(self.on[side] - set(five) - late, key=lambda p: (-self.left(p), p))
            five += spare[: 5 - len(five)]
        return {side: set(five) for side, five in seen.items()}

    def cut(self, period: int, start: float, end: float) -> None:
        seconds = max(0.0, end - start)
        for side in self.on.values():
            for p in side:
                self.played[p] += seconds
        if seconds or self.pts or self.poss or self.line:
            self.stints.append({"period": period, "start_s": start, "end_s": end, "seconds": seconds, "home_ids": sorted(self.on["home"]), "away_ids": sorted(self.on["away"]), "home_pts": self.pts["home"], "away_pts": self.pts["away"], "home_poss": self.poss["home"], "away_poss": self.poss["away"], **{f"{s}_{c}": self.line[s, c] for s in ("home", "away") for c in BOX_TALLIES}})
        self.pts, self.poss, self.line = Counter(), Counter(), Counter()

    def incoming(self, a, side: str, ahead: tuple[dict, dict] | None):
        """Whom a substitution brings in.  Of several off the floor, the one who acts or goes out first, unless the same
        ones come in again before that; without such evidence the one with most minutes to come."""
        several = _candidates(a)
        off = [c for c in several if c not in self.on[side]]
        if len(off) > 1:
            acts, sets = ahead
            first = min(((acts[c], c) for c in off if c in acts), default=None)
            again = sets.get(frozenset(off))
            if first and (again is None or first[0][0] < again):
                return first[1]
            return max(off, key=self.left)
        if not off and len(several) > 1:
            self.faults["ambiguous"] += 1
        return off[0] if off else a.person

    def walk(self) -> None:
        for period in sorted({a.period for a in self.actions}):
            own = [a for a in self.actions if a.period == period]
            full = all(len(x) == 5 for x in self.starters.values())
            self.on = {s: set(x) for s, x in self.starters.items()} if period == 1 and full else self.inferred(own)
            ahead = coming_acts(own)
            length = 720.0 if period <= 4 else 300.0
            now = start = 0.0
            holder = None
            for at, a in enumerate(own):
                now = max(now, min(length, length - float(a.seconds_left))) if a.seconds_left is not None else now
                team = getattr(a, "team", None)
                side = self.team.get(a.person) or (team if a.kind == "substitution" and team in self.on else None)
                if a.possession and a.possession != holder:
                    holder = a.possession
                    self.poss[holder] += 1
                if a.points and side:
                    self.pts[side] += int(a.points)
                if team in self.on:
                    self.line.update((team, c) for c in getattr(a, "own", None) or ())
                    self.line.update(("away" if team == "home" else "home", c) for c in getattr(a, "other", None) or ())
                if a.kind == "substitution":
                    if not _candidates(a):
                        self.faults["unplaced"] += 1
                    elif side:
                        self.cut(period, start, now)
                        start = now
                        if a.sub_kind == "out":
                            self.on[side].discard(a.person)
                        else:
                            self.on[side].add(self.incoming(a, side, ahead.get(at)))
                    continue
                for who in actors(a):
                    on = self.on.get(self.team.get(who))
                    self.faults["off the floor"] += on is not None and who not in on
                self.faults["not five"] += any(len(x) != 5 for x in self.on.values())
            self.cut(period, start, length)

    def reasons(self, box: list) -> list[str]:
        """Why the stints aren't to be relied on."""
        n = self.faults
        texts = {"ambiguous": "{} substitutions of players of one name", "unplaced": "{} incoming names without a player", "off the floor": "{} actions off the floor", "not five": "not five a side at {} actions"}
        out = [text.format(n[k]) for k, text in texts.items() if n[k]]
        people = [p for p in self.due.keys() | self.played.keys() if self.due.get(p, 0) > 0 or self.played[p] > 0]
        close = sum(abs(self.played[p] - self.due.get(p, 0)) <= 30 for p in people)
        if people and close < 0.9 * len(people):
            out.append(f"minutes match {close}/{len(people)}")
        for side in ("home", "away"):
            final = next((p.team_points for p in box if p.team == side and p.team_points is not None), None)
            if final is not None and final != sum(s[f"{side}_pts"] for s in self.stints):
                return [*out, "points"]
        return out


def walked(game_id: str, actions: list[dict], box: list[dict]) -> list[dict]:
    """Stints of one game's actions in order, and its box."""
    if not box or not actions:
        return []
    lines = [SimpleNamespace(**x) for x in box]
    floor = _Floor([SimpleNamespace(**x) for x in actions], lines)
    floor.walk()
    reasons = "; ".join(floor.reasons(lines))
    return [{"game_id": game_id, **s, "reliable": not reasons, "reasons": reasons} for s in floor.stints]


def _walked(rows: list) -> list[dict]:
    return walked(rows[0].game_id, [r.action for r in rows if r.action], [r.box for r in rows if r.box])


def stint_rows(actions: DataFrame, box: DataFrame, *more: str) -> DataFrame:
    """Actions and box lines under each other: game_id, more, what actions are ordered by, and either as a struct."""
    whole = lambda df: F.struct(*(F.col(c) for c in df.columns if c not in ("game_id", *more)))
    plays = actions.select("game_id", *more, "order_number", (F.lower("sub_kind") == "in").alias("late"), whole(actions).alias("action"))
    return plays.unionByName(box.select("game_id", *more, whole(box).alias("box")), allowMissingColumns=True)


def stint_schema(actions: DataFrame) -> str:
    tallied = {"team", "own", "other"} <= set(actions.columns)
    return STINT + "".join(f", {s}_{c} int" for s in ("home", "away") for c in BOX_TALLIES if tallied)


def stints(actions: DataFrame, box: DataFrame) -> DataFrame:
    """Stints of every game between substitutions, with points and possessions, checked against the box.

    actions: game_id, order_number, period, seconds_left, kind, sub_kind, person, points, possession (home or away), and where
    known assist, steal and block (who did it) and candidates (who a substitution may bring in; see ``with_incoming``).
    box: game_id, person, team (home or away), starter, seconds, team_points.

    Only some kinds of action show that a person is on the floor; see ``actors``.  Actions ``with_tallies`` and their team
    (home or away) give the box line of either side beside, as home_fgm and so on."""
    return folded(stint_rows(actions, box), "game_id", ["order_number", "late"], _walked, stint_schema(actions))


def _words(x) -> Column:
    """Letters and single spaces, lower-case, accents and suffixes gone."""
    letters = F.regexp_replace(F.lower(fold_accents(F.coalesce(x, F.lit("")))), r"[^\p{L} ]", " ")
    return F.array_join(F.filter(F.split(letters, " "), lambda w: ~w.isin("", *SUFFIX_RANK)), " ")


def _suffixes(x) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\.", " "), r"\s+"), lambda w: w.isin(*SUFFIX_RANK))


REPLACED = "replaced by"


def with_incoming(actions: DataFrame, players: DataFrame) -> DataFrame:
    """actions with candidates; in games whose substitutions have no "in" rows, one for each "X replaced by Y", whose
    candidates are the side's players who go by Y: by the whole name or the surname, or the surname and the first initial; if
    there are none, by the surname's last word; of several, those of Y's suffix, if any.  None fit: candidates are empty.

    actions as for ``stints``, with team and text; players: game_id, team, person, name, first, family."""
    sub = F.lower("kind") == "substitution"
    two_rows = actions.where(sub).groupBy("game_id").agg(F.max((F.lower("sub_kind") == "in").cast("int")).alias("_in"))
    old = actions.where(sub & F.contains("text", F.lit(REPLACED))).join(two_rows.where("coalesce(_in, 0) = 0").select("game_id"), "game_id", "left_semi")
    shown = F.substring_index("text", REPLACED, -1)
    asked = old.select("game_id", "team", "order_number", _words(shown).alias("_who"), _suffixes(shown).alias("_suffix"))
    roster = players.select("game_id", "team", "person", _words(F.col("name")).alias("_name"), _words(F.col("family")).alias("_family"), _words(F.col("first")).alias("_first"), _suffixes(F.col("family")).alias("_own"))
    pairs = asked.join(roster, ["game_id", "team"])
    word = F.split("_who", " ")
    rest = F.array_join(F.slice(word, 2, F.greatest(F.size(word) - 1, F.lit(0))), " ")
    whole = (F.col("_name") == F.col("_who")) | (F.col("_family") == F.col("_who"))
    initial = (F.col("_family") != "") & (F.size(word) > 1) & (rest == F.col("_family")) & (F.substring(word[0], 1, 1) == F.substring("_first", 1, 1))
    last = F.substring_index("_family", " ", -1) == F.substring_index("_who", " ", -1)
    rank = F.when((F.col("_who") != "") & (whole | initial), 1).when((F.col("_who") != "") & last, 2)
    fits = pairs.withColumn("_rank", rank).where("_rank IS NOT NULL").withColumn("_same", F.arrays_overlap("_suffix", "_own").cast("int"))
    best = fits.groupBy("game_id", "order_number").agg(F.min("_rank").alias("_best"), F.collect_list(F.struct("_rank", "_same", "person")).alias("_all"))
    named = best.withColumn("_all", F.filter("_all", lambda x: x["_rank"] == F.col("_best")))
    alike = F.filter("_all", lambda x: x["_same"] == 1)
    kept = F.when((F.size("_all") > 1) & (F.size(alike) > 0), alike).otherwise(F.col("_all"))
    candidates = named.select("game_id", "order_number", F.array_sort(F.transform(kept, lambda x: x["person"])).alias("candidates"))
    person = actions.schema["person"].dataType
    incoming = old.join(candidates, ["game_id", "order_number"], "left").withColumns({"sub_kind": F.lit("in"), "candidates": F.coalesce("candidates", F.array().cast(T.ArrayType(person)))})
    incoming = incoming.withColumn("person", F.get("candidates", 0))
    return actions.withColumn("candidates", F.lit(None).cast(T.ArrayType(person))).unionByName(incoming)


def units(stints_: DataFrame, key: list[str]) -> DataFrame:
    """Totals of each side's five: seconds, points for and against, possessions, and whether it opened or closed a game."""
    w = Window.partitionBy("game_id")
    ordered = stints_.withColumn("opened", F.struct("period", "start_s") == F.min(F.struct("period", "start_s")).over(w)).withColumn("closed", F.struct("period", "start_s") == F.max(F.struct("period", "start_s")).over(w))
    side = lambda a, b: F.struct(F.lit(a).alias("side"), F.array_join(F.array_sort(f"{a}_ids").cast("array<string>"), "-").alias("unit"), F.col(f"{a}_pts").alias("pts"), F.col(f"{b}_pts").alias("opp_pts"), F.col(f"{a}_poss").alias("poss"))
    each = ordered.select(*key, "seconds", "opened", "closed", F.inline(F.array(side("home", "away"), side("away", "home"))))
    return each.groupBy(*key, "side", "unit").agg(*(F.sum(c).alias(c) for c in ("seconds", "pts", "opp_pts", "poss")), F.bool_or("opened").alias("opened"), F.bool_or("closed").alias("closed"))


def minutes_check(stints_: DataFrame, box: DataFrame, tolerance: float = 30.0) -> DataFrame:
    """Seconds in stints against seconds in the box, and whether they agree."""
    each = stints_.select("game_id", "seconds", F.explode(F.concat("home_ids", "away_ids")).alias("person")).groupBy("game_id", "person").agg(F.sum("seconds").alias("stint_seconds"))
    both = each.join(box.select("game_id", "person", F.col("seconds").alias("box_seconds")), ["game_id", "person"], "full_outer")
    return both.withColumn("ok", F.abs(F.coalesce("stint_seconds", F.lit(0.0)) - F.coalesce("box_seconds", F.lit(0))) <= tolerance)
