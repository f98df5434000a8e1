"""Payloads of the league's feeds: box lines in two shapes, and actions translated to the older feed's events.

Payloads have no fixed schema, so they are read as variants: a field that is absent, or of another kind than expected, is
null, and a payload that isn't JSON has no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.functions.text import iso_clock_seconds

# Names of statistics in the payloads.
STATS = {
    "fgm": "fieldGoalsMade", "fga": "fieldGoalsAttempted", "fg3m": "threePointersMade", "fg3a": "threePointersAttempted", "ftm": "freeThrowsMade", "fta": "freeThrowsAttempted",
    "orb": "reboundsOffensive", "drb": "reboundsDefensive", "trb": "reboundsTotal", "ast": "assists", "stl": "steals", "blk": "blocks", "tov": "turnovers", "pf": "foulsPersonal", "pts": "points",
}
# What the older feed calls the kinds of turnover, of shot and of action.
TURNOVERS = {
    "bad pass": "Bad Pass", "lost ball": "Lost Ball", "offensive foul": "Offensive Foul Turnover", "shot clock": "Shot Clock Turnover", "traveling": "Traveling", "travel": "Traveling",
    "double dribble": "Double Dribble", "palming": "Palming Turnover", "discontinued dribble": "Discontinue Dribble Turnover", "backcourt": "Backcourt Turnover", "3 second": "3 Second Violation",
    "5 second": "5 Second Violation", "8 second": "8 Second Violation", "offensive goaltending": "Offensive Goaltending", "step out of bounds": "Step Out of Bounds Turnover", "kicked ball": "Kicked Ball Violation",
    "lane violation": "Lane Violation Turnover", "jumpball violation": "Jump Ball Violation", "jump ball violation": "Jump Ball Violation", "basket from below": "Basket from Below Turnover",
    "illegal assist": "Illegal Assist Turnover", "too many players": "Too Many Players Turnover",
}
SHOTS = {"layup": "Layup Shot", "dunk": "Dunk Shot", "hook": "Hook Shot", "jump shot": "Jump Shot", "fadeaway": "Fadeaway Jump Shot", "tip": "Tip Shot"}
KINDS = {
    "rebound": "Rebound", "substitution": "Substitution", "jumpball": "Jump Ball", "timeout": "Timeout", "violation": "Violation", "period": "period", "steal": "Steal", "block": "Block", "ejection": "Ejection",
    "instantreplay": "Instant Replay",
}


def at(v: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, f"$.{path}", kind)


def named(values: dict[str, str], x: Column) -> Column:
    return F.create_map(*(F.lit(v) for pair in values.items() for v in pair))[x]


def capitals(x: Column) -> Column:
    """Every word with a capital, the rest of it as it is; empty for null."""
    words = F.filter(F.split(F.coalesce(x, F.lit("")), r"\s+"), lambda w: w != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))), " ")


def _players(payloads: DataFrame, key: list[str], payload: str, root: str) -> DataFrame:
    """A row for each player of either team: key, is_home, team, opponent and the player's variant p."""
    game = F.try_variant_get(F.try_parse_json(F.col(payload)), f"$.{root}", "variant")
    own = payloads.select(*key, game.alias("_game"))
    side = lambda us, them, home: F.struct(F.lit(home).alias("is_home"), at(F.col("_game"), f"{us}.teamTricode").alias("team"), at(F.col("_game"), f"{them}.teamTricode").alias("opponent"), at(F.col("_game"), f"{us}.players", "array<variant>").alias("_players"))
    sides = own.select(*key, F.inline(F.array(side("homeTeam", "awayTeam", True), side("awayTeam", "homeTeam", False))))
    return sides.select(*key, "is_home", "team", "opponent", F.explode("_players").alias("p"))


def _line(players: DataFrame, key: list[str], name: Column, started: Column, played: Column, reason: Column, seconds: Column, all_stats: bool) -> DataFrame:
    p = F.col("p")
    kept = lambda x: x if all_stats else F.when(F.col("played"), x)
    told = players.withColumns({"person": at(p, "personId"), "name": name, "started": started, "played": F.coalesce(played, F.lit(False)), "_reason": reason, "_seconds": seconds})
    stats = [kept(at(p, f"statistics.{s}", "int")).alias(c) for c, s in STATS.items()]
    margin = F.rint(at(p, "statistics.plusMinusPoints", "double")).cast("int")
    return told.select(*key, "is_home", "team", "opponent", "person", "name", "started", "played", F.when(~F.col("played"), F.col("_reason")).alias("dnp_reason"), F.when(F.col("played"), F.col("_seconds")).cast("int").alias("seconds_played"), *stats, kept(margin).alias("plus_minus"))


def _minutes(x: Column) -> Column:
    """Seconds of MM:SS, or of minutes with a fraction."""
    minutes, seconds = (F.regexp_extract(x, r"^(\d+):(\d{1,2})$", k) for k in (1, 2))
    return F.when(minutes != "", minutes.try_cast("int") * 60 + seconds.try_cast("int")).otherwise((x.try_cast("double") * 60).cast("int"))


def traditional_lines(payloads: DataFrame, key: list[str], payload: str) -> DataFrame:
    """Box lines of payloads with boxScoreTraditional: who has a position started; who has time, tries, points or rebounds
    played."""
    p = F.col("p")
    full = F.nullif(F.concat_ws(" ", F.nullif(at(p, "firstName"), F.lit("")), F.nullif(at(p, "familyName"), F.lit(""))), F.lit(""))
    seconds = _minutes(at(p, "statistics.minutes"))
    stat = lambda s: F.coalesce(at(p, f"statistics.{s}", "double") != 0, F.lit(False))
    played = F.coalesce(seconds > 0, F.lit(False)) | stat("fieldGoalsAttempted") | stat("points") | stat("reboundsTotal")
    comment = F.nullif(F.trim(at(p, "comment")), F.lit(""))
    started = F.coalesce(F.trim(at(p, "position")) != "", F.lit(False))
    return _line(_players(payloads, key, payload, "boxScoreTraditional"), key, F.coalesce(full, at(p, "nameI")), started, played, F.coalesce(comment, F.lit("Did Not Play")), seconds, True)


def live_lines(payloads: DataFrame, key: list[str], payload: str) -> DataFrame:
    """Box lines of payloads with game, whose players have flags; inactive players have no line."""
    p = F.col("p")
    active = _players(payloads, key, payload, "game").where(F.coalesce(F.upper(at(p, "status")) != "INACTIVE", F.lit(True)))
    reason = F.coalesce(F.nullif(at(p, "notPlayingDescription"), F.lit("")), F.lit("Did Not Play"))
    seconds = F.rint(iso_clock_seconds(at(p, "statistics.minutes")))
    played = F.coalesce(at(p, "played") == "1", F.lit(False))
    return _line(active, key, at(p, "name"), F.coalesce(played & (at(p, "starter") == "1"), F.lit(False)), played, reason, seconds, False)


def turnover_kind(kind: Column, descriptor: Column) -> Column:
    """What the older feed calls a turnover."""
    k, d = F.lower(F.coalesce(kind, F.lit(""))), F.lower(F.coalesce(descriptor, F.lit("")))
    out = F.when(F.contains(d, F.lit("pass")), "Out of Bounds - Bad Pass Turnover").when(F.contains(d, F.lit("step")), "Step Out of Bounds Turnover").otherwise("Out of Bounds Lost Ball Turnover")
    spaced = F.trim(F.regexp_replace(k, r"[-\s]+", " "))
    plain = F.when(spaced.isin("offensive foul", "offensive goaltending"), spaced).otherwise(F.regexp_replace(spaced, "^offensive ", ""))
    plain = F.when(plain.isin("lane violation", "jumpball violation"), plain).otherwise(F.regexp_replace(plain, " violation$", ""))
    return F.when(k == "out-of-bounds", out).otherwise(F.coalesce(named(TURNOVERS, k), named(TURNOVERS, plain), F.nullif(capitals(k), F.lit("")), F.lit("Unknown")))


def translated(payloads: DataFrame, key: list[str], payload: str, home: str) -> DataFrame:
    """The actions of payloads as the older feed's events, in order by action_id: key, and for each action its kind and
    sub_kind in that feed's words, result, value, where it was, and what its person has scored so far.

    home: the column with the home team's id; one game per key."""
    whole = F.try_parse_json(F.col(payload))
    each = payloads.select(*key, F.col(home).cast("string").alias("_home"), F.explode(F.try_variant_get(whole, "$.game.actions", "array<variant>")).alias("a"))
    a = F.col("a")
    number = lambda path, kind="long": at(a, path, kind)
    read = each.select(
        *key, "_home", number("orderNumber").alias("_order"), number("actionNumber").alias("action_number"), number("period", "int").alias("period"), at(a, "clock").alias("clock"), F.coalesce(number("personId"), F.lit(0)).alias("person"),
        F.coalesce(at(a, "playerName"), F.lit("")).alias("player_name"), F.coalesce(number("teamId"), F.lit(0)).alias("team_id"), F.coalesce(at(a, "teamTricode"), F.lit("")).alias("team"), F.lower(F.coalesce(at(a, "actionType"), F.lit(""))).alias("t"),
        F.coalesce(at(a, "subType"), F.lit("")).alias("st"), F.coalesce(at(a, "descriptor"), F.lit("")).alias("d"), F.coalesce(at(a, "description"), F.lit("")).alias("text"), F.regexp_replace(F.coalesce(at(a, "shotResult"), F.lit("")), "^[ :]+|[ :]+$", "").alias("r"),
        *(at(a, f, "double").alias(c) for c, f in (("distance", "shotDistance"), ("x", "xLegacy"), ("y", "yLegacy"))), *(at(a, f).alias(c) for c, f in (("score_home", "scoreHome"), ("score_away", "scoreAway"))),
        *(number(f).alias(c) for c, f in (("assist", "assistPersonId"), ("steal", "stealPersonId"), ("block", "blockPersonId"), ("possession", "possession"))),
    ).where("t <> 'game'")
    t, st, d = F.col("t"), F.col("st"), F.col("d")
    shot, free = t.isin("2pt", "3pt"), t == "freethrow"
    result = F.coalesce(named({"made": "Made", "missed": "Missed"}, F.lower("r")), F.col("r"))
    made = result == "Made"
    place = F.regexp_replace(st, r"^(\d+)\s*of\s*(\d+)$", "$1 of $2")
    throw = F.concat(F.lit("Free Throw "), F.when(place.rlike(r"\d+ of \d+"), place).otherwise(capitals(place)))
    base = F.coalesce(named(SHOTS, F.lower(st)), capitals(st))
    kind = F.when(shot & made, "Made Shot").when(shot, "Missed Shot").when(free, "Free Throw").when(t == "turnover", "Turnover").when(t == "foul", "Foul").otherwise(F.coalesce(named(KINDS, t), capitals(t)))
    sub = F.when(shot, F.trim(F.when(d != "", F.concat_ws(" ", capitals(d), base)).otherwise(base))).when(free, throw).when(t == "turnover", turnover_kind(st, d))
    sub = sub.when(t == "foul", F.coalesce(F.nullif(capitals(d), F.lit("")), capitals(st))).when(t == "period", st).otherwise(capitals(st))
    worth = F.when(t == "3pt", 3).when(t == "2pt", 2).otherwise(0)
    scored = F.when(made & shot, worth).when(made & free, 1)
    order = [F.coalesce("_order", F.lit(0)), F.coalesce("action_number", F.lit(0))]
    so_far = Window.partitionBy(*key, "person").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    side = F.when(F.col("team_id") == 0, "").when(F.col("team_id").cast("string").eqNullSafe(F.col("_home")), "h").otherwise("v")
    where = lambda c: F.when(shot, F.col(c)).alias(c)
    return read.select(
        *key, F.coalesce(F.nullif("_order", F.lit(0)), "action_number").alias("action_id"), "action_number", "period", "clock", "person", "player_name", "team_id", "team", kind.alias("kind"), sub.alias("sub_kind"), "text",
        F.when(shot | free, result).otherwise("").alias("result"), worth.alias("value"), side.alias("location"), where("distance"), where("x"), where("y"), shot.alias("is_field_goal"),
        F.when(scored.isNotNull(), F.sum(scored).over(so_far)).alias("points_total"), "score_home", "score_away", "assist", "steal", "block", "possession",
    )
