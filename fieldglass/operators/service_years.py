"""Seasons of service: what each season of a career counts for, and what a player is eligible for after that.

A season counts by a game outside a two-way spell, or by a standard contract signed in its league year.  Everything is joins
of a player's spells and days with the seasons' bounds, and aggregates of them; no career is walked."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# When contract records begin, two-way seasons with a team after which it is closed, and older team codes.
RECORDS_FROM = dt.date(2015, 7, 1)
MOST_WITH_TEAM = 3
TEAMS = {
    "BRK": "BKN", "NJN": "BKN", "PHO": "PHX", "CHO": "CHA", "CHH": "CHA", "NOH": "NOP", "NOK": "NOP", "SEA": "OKC", "VAN": "MEM", "WSB": "WAS", "GOS": "GSW", "SAN": "SAS", "UTH": "UTA", "NYN": "NYK",
}
TWO_WAY, STANDARD = "two_way", "standard"


def canonical(team: Column) -> Column:
    return F.coalesce(F.create_map(*(F.lit(x) for pair in TEAMS.items() for x in pair))[team], team)


def season_of_year(year: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-"), F.lpad(((year + 1) % 100).cast("string"), 2, "0"))


def league_year(day: Column) -> Column:
    """The season that a day belongs to; the league's year begins in July."""
    return season_of_year(F.year(day) - F.when(F.month(day) < 7, 1).otherwise(0))


def with_listed(spells: DataFrame, listed: DataFrame, bounds: DataFrame, season: str, today: dt.date) -> DataFrame:
    """spells and, for players on a team's two-way list (player, team) without an open two-way spell there, one from the
    season's first day."""
    open_ = spells.where((F.col("type") == TWO_WAY) & F.col("end").isNull()).select("player", "team")
    first = bounds.where(F.col("season") == season).agg(F.coalesce(F.min("first"), F.lit(today)).alias("start"))
    new = listed.distinct().join(open_, ["player", "team"], "left_anti").crossJoin(first)  # one row
    return spells.select("player", "type", "team", "start", "end").unionByName(new.select("player", F.lit(TWO_WAY).alias("type"), "team", "start", F.lit(None).cast("date").alias("end")))


def seasons(days: DataFrame, spells: DataFrame, listed: DataFrame, bounds: DataFrame, season: str, two_way_counts: bool = False) -> DataFrame:
    """(player, season, std_games, tw_games, tw_teams, how, counts): every season of every player and why it counts: games,
    contract, or two-way if such seasons do; null if it doesn't.

    days: player, season, team, day of each appearance; spells as from ``with_listed``; bounds: season, first and last day.
    Seasons without bounds are left out."""
    overlaps = (F.col("start") <= F.col("last")) & (F.col("end").isNull() | (F.col("end") >= F.col("first")))
    played = days.select("player", "season", canonical(F.col("team")).alias("team"), "day").groupBy("player", "season", "team", "day").agg(F.count(F.lit(1)).alias("n"))
    spell = spells.withColumn("signed", league_year(F.col("start")))
    all_ = played.select("player", "season").union(spell.where(F.col("start") >= F.lit(RECORDS_FROM)).select("player", "signed")).distinct().join(bounds, "season")
    two_way = spell.where(F.col("type") == TWO_WAY)
    # A day is on a two-way contract if one with the day's team holds then, and reaches into the season.
    holds = two_way.select(F.col("player").alias("p"), F.col("team").alias("t"), "start", "end")
    on = (F.col("player") == F.col("p")) & (F.col("team") == F.col("t")) & (F.col("start") <= F.col("day")) & (F.col("end").isNull() | (F.col("end") >= F.col("day"))) & overlaps
    each = played.join(bounds, "season").join(holds, on, "left").groupBy("player", "season", "team", "day", "n").agg(F.bool_or(F.col("p").isNotNull()).alias("tw"))
    games = each.groupBy("player", "season").agg(F.sum(F.when(~F.col("tw"), F.col("n")).otherwise(0)).alias("std_games"), F.sum(F.when(F.col("tw"), F.col("n")).otherwise(0)).alias("tw_games"))
    here = all_.join(spell, "player").where(overlaps)
    on_list = listed.distinct().withColumn("on_list", F.lit(True))
    of_year = here.where(F.col("type") == TWO_WAY).join(on_list, ["player", "team"], "left").where((F.col("signed") == F.col("season")) | (F.col("on_list") & (F.col("season") == season)))
    teams = each.where("tw").select("player", "season", "team").union(of_year.select("player", "season", "team")).groupBy("player", "season").agg(F.array_sort(F.collect_set("team")).alias("tw_teams"))
    signed = here.where((F.col("type") == STANDARD) & (F.col("signed") == F.col("season"))).select("player", "season").distinct().withColumn("contract", F.lit(True))
    out = all_.join(games, ["player", "season"], "left").join(teams, ["player", "season"], "left").join(signed, ["player", "season"], "left")
    none = F.array().cast("array<string>")
    out = out.select("player", "season", F.coalesce("std_games", F.lit(0)).alias("std_games"), F.coalesce("tw_games", F.lit(0)).alias("tw_games"), F.coalesce("tw_teams", none).alias("tw_teams"), "contract")
    how = F.when(F.col("std_games") > 0, "games").when(F.col("contract"), "contract")
    if two_way_counts:
        how = how.when((F.col("tw_games") > 0) | (F.size("tw_teams") > 0), "two-way")
    return out.withColumn("how", how).withColumn("counts", how.isNotNull()).drop("contract")


BEFORE_RECORDS = "Seasons before July 2015, when contract records begin, may have been spent on a roster without a game; they can't be seen."
BETWEEN = "Not counted though seasons before and after were: "
NO_GAMES = "A season was counted without any game, which may make an exception; it also takes a whole regular season on the roster and no playoff game."
TWO_WAY_ONLY = "Seasons with two-way contracts alone aren't counted."
_COUNTS = ("yos", "yos_next", "tw_seasons")


def assessed(rows: DataFrame, season: str, two_way_counts: bool = False) -> DataFrame:
    """(player, yos, yos_next, tw_seasons, blocked, status, max_years, exception, confidence, notes) from ``seasons``: the
    season under way isn't counted in yos, only in yos_next.

    Up to 2 seasons: two years; 3: one; 4, of which one by a contract without any game: an exception; else none."""
    done = F.col("season") < season
    idle = done & (F.col("how") == "contract") & (F.col("std_games") == 0) & (F.col("tw_games") == 0)
    of = rows.groupBy("player").agg(
        F.count_if(done & F.col("counts")).alias("yos"), F.count_if(F.col("counts") & (F.col("season") <= season)).alias("yos_next"), F.count_if(F.size("tw_teams") > 0).alias("tw_seasons"),
        F.array_sort(F.collect_set(F.when(done & F.col("counts"), F.col("season")))).alias("counted"), F.coalesce(F.bool_or(idle), F.lit(False)).alias("idle"),
        F.coalesce(F.bool_or(done & ~F.col("counts") & (F.size("tw_teams") > 0)), F.lit(False)).alias("only_tw"),
    )
    closed = rows.select("player", F.explode("tw_teams").alias("team")).groupBy("player", "team").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MOST_WITH_TEAM)
    of = of.join(closed.groupBy("player").agg(F.array_sort(F.collect_set("team")).alias("blocked")), "player", "left")
    exception = (F.col("yos") == 4) & F.col("idle")
    year = lambda x: F.substring(x, 1, 4).cast("int")
    all_ = F.transform(F.sequence(year(F.get("counted", 0)), year(F.element_at("counted", -1))), season_of_year)
    between = F.when(F.size("counted") > 0, F.array_except(all_, F.col("counted"))).otherwise(F.array().cast("array<string>"))
    few = F.col("yos") <= 5
    early = few & F.coalesce(F.get("counted", 0) < "2015-16", F.lit(False))
    of = of.withColumns({"exception": exception, "between": between, "early": early})
    gaps = few & (F.size("between") > 0)
    notes = [F.when(F.col("early"), BEFORE_RECORDS), F.when(gaps, F.concat(F.lit(BETWEEN), F.array_join("between", ", "))), F.when(F.col("exception"), NO_GAMES)]
    notes += [] if two_way_counts else [F.when(F.col("only_tw"), TWO_WAY_ONLY)]
    status = lambda *of_: F.when(F.col("yos") <= 2, of_[0]).when(F.col("yos") == 3, of_[1]).when(F.col("exception"), of_[2]).otherwise(of_[3])
    return of.select(
        "player", *_COUNTS, F.coalesce("blocked", F.array().cast("array<string>")).alias("blocked"), status("eligible", "one_year", "exception", "ineligible").alias("status"), status(2, 1, 1, 0).alias("max_years"), "exception",
        F.when(F.col("early") | gaps, "medium").otherwise("high").alias("confidence"), F.array_compact(F.array(*notes)).alias("notes"),
    )


def service(days: DataFrame, spells: DataFrame, listed: DataFrame, bounds: DataFrame, season: str, today: dt.date, two_way_counts: bool = False) -> tuple[DataFrame, DataFrame]:
    """(seasons, assessments); a player without a season has counted none."""
    all_spells = with_listed(spells, listed, bounds, season, today)
    rows = seasons(days, all_spells, listed, bounds, season, two_way_counts)
    everyone = days.select("player").union(all_spells.select("player")).distinct()
    told = everyone.join(assessed(rows, season, two_way_counts), "player", "left")
    none = F.array().cast("array<string>")
    filled = {c: F.coalesce(c, F.lit(0)) for c in _COUNTS} | {"blocked": F.coalesce("blocked", none), "status": F.coalesce("status", F.lit("eligible")), "max_years": F.coalesce("max_years", F.lit(2)), "exception": F.coalesce("exception", F.lit(False)), "confidence": F.coalesce("confidence", F.lit("high")), "notes": F.coalesce("notes", none)}
    return rows, told.withColumns(filled)
