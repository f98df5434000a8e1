"""Schedule payloads: one JSON document of days and games to a row for each game."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The third digit of a game id, and status codes.
KINDS = {"1": "preseason", "2": "regular", "3": "allstar", "4": "playoff", "5": "playin"}
STATUS = {1: "scheduled", 2: "live", 3: "final"}

_TEAM = "struct<teamTricode: string, teamCity: string, teamName: string, score: int>"
PAYLOAD = f"leagueSchedule struct<gameDates: array<struct<gameDate: string, games: array<struct<gameId: string, gameDateEst: string, gameStatusText: string, gameStatus: int, arenaName: string, homeTeam: {_TEAM}, awayTeam: {_TEAM}>>>>>"


def _label(of: dict, code: Column, other: str) -> Column:
    out = F.lit(None)
    for k, v in of.items():
        out = F.when(code == k, v).otherwise(out)
    return F.coalesce(out, F.lit(other))


def kind(game_id: Column) -> Column:
    return _label(KINDS, F.substring(game_id, 3, 1), "other")


def season(game_id: Column, day: Column) -> Column:
    """"2026-27": by the two digits in the id, or without them by the day, seasons beginning in October."""
    digits = F.regexp_extract(game_id, r"^.{3}(\d{2}|\d$)", 1).try_cast("int")
    first = F.coalesce(F.lit(2000) + digits, F.year(day) - F.when(F.month(day) >= 10, 0).otherwise(1))
    return F.concat(first.cast("string"), F.lit("-"), F.lpad(((first + 1) % 100).cast("string"), 2, "0"))


def rows(payloads: DataFrame, column: str) -> DataFrame:
    """A row for each game of the payloads; games whose own date, or else their day's,
    isn't an ISO one are left out."""
    days = payloads.select(F.explode(F.from_json(column, PAYLOAD)["leagueSchedule"]["gameDates"]).alias("d"))
    g = days.select("d.gameDate", F.explode("d.games").alias("g")).select("gameDate", "g.*")
    raw = F.coalesce(F.nullif(F.col("gameDateEst"), F.lit("")), "gameDate")
    day = F.try_to_date(F.nullif(F.regexp_extract(raw, r"^\d{4}-\d{2}-\d{2}", 0), F.lit("")), "yyyy-MM-dd")
    id_ = F.coalesce("gameId", F.lit(""))
    name = lambda side: F.concat_ws(" ", F.coalesce(f"{side}Team.teamCity", F.lit("")), F.coalesce(f"{side}Team.teamName", F.lit("")))
    return g.withColumn("game_date", day).where("game_date IS NOT NULL").select(
        id_.alias("game_id"), season(id_, F.col("game_date")).alias("season"), kind(id_).alias("season_type"), "game_date", F.trim(F.coalesce("gameStatusText", F.lit(""))).alias("game_time"),
        F.col("homeTeam.teamTricode").alias("home"), F.col("awayTeam.teamTricode").alias("away"), name("home").alias("home_name"), name("away").alias("away_name"),
        F.col("arenaName").alias("arena"), _label(STATUS, F.col("gameStatus"), "?").alias("status"), F.col("homeTeam.score").alias("home_score"), F.col("awayTeam.score").alias("away_score"),
    )
