"""Ledgers of active games against a quota that shrinks with the day of signing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fixed value: games of a whole season's quota.
QUOTA = 50


def prorated(quota: int, signed: Column, first: Column, last: Column) -> Column:
    """The quota of somebody signed on this day: whole without a day or up to the season's first, none after its last, and
    between by the share of its days that is left, to the nearest even number where it lies halfway."""
    left, total = F.datediff(last, signed) + 1, F.datediff(last, first) + 1
    part = F.bround(quota * left / total).cast("long")
    known = signed.isNotNull() & first.isNotNull() & last.isNotNull()
    return F.when(~known | (signed <= first), F.lit(quota).cast("long")).when(signed > last, F.lit(0).cast("long")).otherwise(part)


def last_signings(signings: DataFrame) -> DataFrame:
    """The signing that counts for each (season, player): of the best source (least rank), the last; of one day, the team
    that comes last.

    signings: season, player, day, team, source, rank."""
    best = F.max(F.struct((-F.col("rank")).alias("_r"), "day", "team", "source")).alias("_s")
    return signings.where("day IS NOT NULL").groupBy("season", "player").agg(best).select("season", "player", "_s.day", "_s.team", "_s.source")


def tracker(listed: DataFrame, signings: DataFrame, appearances: DataFrame, schedule: DataFrame, quota: int = QUOTA, recent: int = 10) -> DataFrame:
    """A row for each row of listed, of all seasons at once, with
    signed, signed_source: the counting signing, if it is with the team listed, or the day first seen on the list, if that is
        after the season's first list and first game; else null (source none), and games count from the season's first;
    quota, used, left: games of the quota, active games since, and what is left (null without a player or team);
    team_games_left, limit_game, limit_day: the team's games to come and the one at which the quota is used up if the player
        is active in all of them; can_reach, whether there are as many;
    recent_games, recent_active, recent_played, recent_seconds: of the team's last played games.

    listed: season, player, team, first_seen, first_list.  appearances: season, player, team, game, day, active, played,
    seconds.  schedule: season, game, day, home, away, final.  Games of one day are in order of game.

    A team's games of a season are a bounded window; appearances are added up by (season, player, team) before they are
    joined, and those of recent games by a join on (season, game, team)."""
    bounds = schedule.groupBy("season").agg(F.min("day").alias("_first"), F.max("day").alias("_last"))
    sides = schedule.select("season", "game", "day", "final", F.explode(F.array_distinct(F.array("home", "away"))).alias("team")).where("team IS NOT NULL")
    ahead = sides.where(~F.coalesce("final", F.lit(False)))
    by = Window.partitionBy("season", "team")
    ahead = ahead.select("season", "team", F.col("game").alias("limit_game"), F.col("day").alias("limit_day"), F.row_number().over(by.orderBy("day", "game")).cast("long").alias("_n"), F.count(F.lit(1)).over(by).alias("_ahead"))
    lately = sides.where("final").withColumn("_n", F.row_number().over(by.orderBy(F.desc("day"), F.desc("game")))).where(F.col("_n") <= recent).select("season", "team", "game")
    lately_n = lately.groupBy("season", "team").agg(F.count(F.lit(1)).alias("recent_games"))

    s = last_signings(signings).select("season", "player", F.col("day").alias("_day"), F.col("team").alias("_team"), F.col("source").alias("_source"))
    rows = listed.join(bounds, "season", "left").join(s, ["season", "player"], "left")
    agreed = F.col("_day").isNotNull() & (F.col("team").isNull() | F.col("_team").eqNullSafe(F.col("team")))
    seen = (F.col("first_seen") > F.col("first_list")) & (F.col("first_seen") > F.col("_first"))
    rows = rows.withColumn("signed", F.when(agreed, F.col("_day")).when(seen, F.col("first_seen"))).withColumn("signed_source", F.when(agreed, F.col("_source")).when(seen, "list").otherwise("none"))
    rows = rows.withColumn("quota", prorated(quota, F.col("signed"), F.col("_first"), F.col("_last"))).withColumn("_since", F.coalesce("signed", "_first", F.lit("1900-01-01").cast("date")))

    key = ["season", "player", "team"]
    who = rows.select(*key, "_since").where("player IS NOT NULL AND team IS NOT NULL").distinct()
    days = appearances.where("active").select(*key, F.col("day").alias("_on"))
    used = who.join(days, key).where("_on >= _since").groupBy(*key, "_since").agg(F.count(F.lit(1)).alias("used"))
    late = appearances.join(lately, ["season", "team", "game"]).groupBy(*key).agg(
        F.count_if("active").alias("recent_active"), F.count_if("played").alias("recent_played"), F.coalesce(F.sum("seconds"), F.lit(0)).alias("recent_seconds")
    )
    known = F.col("player").isNotNull() & F.col("team").isNotNull()
    given = lambda c: F.when(known, F.coalesce(c, F.lit(0))).alias(c)
    rows = rows.join(used, [*key, "_since"], "left").withColumn("used", given("used"))
    rows = rows.withColumn("left", F.when(known, F.greatest(F.lit(0).cast("long"), F.col("quota") - F.col("used"))))

    total = ahead.groupBy("season", "team").agg(F.max("_ahead").alias("_total"))
    rows = rows.join(total, ["season", "team"], "left").withColumn("team_games_left", F.coalesce("_total", F.lit(0)))
    at = ahead.select("season", "team", F.col("_n").alias("left"), "limit_game", "limit_day")
    rows = rows.join(at, ["season", "team", "left"], "left").join(lately_n, ["season", "team"], "left").join(late, key, "left")
    return rows.select(
        *listed.columns, "signed", "signed_source", "quota", "used", "left", "team_games_left", "limit_game", "limit_day", F.coalesce(F.col("left") <= F.col("team_games_left"), F.lit(False)).alias("can_reach"),
        *(given(c) for c in ("recent_games", "recent_active", "recent_played", "recent_seconds")),
    )
