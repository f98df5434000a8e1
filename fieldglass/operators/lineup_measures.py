"""What players' stints say of them: ratings on and off the floor, shares beside a centre and as the tallest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Off the floor counts from more than so many possessions of either side.
LEAST_OFF = 20
SUMS = ("seconds", "pts_for", "pts_against", "poss_for", "poss_against")


def sides(stints: DataFrame) -> DataFrame:
    """A row for each side of each reliable stint, with its five and what it did and let happen.

    stints: season, home, away, home_ids, away_ids, seconds, home_pts, away_pts, home_poss, away_poss, reliable."""
    side = lambda a, b: F.struct(F.col(a).alias("team"), F.col(f"{a}_ids").alias("five"), F.col(f"{a}_pts").alias("pts_for"), F.col(f"{b}_pts").alias("pts_against"), F.col(f"{a}_poss").alias("poss_for"), F.col(f"{b}_poss").alias("poss_against"))
    return stints.where("reliable").select("season", "seconds", F.inline(F.array(side("home", "away"), side("away", "home"))))


def player_measures(stints: DataFrame, people: DataFrame, parts: int | None = None) -> DataFrame:
    """By (season, team, player): seconds, points and possessions on the floor, ratings by 100 possessions on (on_ortg, on_drtg,
    on_net) and off (off_net, on_off; null up to LEAST_OFF possessions of either side), and shares of seconds
    with_centre: another of the five is a centre, of the stints in which the positions of four others are known;
    tallest: nobody of the five is taller, of the stints in which all five heights are known;
    and how much of the seconds these stints are (position_coverage, height_coverage).  Persons without a player count for
    nobody; unresolved(stints, people) lists them.

    people: person, player, height, position; a height of 0 isn't known.  Sides are dealt out once, by their five: stints with
    the same five of one team are added up there, and who the five are is looked up once for all teams and seasons, so that
    only the fives themselves are exploded and put together again, never with their sums.  parts: into how many, if not as many as Spark finds fit."""
    floor = sides(stints)
    fives = floor.repartition(*([parts] if parts else []), "five").groupBy("season", "team", "five").agg(*(F.sum(c).alias(c) for c in SUMS))
    who = people.select(F.col("person").alias("_person"), "player", F.when(F.col("height") != 0, F.col("height")).alias("height"), "position")
    each = floor.select("five").distinct().select("five", F.posexplode("five").alias("_at", "_person")).join(who, "_person", "left")
    # The five comes together again by its own key: five rows a group.
    member = F.struct("_at", "player", "height", "position")
    five = fives.join(each.groupBy("five").agg(F.collect_list(member).alias("_m")), "five")
    known = F.size(F.filter("_m", lambda m: m["height"].isNotNull()))
    on = five.withColumn("_tallest", F.array_max(F.transform("_m", lambda m: m["height"]))).withColumn("_heights", (known == 5) & (F.size("_m") == 5))
    on = on.select("season", "team", *SUMS, "_m", "_tallest", "_heights", F.explode("_m").alias("_p")).where("_p.player IS NOT NULL")
    mates = F.filter("_m", lambda m: m["player"].isNotNull() & (m["player"] != F.col("_p.player")))
    on = on.withColumn("_mates", mates)
    placed = (F.size("_mates") == 4) & (F.size(F.filter("_mates", lambda m: m["position"].isNotNull())) == 4)
    centre = placed & F.exists("_mates", lambda m: F.coalesce(m["position"] == "C", F.lit(False)))
    tallest = F.col("_heights") & (F.col("_p.height") == F.col("_tallest"))
    seconds_if = lambda c, name: F.sum(F.when(c, F.col("seconds"))).alias(name)
    own = on.groupBy("season", "team", F.col("_p.player").alias("player")).agg(
        *(F.sum(c).alias(c) for c in SUMS), seconds_if(placed, "_placed"), seconds_if(centre, "_centre"), seconds_if(F.col("_heights"), "_measured"), seconds_if(tallest, "_tall")
    )
    team = floor.groupBy("season", "team").agg(*(F.sum(c).alias(f"_{c}") for c in SUMS))
    r = own.join(team, ["season", "team"])
    rate = lambda p, q: F.when(q != 0, 100 * p / q)
    off = {c: F.col(f"_{c}") - F.col(c) for c in SUMS}
    enough = (off["poss_for"] > LEAST_OFF) & (off["poss_against"] > LEAST_OFF)
    r = r.withColumn("on_ortg", rate(F.col("pts_for"), F.col("poss_for"))).withColumn("on_drtg", rate(F.col("pts_against"), F.col("poss_against")))
    r = r.withColumn("on_net", F.col("on_ortg") - F.col("on_drtg")).withColumn("off_net", F.when(enough, 100 * off["pts_for"] / off["poss_for"] - 100 * off["pts_against"] / off["poss_against"]))
    share = lambda a, b, name: F.when(F.col(b) > 0, F.coalesce(a, F.lit(0)) / F.col(b)).alias(name)
    return r.select(
        "season", "team", "player", *SUMS, "on_ortg", "on_drtg", "on_net", "off_net", (F.col("on_net") - F.col("off_net")).alias("on_off"),
        share(F.col("_centre"), "_placed", "with_centre"), share(F.col("_placed"), "seconds", "position_coverage"), share(F.col("_tall"), "_measured", "tallest"), share(F.col("_measured"), "seconds", "height_coverage"),
    )


def unresolved(stints: DataFrame, people: DataFrame) -> DataFrame:
    """(person, seconds) of those on the floor without a player, whose rating goes to nobody."""
    floor = sides(stints).select("seconds", F.explode("five").alias("person")).groupBy("person").agg(F.sum("seconds").alias("seconds"))
    known = people.where("player IS NOT NULL").select("person").distinct()
    return floor.join(known, "person", "left_anti")
