"""Who passed: the name in a made shot's text against those who could have, and shots and passes by zone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.functions.shots import ZONES
from fieldglass.functions.text import fold_accents, without_suffix


def passer_name(text: Column) -> Column:
    """The name in "(Name 3 AST)"; empty if there is none."""
    return F.coalesce(F.regexp_extract(text, r"\(([^()]*?)\s+\d+\s+AST\)", 1), F.lit(""))


def plain(name: Column) -> Column:
    """Lower-case letters a-z alone, whitespace and all else dropped."""
    return F.regexp_replace(F.lower(name), "[^a-z]", "")


def surname(full: Column) -> Column:
    """The full name less its first word and a suffix."""
    return without_suffix(F.regexp_replace(full, r"^\S+\s+", ""))


def name_keys(shown: Column, full: Column) -> Column:
    """Keys that a text may call a player by: as shown, with the first initial before, and by the surname, alone or with
    one or two letters before; null and empty ones left out."""
    initials = lambda n, rest: F.concat(F.substring(full, 1, n), rest)
    last = surname(full)
    keys = F.array(plain(shown), plain(initials(1, shown)), plain(last), plain(initials(1, last)), plain(initials(2, last)), plain(F.regexp_replace(full, r"^\S+\s+", "")))
    return F.array_distinct(F.filter(keys, lambda k: k.isNotNull() & (k != "")))


def resolved(made: DataFrame, pool: DataFrame, side: list[str], shot: list[str], text: str, shooter: str, player: str, shown: str, full: str, fold=fold_accents) -> DataFrame:
    """made with assisted, assist_name, the one player of its side (game and team) who goes by that name and isn't the
    shooter, as assist_player, and match: none, resolved, ambiguous or unmatched.  fold takes accents off.

    pool: who could have passed, with side, player, shown and full; one join by side and key, so a name is only met with
    the same name in the same game."""
    named = made.withColumn("_name", passer_name(F.col(text)))
    folded = pool.select(*side, F.col(player).alias("_who"), fold(F.col(shown)).alias("_shown"), fold(F.col(full)).alias("_full"))
    keys = folded.select(*side, "_who", F.explode(name_keys(F.col("_shown"), F.col("_full"))).alias("_key")).distinct()
    asked = named.where("_name <> ''").select(*side, *shot, F.col(shooter).alias("_shooter"), plain(fold(F.col("_name"))).alias("_key"))
    hits = asked.join(keys, [*side, "_key"]).where(F.col("_shooter").isNull() | (F.col("_who") != F.col("_shooter")))
    found = hits.groupBy(*side, *shot).agg(F.count_distinct("_who").alias("_n"), F.min("_who").alias("_who"))
    match = F.when(F.col("_name") == "", "none").when(F.col("_n") == 1, "resolved").when(F.col("_n") > 1, "ambiguous").otherwise("unmatched")
    return named.join(found, [*side, *shot], "left").select(
        *made.columns, (F.col("_name") != "").alias("assisted"), F.when(F.col("_n") == 1, F.col("_who")).alias("assist_player"), F.nullif(F.col("_name"), F.lit("")).alias("assist_name"), match.alias("match")
    )


def by_zone(shots: DataFrame, key: list[str], shooter: str, passer: str, assisted: str, zone: str) -> DataFrame:
    """(player, key) with <zone>_fgm_ast, own makes that were assisted, and <zone>_ast, passes for makes.

    Each shot goes to its shooter and its passer, and one aggregate has both."""
    roles = F.array(F.struct(F.col(shooter).alias("player"), F.col(assisted).alias("made"), F.lit(False).alias("passed")), F.struct(F.col(passer).alias("player"), F.lit(False).alias("made"), F.lit(True).alias("passed")))
    each = shots.select(*key, F.col(zone).alias("_zone"), F.explode(roles).alias("_r")).select(*key, "_zone", "_r.*").where("player IS NOT NULL")
    made = [F.count_if((F.col("_zone") == z) & F.col("made")).alias(f"{z}_fgm_ast") for z in ZONES]
    passed = [F.count_if((F.col("_zone") == z) & F.col("passed")).alias(f"{z}_ast") for z in ZONES]
    return each.groupBy("player", *key).agg(*made, *passed)
