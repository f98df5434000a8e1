"""Box plus-minus from season totals: native columns, one window over a team's players."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.operators.models import clamp_normalise

# The published regression.  Pairs hold at position (or role) 1 and 5.
POINTS_BASELINE = 1.09
THRESHOLD_OFFSET = 0.33
POSITION = {"one": 2.130, "trb": 8.668, "stl": -2.486, "pf": 0.992, "ast": -3.536, "blk": 1.667}
ROLE = {"one": 6.00, "ast": -6.642, "threshold": -8.544}
PRIOR_MINUTES, PRIOR_POSITION, PRIOR_ROLE, TARGET = 50.0, 3.0, 4.0, 3.0
OVERALL = {
    "pts": (0.860, 0.860), "fg3m": (0.389, 0.389), "ast": (0.580, 1.034), "tov": (-0.964, -0.964), "orb": (0.613, 0.181),
    "drb": (0.116, 0.181), "stl": (1.369, 1.008), "blk": (1.327, 0.703), "pf": (-0.367, -0.367),
}
OVERALL_ROLE = {"fga": (-0.560, -0.780), "fta": (-0.246, -0.343)}
OVERALL_CONSTANTS = (-0.818, -2.774)
OFFENCE = {
    "pts": (0.605, 0.605), "fg3m": (0.477, 0.477), "ast": (0.476, 0.476), "tov": (-0.579, -0.882), "orb": (0.606, 0.422),
    "drb": (-0.112, 0.103), "stl": (0.177, 0.294), "blk": (0.725, 0.097), "pf": (-0.439, -0.439),
}
OFFENCE_ROLE = {"fga": (-0.330, -0.472), "fta": (-0.145, -0.208)}
OFFENCE_CONSTANTS = (-1.698, -0.860)


def _between(pair: tuple[float, float], at: Column) -> Column:
    return F.lit(pair[0]) + (at - 1.0) / 4.0 * (pair[1] - pair[0])


def raw_value(stat: Callable[[str], Column], pos: Column, role: Column, coefficients: dict, roles: dict, constants: tuple[float, float]) -> Column:
    """The regression's value before a team's own level: stat gives a total per 100 possessions, points in context."""
    out = sum((_between(v, pos) * stat(k) for k, v in coefficients.items()), F.lit(0.0))
    out = out + sum((_between(v, role) * stat(k) for k, v in roles.items()), F.lit(0.0))
    out = out + F.when(pos < 3, (3.0 - pos) * (constants[0] / 2)).otherwise(0.0)
    return out + (3.0 - role) * (constants[1] / 2)


#: Totals that the regression takes.
STATS = tuple(dict.fromkeys((*OVERALL, *OVERALL_ROLE)))


def arc_values(windows: DataFrame, params: DataFrame, league: DataFrame, player: str, season: str) -> DataFrame:
    """windows with bpm, obpm and dbpm, and ts_rel, scoring efficiency over the season's.

    windows: player, season, win_poss and win_<total> for each of STATS (as ``joins.trailing_window`` makes them); params:
    each player's pos, role, context and the adjustments bpm_adj and obpm_adj that the season's own value has over its raw
    one; league: the season's ts.  Windows without params or possessions are left out."""
    d = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    w = windows.join(params.select(player, season, "pos", "role", "context", "bpm_adj", "obpm_adj"), [player, season]).join(league.select(season, F.col("ts").alias("_ts")), season, "left").where("win_poss > 0")
    tsa, per100 = d("win_fga") + 0.44 * d("win_fta"), lambda c: 100.0 * c / d("win_poss")
    stat = lambda k: per100(d(f"win_{k}")) - F.col("context") * per100(tsa) if k == "pts" else per100(d(f"win_{k}"))
    of = lambda adj, *c: raw_value(stat, F.col("pos"), F.col("role"), *c) + F.col(adj)
    w = w.withColumn("bpm", of("bpm_adj", OVERALL, OVERALL_ROLE, OVERALL_CONSTANTS)).withColumn("obpm", of("obpm_adj", OFFENCE, OFFENCE_ROLE, OFFENCE_CONSTANTS))
    rel = d("win_pts") / F.nullif(2.0 * tsa, F.lit(0.0)) - F.coalesce("_ts", F.lit(0.55))
    return w.select(*windows.columns, "bpm", "obpm", (F.col("bpm") - F.col("obpm")).alias("dbpm"), rel.alias("ts_rel"))


def box_plus_minus(players: DataFrame, teams: DataFrame, key: list[str], player: str) -> DataFrame:
    """(key, player, pos_est, role_est, bpm, obpm, dbpm, vorp) of players with minutes.

    players: key, player, mp and totals; teams: key, team_mp, poss, opp_poss, pts, opp_pts, gp, league_ortg and totals as
    t_*.  key names one team in one season and kind of season; its roster is one array, some dozens at most."""
    d = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    over = lambda a, b: F.when(b != 0, a / b).otherwise(0.0)
    of_team = ("t_bpm", "t_obpm", "t_season")
    t = teams.where("team_mp > 0 AND poss > 0").withColumn("t_tsa", d("t_fga") + 0.44 * d("t_fta"))
    t = t.withColumn("t_rate", F.coalesce(d("pts_team") / F.nullif(F.col("t_tsa"), F.lit(0.0)), F.lit(POINTS_BASELINE)))
    ortg = 100.0 * d("pts_team") / d("poss")
    net = ortg - 100.0 * d("opp_pts") / F.coalesce(F.nullif(d("opp_poss"), F.lit(0.0)), d("poss"))
    t = t.withColumns({"t_bpm": net, "t_obpm": ortg - d("league_ortg"), "t_season": F.coalesce(F.nullif(d("gp"), F.lit(0.0)), F.lit(82.0)) / 82.0})
    # Totals are doubles without nulls from here on, which keeps the code of the steps after the join short.
    t_totals = [f"t_{k}" for k in POSITION if k != "one"]
    t = t.select(*key, *of_team, "t_rate", "t_tsa", *(d(c).alias(c) for c in ("team_mp", "poss", "pts_team", *t_totals)))
    p = players.where("mp > 0").select(*key, player, *(d(c).alias(c) for c in dict.fromkeys(("mp", "trb", *STATS)))).join(t, key)
    p = p.withColumn("share", F.col("mp") / (F.col("team_mp") / 5.0)).withColumn("tsa", F.col("fga") + 0.44 * F.col("fta")).withColumn("t_per", F.col("poss") * F.col("share"))
    level, context = F.col("t_rate") - THRESHOLD_OFFSET, F.col("t_rate") - POINTS_BASELINE
    above, t_above = (over(F.col("pts"), F.col("tsa")) - level) * F.col("tsa"), F.col("pts_team") - level * F.col("t_tsa")
    pct = lambda k: over(F.col(k), F.col(f"t_{k}") * F.col("share"))
    per100 = lambda c: over(100.0 * F.col(c), F.col("t_per"))
    raw_pos = F.lit(POSITION["one"]) + sum((F.lit(POSITION[k]) * pct(k) for k in ("trb", "stl", "pf", "ast", "blk")), F.lit(0.0))
    raw_role = F.lit(ROLE["one"]) + F.lit(ROLE["ast"]) * pct("ast") + F.lit(ROLE["threshold"]) * over(above, t_above * F.col("share"))
    pulled = lambda raw, prior: (raw * F.col("mp") + prior * PRIOR_MINUTES) / (F.col("mp") + PRIOR_MINUTES)
    per = [(per100(k) - context * per100("tsa") if k == "pts" else per100(k)).alias(k) for k in STATS]
    roster = Window.partitionBy(*key)
    # The JVM compiles no step of over 8,000 bytes of code and runs it many times slower, as Spark does what a list collects:
    # rates are made before, of each row, and ordered, which keeps them apart.
    p = p.select(*key, player, "mp", "share", pulled(raw_pos, PRIOR_POSITION).alias("pos"), pulled(raw_role, PRIOR_ROLE).alias("role"), *per, *of_team)
    one = F.struct(player, "mp", "share", "pos", "role", *STATS)
    # A team's roster as one array: its estimates are brought to the target together, once, and laid out again.
    whole = p.sortWithinPartitions(*key, player).groupBy(*key).agg(F.sort_array(F.collect_list(one)).alias("_all"), *(F.first(c).alias(c) for c in of_team))
    for c in ("pos", "role"):
        whole = whole.withColumn(c, clamp_normalise(F.col(f"_all.{c}"), F.col("_all.mp"), TARGET))
    p = whole.select(*key, *of_team, F.explode(F.arrays_zip("_all", "pos", "role")).alias("_one"))
    p = p.select(*key, *of_team, *(F.col(f"_one._all.{c}").alias(c) for c in (player, "share", *STATS)), "_one.pos", "_one.role")
    for c, of in (("bpm", (OVERALL, OVERALL_ROLE, OVERALL_CONSTANTS)), ("obpm", (OFFENCE, OFFENCE_ROLE, OFFENCE_CONSTANTS))):
        p = p.withColumn(f"raw_{c}", raw_value(F.col, F.col("pos"), F.col("role"), *of))
    for c in ("bpm", "obpm"):
        p = p.withColumn(c, F.col(f"raw_{c}") + (F.col(f"t_{c}") - F.sum(F.col(f"raw_{c}") * F.col("share")).over(roster)) / F.sum("share").over(roster))
    vorp = (F.col("bpm") + 2.0) * F.col("share") * F.col("t_season")
    r = lambda c: F.round(c, 2)
    return p.select(*key, player, r(F.col("pos")).alias("pos_est"), r(F.col("role")).alias("role_est"), r(F.col("bpm")).alias("bpm"), r(F.col("obpm")).alias("obpm"), r(F.col("bpm") - F.col("obpm")).alias("dbpm"), r(vorp).alias("vorp"))


def position_estimate(df: DataFrame, height: str, weight: str, role: str, minutes: str) -> DataFrame:
    """size (from inches and pounds), score, position code, confidence."""
    h, w, r = F.col(height).cast("double"), F.col(weight).cast("double"), F.col(role).cast("double")
    size = F.greatest(F.lit(1.0), F.least(F.lit(5.0), 1.0 + (h - 73.0) / 2.5 + F.coalesce((w - (190.0 + 6.5 * (h - 73.0))) / 75.0, F.lit(0.0))))
    known = (F.coalesce(F.col(minutes), F.lit(0)) >= 1000) & r.isNotNull()
    score = F.coalesce(0.45 * F.col("size") + 0.55 * r, F.col("size"), r)
    cuts = (1.9, 2.7, 3.5, 4.3)
    code = F.when(F.col("pos_score") < cuts[0], "PG").when(F.col("pos_score") < cuts[1], "SG").when(F.col("pos_score") < cuts[2], "SF").when(F.col("pos_score") < cuts[3], "PF").when(F.col("pos_score").isNotNull(), "C")
    margin = F.array_min(F.array(*(F.abs(F.col("pos_score") - c) for c in cuts)))
    sure = F.least(F.lit(1.0), margin / 0.35) * F.when(h.isNull(), 0.6).otherwise(1.0) * F.when(known, 1.0).otherwise(0.7) * F.when(F.abs(F.col("size") - r) > 1, 0.7).otherwise(1.0)
    return df.withColumn("size", size).withColumn("pos_score", score).withColumn("position", code).withColumn("confidence", F.greatest(F.lit(0.05), sure))
