"""Aggregates, pivots, audits, classifiers."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglass.functions import shots
from fieldglass.operators import seasons as S
from fieldglass.plans.registry import BOX, GAMES, TWO, box, by_player, games, line_parts, query, two_teams


@query(f"WITH {BOX} SELECT player, season, kind, count(DISTINCT game) AS gp, sum(mp)::BIGINT AS mp, sum(pts)::BIGINT AS pts, sum(orb)::BIGINT AS orb, sum(tov)::BIGINT AS tov, count(DISTINCT team) AS teams, max(team) AS last_team, min(day) AS first_day, max(day) AS last_day FROM box GROUP BY ALL")
def player_season(t):
    return S.player_season(box(t), ["player", "season", "kind"], ["mp", "pts", "orb", "tov"], "game", "team", "day", line_parts(t))


@query(f"WITH {BOX} SELECT player, season, " + ", ".join(f"coalesce(sum(pts) FILTER (priority = '{p}'), 0)::BIGINT AS \"{p}_pts\", coalesce(sum(mp) FILTER (priority = '{p}'), 0)::BIGINT AS \"{p}_mp\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM")) + " FROM box GROUP BY ALL")
def conditional_pivot(t):
    return S.conditional_pivot(box(t), ["player", "season"], "priority", ["1-URGENT", "2-HIGH", "3-MEDIUM"], {"pts": F.col("pts"), "mp": F.col("mp")})


@query(f"WITH {BOX} SELECT * FROM (PIVOT (SELECT season, kind, mp FROM box) ON kind IN ('F', 'O', 'P') USING sum(mp)::BIGINT GROUP BY season)")
def sql_pivot(t):
    return box(t).groupBy("season").pivot("kind", ["F", "O", "P"]).agg(F.sum("mp"))


@query(f"WITH {TWO}, own AS (SELECT season, team, sum(pts)::BIGINT AS pts, sum(orb)::BIGINT AS orb FROM two GROUP BY ALL), opp AS (SELECT season, opponent AS team, sum(pts)::BIGINT AS opp_pts, sum(orb)::BIGINT AS opp_orb FROM two GROUP BY ALL) SELECT * FROM own JOIN opp USING (season, team)")
def team_season_own_opp(t):
    return S.own_and_opponent(two_teams(t), ["season"], "team", "opponent", ["pts", "orb"]).select("season", "team", "pts", "orb", "opp_pts", "opp_orb")


@query(f"WITH {TWO}, score AS (SELECT season, game, home, away, sum(pts) FILTER (team = home)::BIGINT AS h, sum(pts) FILTER (team = away)::BIGINT AS a FROM two GROUP BY ALL), r AS (SELECT season, home AS team, h AS own, a AS other FROM score UNION ALL SELECT season, away, a, h FROM score) SELECT season, team, count(*) FILTER (own > other) AS wins, count(*) FILTER (own <= other) AS losses, sum(own - other)::BIGINT AS point_diff, round(count(*) FILTER (own > other) / count(*)::DOUBLE, 4) AS win_pct, round(avg(own - other), 3) AS mov FROM r GROUP BY ALL")
def team_records(t):
    two = two_teams(t)
    score = two.groupBy("season", "game", "home", "away").agg(F.sum(F.when(F.col("team") == F.col("home"), F.col("pts"))).alias("h"), F.sum(F.when(F.col("team") == F.col("away"), F.col("pts"))).alias("a"))
    r = S.team_records(score, ["season"], "home", "away", "h", "a")
    return r.withColumn("win_pct", F.round("win_pct", 4)).withColumn("mov", F.round("mov", 3))


_ERAS = [("old", 1900, 1997), ("new", 1998, 2100)]


@query(f"WITH {GAMES} SELECT season, CASE WHEN season < 1998 THEN 'old' ELSE 'new' END AS era, r_name AS division, count(*) AS games FROM games JOIN customer ON c_custkey = entity JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL")
def era_lookup(t):
    """Division by era from a dimension of eras."""
    spark = t("nation").sparkSession
    eras = spark.createDataFrame(_ERAS, "era string, low bigint, high bigint")
    where = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    g = games(t).join(where, F.col("entity") == F.col("c_custkey"))
    g = g.join(F.broadcast(eras), (F.col("season") >= F.col("low")) & (F.col("season") <= F.col("high")))  # two rows
    return g.groupBy("season", "era", F.col("r_name").alias("division")).agg(F.count(F.lit(1)).alias("games"))


_ZONE_SQL = """CASE WHEN sqrt(x*x + y*y) / 10 <= 4 THEN 'ra' WHEN v = 2 AND abs(x) <= 80 AND y <= 142.5 THEN 'paint' WHEN v = 2 AND sqrt(x*x + y*y) / 10 <= 14 THEN 'short_mid'
WHEN v = 2 THEN CASE WHEN degrees(atan2(y, x)) < 60 THEN 'long_mid_r' WHEN degrees(atan2(y, x)) > 120 THEN 'long_mid_l' ELSE 'long_mid_c' END
WHEN abs(x) >= 220 AND y <= 92.5 THEN CASE WHEN x < 0 THEN 'c3_l' ELSE 'c3_r' END WHEN sqrt(x*x + y*y) / 10 >= 30 THEN 'heave'
WHEN degrees(atan2(y, x)) < 60 THEN 'atb_r' WHEN degrees(atan2(y, x)) > 120 THEN 'atb_l' ELSE 'atb_top' END"""


@query(f"WITH {BOX}, s AS (SELECT ((player * 37) % 501 - 250)::DOUBLE AS x, (mp * 7 - 40)::DOUBLE AS y, CASE WHEN flag = 'R' THEN 3 ELSE 2 END AS v, pts FROM box) SELECT {_ZONE_SQL} AS zone, count(*) AS shots, sum(pts)::BIGINT AS pts FROM s GROUP BY ALL")
def zone_classifier(t):
    s = box(t).select(((F.col("player") * 37) % 501 - 250).cast("double").alias("x"), (F.col("mp") * 7 - 40).cast("double").alias("y"), F.when(F.col("flag") == "R", 3).otherwise(2).alias("v"), "pts")
    return s.groupBy(shots.shot_zone(F.col("x"), F.col("y"), F.col("v")).alias("zone")).agg(F.count(F.lit(1)).alias("shots"), F.sum("pts").alias("pts"))


@query("SELECT user_id, CASE WHEN event_type IN ('click', 'view') THEN 'look' WHEN event_type = 'purchase' THEN 'buy' ELSE 'other' END AS bucket, count(*) AS n, count(*) FILTER (event_type = 'error') AS errors FROM events GROUP BY ALL")
def bucket_classifier(t):
    b = shots.bucket(F.col("event_type"), {"look": ("click", "view"), "buy": ("purchase",)})
    return t("events").groupBy("user_id", b.alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query(f"WITH {BOX} SELECT player, day, game, line, team, mp, pts, round(date_diff('day', DATE '1970-01-01', day) / 365.25, 2) AS age FROM box")
def game_log(t):
    return box(t).select("player", "day", "game", "line", "team", "mp", "pts", F.round(F.datediff("day", F.lit("1970-01-01").cast("date")) / 365.25, 2).alias("age"))


@query("SELECT c_custkey AS id, coalesce(nullif(c_name, ''), n_name) AS name, n_name AS nation, coalesce(n.games, 0) AS career_games, coalesce(f.games, 0) AS career_regular FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN (SELECT o_custkey, count(*) AS games FROM orders GROUP BY 1) n ON n.o_custkey = c_custkey LEFT JOIN (SELECT o_custkey, count(*) AS games FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) f ON f.o_custkey = c_custkey")
def registry_coalesce(t):
    """A registry with both definitions of career games: all kinds, and regular alone."""
    n = t("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("all_games"), F.count_if(F.col("o_orderstatus") == "F").alias("regular"))
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").join(n, F.col("c_custkey") == F.col("o_custkey"), "left")
    zero = F.lit(0).cast("bigint")
    return c.select(F.col("c_custkey").alias("id"), F.coalesce(F.nullif("c_name", F.lit("")), "n_name").alias("name"), F.col("n_name").alias("nation"), F.coalesce("all_games", zero).alias("career_games"), F.coalesce("regular", zero).alias("career_regular"))


@query("WITH a AS (SELECT l_orderkey AS game, sum(round(l_extendedprice * 100)::BIGINT)::BIGINT AS v FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS game, round(o_totalprice * 100)::BIGINT AS v FROM orders) SELECT game, a.v AS a_value, b.v AS b_value, coalesce(a.v, 0) - coalesce(b.v, 0) AS diff, abs(coalesce(a.v, 0) - coalesce(b.v, 0)) <= greatest(5.0::DOUBLE, coalesce(b.v, 0) * 0.1::DOUBLE) AS ok, round(coalesce(a.v, 0) / nullif(coalesce(b.v, 0)::DOUBLE, 0), 4) AS ratio FROM a FULL JOIN b USING (game)")
def full_outer_reconcile(t):
    a = t("lineitem").groupBy(F.col("l_orderkey").alias("game")).agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("v"))
    return S.reconcile(a, games(t).select("game", F.col("cents").alias("v")), ["game"], "v").withColumn("ratio", F.round("ratio", 4))


@query(f"WITH {GAMES} SELECT season, count(*) FILTER (kind = 'F') AS f, count(*) FILTER (priority = '1-URGENT') AS urgent, sum(cents) FILTER (kind = 'O')::BIGINT AS open_cents, count(DISTINCT entity) FILTER (kind <> 'P') AS entities FROM games GROUP BY 1")
def filter_aggregates(t):
    return games(t).groupBy("season").agg(F.count_if(F.col("kind") == "F").alias("f"), F.count_if(F.col("priority") == "1-URGENT").alias("urgent"), F.sum(F.when(F.col("kind") == "O", F.col("cents"))).alias("open_cents"), F.count_distinct(F.when(F.col("kind") != "P", F.col("entity"))).alias("entities"))


@query(f"WITH {GAMES} SELECT entity, arg_max(kind, (day, game)) AS last_kind, arg_min(priority, (day, game)) AS first_priority FROM games GROUP BY 1")
def arg_max_latest(t):
    return games(t).groupBy("entity").agg(F.max_by("kind", F.struct("day", "game")).alias("last_kind"), F.min_by("priority", F.struct("day", "game")).alias("first_priority"))


@query(f"WITH {BOX} SELECT game, string_agg(DISTINCT flag, ',' ORDER BY flag) AS flags, string_agg(line || ':' || player, ';' ORDER BY line, player, team) AS moves FROM box GROUP BY 1")
def string_agg_moves(t):
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line", "player", "team"))), lambda x: F.concat_ws(":", x["line"].cast("string"), x["player"].cast("string")))
    return box(t).groupBy("game").agg(F.array_join(F.array_sort(F.collect_set("flag")), ",").alias("flags"), F.array_join(ordered, ";").alias("moves"))


@query(f"WITH {GAMES} SELECT entity, array_to_string(list(strftime(day, '%Y-%m-%d') ORDER BY day, game), ',') AS days, len(list(DISTINCT season)) AS seasons, array_to_string(list(DISTINCT kind ORDER BY kind), ',') AS kinds FROM games GROUP BY 1")
def ordered_lists(t):
    days = F.transform(F.array_sort(F.collect_list(F.struct("day", "game"))), lambda x: x["day"].cast("string"))
    return games(t).groupBy("entity").agg(F.array_join(days, ",").alias("days"), F.size(F.collect_set("season")).cast("bigint").alias("seasons"), F.array_join(F.array_sort(F.collect_set("kind")), ",").alias("kinds"))


@query("SELECT l_orderkey AS game, l_linenumber::BIGINT AS line, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def having_duplicates(t):
    return t("lineitem").groupBy(F.col("l_orderkey").alias("game"), F.col("l_linenumber").cast("bigint").alias("line")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


@query(f"WITH {TWO}, g AS (SELECT season, game, team, opponent, sum(pts)::BIGINT AS pts FROM two GROUP BY ALL) SELECT a.season, a.team, count(*) AS games, sum(a.pts)::BIGINT AS pts, sum(b.pts)::BIGINT AS opp_pts FROM g a JOIN g b ON a.game = b.game AND a.team <> b.team GROUP BY ALL")
def self_join_opponent(t):
    g = two_teams(t).groupBy("season", "game", "team").agg(F.sum("pts").alias("pts"))
    other = g.select("game", F.col("team").alias("opponent"), F.col("pts").alias("other"))
    return g.join(other, "game").where("team <> opponent").groupBy("season", "team").agg(F.count(F.lit(1)).alias("games"), F.sum("pts").alias("pts"), F.sum("other").alias("opp_pts"))


@query(f"WITH {BOX} SELECT player, round(sum(pts * mp)::DOUBLE / sum(mp), 2) AS mean, round(stddev_pop(pts), 2) AS sd, max(pts) - min(pts) AS spread, count(pts) AS n FROM box GROUP BY 1")
def consensus_view(t):
    return S.consensus(box(t), ["player"], "pts", "mp").withColumn("mean", F.round("mean", 2)).withColumn("sd", F.round("sd", 2))


@query(f"WITH {BOX}, c AS (SELECT player, team, pts * count(*) OVER (PARTITION BY player) - sum(pts) OVER (PARTITION BY player) AS gap FROM box) SELECT player, team, sum(gap)::BIGINT AS gap, count(*) AS n FROM c GROUP BY ALL HAVING abs(sum(gap)) > 10000000")
def disagreement(t):
    """A team's gap from the player's mean, times the player's lines: whole numbers."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("player")
    c = by_player(t).withColumn("gap", F.col("pts") * F.count(F.lit(1)).over(w) - F.sum("pts").over(w))
    return c.groupBy("player", "team").agg(F.sum("gap").alias("gap"), F.count(F.lit(1)).alias("n")).where("abs(gap) > 10000000")


@query(f"WITH {BOX}, on_ AS (SELECT kind, player, sum(pts)::DOUBLE AS v, sum(mp)::DOUBLE AS w FROM box GROUP BY ALL), st AS (SELECT DISTINCT kind, game, line, team, player, pts, mp FROM box), tot AS (SELECT kind, sum(pts)::DOUBLE AS v, sum(mp)::DOUBLE AS w FROM st GROUP BY 1) SELECT kind, player, round(o.v / o.w, 4) AS on_rate, round((t.v - o.v) / (t.w - o.w), 4) AS off_rate, round(o.v / o.w - (t.v - o.v) / (t.w - o.w), 4) AS diff FROM on_ o JOIN tot t USING (kind) WHERE o.w >= 20 AND t.w - o.w >= 20")
def onoff_split(t):
    on = box(t).withColumn("stint", F.struct("game", "line", "team", "player", "pts", "mp"))
    got = S.on_off(on.select("kind", "player", "stint", F.col("pts").cast("double").alias("pts"), F.col("mp").cast("double").alias("mp")), ["kind"], "player", "pts", "mp", 20)
    return got.select("kind", "player", *(F.round(c, 4).alias(c) for c in ("on_rate", "off_rate", "diff")))


@query(f"WITH {BOX} SELECT team, sum(CASE WHEN flag = 'R' THEN mp ELSE 0 END)::DOUBLE / sum(mp) AS r_share, sum(mp)::BIGINT AS r_known, round(sum(CASE WHEN flag <> 'N' AND status = 'O' THEN mp ELSE 0 END)::DOUBLE / nullif(sum(CASE WHEN flag <> 'N' THEN mp ELSE 0 END), 0), 6) AS o_share, sum(CASE WHEN flag <> 'N' THEN mp ELSE 0 END)::BIGINT AS o_known FROM box GROUP BY 1".replace("sum(CASE WHEN flag = 'R' THEN mp ELSE 0 END)::DOUBLE / sum(mp) AS", "round(sum(CASE WHEN flag = 'R' THEN mp ELSE 0 END)::DOUBLE / sum(mp), 6) AS"))
def weighted_shares(t):
    tests = {"r": F.col("flag") == "R", "o": F.when(F.col("flag") != "N", F.col("status") == "O")}
    got = S.weighted_shares(box(t), ["team"], "mp", tests)
    return got.select("team", F.round("r_share", 6).alias("r_share"), "r_known", F.round("o_share", 6).alias("o_share"), "o_known")


_UNIT = "u AS (SELECT game, max(season) AS season, sum(pts)::BIGINT AS pts, list_sort(list(DISTINCT player)) AS m FROM box GROUP BY game)"


def _units(t):
    return box(t).groupBy("game").agg(F.max("season").alias("season"), F.sum("pts").alias("pts"), F.array_sort(F.collect_set("player")).alias("m"))


@query(f"WITH {BOX}, {_UNIT}, e AS (SELECT season, pts, m, unnest(range(1, 1 << len(m))) AS mask FROM u), s AS (SELECT season, pts, list_filter(list_transform(range(1, len(m) + 1), lambda i: CASE WHEN (mask >> (i - 1)) & 1 = 1 THEN m[i] END), lambda x: x IS NOT NULL) AS s FROM e WHERE bit_count(mask) BETWEEN 2 AND 5) SELECT season, array_to_string(s, '-') AS unit, len(s)::BIGINT AS size, sum(pts)::BIGINT AS pts FROM s GROUP BY ALL")
def combination_lattice(t):
    """All subsets of two to five of all the players of a game."""
    return S.lattice(_units(t), ["season"], "m", ["pts"]).withColumn("size", F.col("size").cast("bigint"))


@query(f"WITH {BOX}, {_UNIT} SELECT season, array_to_string(m, '-') AS unit, count(*) AS games, sum(pts)::BIGINT AS pts FROM u GROUP BY ALL")
def unit_aggregation(t):
    """Games and points of every unit, which is all the players of a game."""
    return _units(t).groupBy("season", F.array_join(F.col("m").cast("array<string>"), "-").alias("unit")).agg(F.count(F.lit(1)).alias("games"), F.sum("pts").alias("pts"))


@query(f"WITH {BOX}, v AS (SELECT player, flag AS to_, count(*) AS votes FROM box GROUP BY ALL), r AS (SELECT *, sum(votes) OVER (PARTITION BY player)::BIGINT AS total, row_number() OVER (PARTITION BY player ORDER BY votes DESC, to_) AS rn FROM v) SELECT player, to_ AS flag, votes, total, round(least(1.0, 0.5 + votes / 20.0::DOUBLE), 4) AS confidence FROM r WHERE rn = 1 AND votes >= total * 0.5")
def majority_vote(t):
    return S.majority(box(t).select("player", "flag"), "player", "flag", 0.5).withColumn("confidence", F.round("confidence", 4))


@query(f"WITH {BOX}, m AS (SELECT game, team, sum(mp) * 5 AS minutes FROM box GROUP BY ALL) SELECT game, greatest(0, round((max(minutes) - 240) / 25.0::DOUBLE))::BIGINT AS overtimes FROM m GROUP BY 1")
def overtime_from_minutes(t):
    m = box(t).groupBy("game", "team").agg((F.sum("mp") * 5).alias("minutes"))
    return m.groupBy("game").agg(S.overtimes(F.max("minutes")).alias("overtimes"))


@query(f"WITH {GAMES}, p AS (SELECT *, month(day) >= 11 AND kind = 'P' AS po FROM games), first AS (SELECT season, min(day) AS f FROM p WHERE po GROUP BY 1), by_day AS (SELECT season, day, count(*) AS n FROM p GROUP BY ALL), dense AS (SELECT season, max(day) AS l FROM by_day JOIN first USING (season) WHERE day < f AND n >= 5 GROUP BY 1) SELECT game, CASE WHEN po THEN 'playoff' WHEN p.day > l AND p.day < f THEN 'playin' WHEN month(p.day) = 12 AND n = 1 THEN 'tournament' ELSE 'regular' END AS kind FROM p LEFT JOIN first USING (season) LEFT JOIN dense USING (season) JOIN by_day USING (season, day)")
def season_type_classifier(t):
    p = games(t).drop("kind").join(games(t).select("game", (F.month("day") >= 11).alias("late"), (F.col("kind") == "P").alias("p")), "game").withColumn("po", F.col("late") & F.col("p"))
    return S.season_types(p, "season", "day", "po").select("game", "kind")


@query(f"WITH {GAMES}, first AS (SELECT season, min(day) AS f FROM games WHERE kind = 'P' AND month(day) >= 6 GROUP BY 1) SELECT game, season, day FROM games JOIN first USING (season) WHERE kind = 'F' AND day > f")
def misfiled_games(t):
    first = games(t).where("kind = 'P' AND month(day) >= 6").groupBy("season").agg(F.min("day").alias("f"))
    return games(t).where("kind = 'F'").join(first, "season").where("day > f").select("game", "season", "day")


@query(f"WITH {BOX} SELECT season, count(*) AS rows, count(DISTINCT player) AS entities FROM box GROUP BY 1")
def manifest(t):
    """The manifest's counts; the document itself is JSON of these rows."""
    from fieldglass.sources import lake

    text = lake.manifest(box(t), "season", "player")
    rows = F.from_json("manifest", "array<struct<season: bigint, rows: bigint, entities: bigint>>")
    return text.select(F.inline(rows))


@query(f"WITH {BOX}, a AS (SELECT season, count(*) AS lines, count(DISTINCT game) AS games, sum(pts)::BIGINT AS pts FROM box GROUP BY 1), o AS (SELECT season, count(*) AS all_games, sum(cents)::BIGINT AS cents FROM games GROUP BY 1) SELECT season, lines, games, all_games, round(pts / cents::DOUBLE, 4) AS ratio FROM a JOIN o USING (season)")
def audit_report(t):
    a = box(t).groupBy("season").agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("game").alias("games"), F.sum("pts").alias("pts"))
    o = games(t).groupBy("season").agg(F.count(F.lit(1)).alias("all_games"), F.sum("cents").alias("cents"))
    return a.join(o, "season").select("season", "lines", "games", "all_games", F.round(F.col("pts") / F.col("cents"), 4).alias("ratio"))


@query(f"WITH {TWO}, s AS (SELECT game, team, opponent, flag FROM two) SELECT team, count(*) FILTER (flag = 'R') AS own_r, count(*) AS own FROM s GROUP BY 1")
def both_ends_shots(t):
    return two_teams(t).groupBy("team").agg(F.count_if(F.col("flag") == "R").alias("own_r"), F.count(F.lit(1)).alias("own"))


@query(f"WITH {GAMES} SELECT entity, season, count(*) FILTER (kind = 'F') AS wins, count(*) FILTER (kind = 'O') AS losses, coalesce(arg_max(priority, (day, game)) FILTER (kind = 'P'), 'none') AS finish, coalesce(max(priority) FILTER (kind = 'P') = '5-LOW', false) AS champion FROM games GROUP BY ALL")
def history_finish(t):
    last = F.max_by(F.when(F.col("kind") == "P", F.col("priority")), F.when(F.col("kind") == "P", F.struct("day", "game")))
    return games(t).groupBy("entity", "season").agg(F.count_if(F.col("kind") == "F").alias("wins"), F.count_if(F.col("kind") == "O").alias("losses"), F.coalesce(last, F.lit("none")).alias("finish"), F.coalesce(F.max(F.when(F.col("kind") == "P", F.col("priority"))) == "5-LOW", F.lit(False)).alias("champion"))


@query(f"WITH {TWO} SELECT a.player AS attacker, b.player AS defender, count(*) AS meetings, sum(a.pts)::BIGINT AS pts FROM two a JOIN two b ON a.game = b.game AND a.team < b.team GROUP BY ALL")
def matchup_pairs(t):
    a = two_teams(t).select("game", "team", F.col("player").alias("attacker"), "pts")
    b = two_teams(t).select("game", F.col("team").alias("other"), F.col("player").alias("defender"))
    return a.join(b, "game").where("team < other").groupBy("attacker", "defender").agg(F.count(F.lit(1)).alias("meetings"), F.sum("pts").alias("pts"))


@query(f"WITH {BOX}, r AS (SELECT team, season, count(DISTINCT game) AS gp, sum(mp) AS mp, sum(pts) AS pts, sum(tov + 10) AS poss FROM box GROUP BY ALL) SELECT team, season, pts::DOUBLE AS total, round(pts / gp::DOUBLE, 3) AS per_game, round(pts / (mp / 36.0::DOUBLE), 3) AS per_36, round(pts / (poss / 100.0::DOUBLE), 3) AS per_100 FROM r")
def rate_modes(t):
    r = box(t).groupBy("team", "season").agg(F.count_distinct("game").alias("gp"), F.sum("mp").alias("mp"), F.sum("pts").alias("pts"), F.sum(F.col("tov") + 10).alias("poss"))
    rate = lambda m: shots.per(F.col("pts"), m, F.col("gp"), F.col("mp"), F.col("poss"))
    return r.select("team", "season", rate("total").alias("total"), F.round(rate("game"), 3).alias("per_game"), F.round(rate("36"), 3).alias("per_36"), F.round(rate("100"), 3).alias("per_100"))


@query(f"WITH {BOX} SELECT player, count(DISTINCT season) AS seasons, min(season) AS first_season, max(season) AS last_season, count(*) AS career_gp, sum(pts)::BIGINT AS career_pts FROM box WHERE mp > 1 GROUP BY 1")
def career_box(t):
    """Careers of box lines that were played, of seasons of all kinds."""
    return S.career(box(t).where("mp > 1"), "player", "season", F.lit(1), F.col("pts"))


@query(f"WITH {BOX}, s AS (SELECT player, season, kind, count(DISTINCT game) AS gp, sum(pts)::BIGINT AS pts FROM box GROUP BY ALL) SELECT player, count(DISTINCT season) AS seasons, min(season) AS first_season, max(season) AS last_season, sum(gp)::BIGINT AS career_gp, sum(pts)::BIGINT AS career_pts FROM s WHERE kind = 'F' GROUP BY 1")
def career_regular(t):
    """Careers of season rows of the regular kind alone."""
    s = by_player(t).groupBy("player", "season", "kind").agg(F.count_distinct("game").alias("gp"), F.sum("pts").alias("pts"))
    return S.career(s.where("kind = 'F'"), "player", "season", F.col("gp"), F.col("pts"))
