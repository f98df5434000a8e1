"""Bridges, reports, coverage, staging, thresholds, predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from fieldglass.operators import service as V
from fieldglass.plans.registry import BOX, GAMES, TWO, box, games, query, two_teams


@query(f"WITH {TWO} SELECT game, home, away, sum(pts) FILTER (team = home)::BIGINT AS home_score, sum(pts) FILTER (team = away)::BIGINT AS away_score FROM (SELECT game, 'S' || home AS home, 'S' || away AS away, 'S' || team AS team, pts FROM two) GROUP BY ALL")
def games_from_lines(t):
    two = two_teams(t)
    text = F.when(F.col("team") == F.col("home"), F.concat(F.lit("S"), "home", F.lit(" vs. S"), "away")).otherwise(F.concat(F.lit("S"), "away", F.lit(" @ S"), "home"))
    return V.games_from_lines(two.select("game", "pts", text.alias("match")), "game", "match", "pts")


_BRIDGE = f"WITH {GAMES}, a AS (SELECT day, least(entity % 12, game % 12) AS x, greatest(entity % 12, game % 12) AS y, min(game) AS a_id FROM games WHERE kind <> 'P' GROUP BY ALL HAVING count(*) = 1), b AS (SELECT day, least(entity % 12, game % 12) AS x, greatest(entity % 12, game % 12) AS y, min(game) + 7 AS b_id FROM games WHERE kind <> 'O' GROUP BY ALL HAVING count(*) = 1)"


@query(f"{_BRIDGE} SELECT a_id, b_id FROM a JOIN b USING (day, x, y)")
def bridge_games(t):
    g = games(t).withColumn("x", F.col("entity") % 12).withColumn("y", F.col("game") % 12)
    a = g.where("kind <> 'P'").select("day", "x", "y", F.col("game").alias("a_id"))
    b = g.where("kind <> 'O'").select("day", F.col("y").alias("x"), F.col("x").alias("y"), (F.col("game") + 7).alias("b_id"))
    return V.bridge_games(a, b, "day", ["x", "y"], "a_id", "b_id")


@query(f"WITH {BOX}, a AS (SELECT DISTINCT ON (game, player) game, player AS a_id, tov, orb, mp FROM box ORDER BY game, player, line, team, pts), b AS (SELECT game, a_id + 1000000 AS b_id, tov, orb, mp + a_id % 2 AS mp FROM a WHERE a_id % 17 <> 0), d AS (SELECT game, a_id, b_id, abs(a.mp - b.mp) AS distance FROM a JOIN b USING (game, tov, orb)), r AS (SELECT *, row_number() OVER w AS place, lead(distance) OVER w AS second FROM d WINDOW w AS (PARTITION BY game, a_id ORDER BY distance, b_id)), v AS (SELECT a_id, b_id, count(*) AS votes FROM r WHERE place = 1 AND distance <= 90 AND (second IS NULL OR second - distance >= 30) GROUP BY ALL), s AS (SELECT *, sum(votes) OVER (PARTITION BY a_id)::BIGINT AS total, row_number() OVER (PARTITION BY a_id ORDER BY votes DESC, b_id) AS rn FROM v) SELECT a_id, b_id, votes, total, round(least(1.0, 0.5 + votes / 20.0::DOUBLE), 4) AS confidence FROM s WHERE rn = 1 AND votes >= total * 0.8::DOUBLE")
def fingerprint_bridge(t):
    from fieldglass.operators.windows import latest

    a = latest(box(t), ["game", "player"], [F.col(c) for c in ("line", "team", "pts")]).select("game", F.col("player").alias("a_id"), "tov", "orb", "mp")
    b = a.where("a_id % 17 <> 0").select("game", (F.col("a_id") + 1000000).alias("b_id"), "tov", "orb", (F.col("mp") + F.col("a_id") % 2).alias("mp"))
    return V.fingerprint_bridge(a, b, ["game"], ["tov", "orb"], "a_id", "b_id", "mp").withColumn("confidence", F.round("confidence", 4))


@query(f"WITH {GAMES}, r AS (SELECT entity, season, day, game, kind = 'P' AS pending FROM games) SELECT entity, season, game, pending FROM r QUALIFY dense_rank() OVER (PARTITION BY entity, season ORDER BY pending, day DESC) = 1")
def settled_reports(t):
    r = games(t).select("entity", "season", "day", "game", (F.col("kind") == "P").alias("pending"))
    return V.settled_reports(r, "entity", "season", "day", "pending").drop("day")


@query(f"WITH {GAMES}, w AS (SELECT DISTINCT season, entity FROM games), h AS (SELECT DISTINCT season, entity FROM games WHERE kind = 'F') SELECT w.season, w.entity, CASE WHEN a.season IS NOT NULL THEN 'exact' WHEN b.season IS NOT NULL THEN 'fallback' ELSE 'missing' END AS coverage FROM w LEFT JOIN h a ON a.season = w.season AND a.entity = w.entity LEFT JOIN h b ON b.season = w.season - 1 AND b.entity = w.entity")
def asset_coverage(t):
    w = games(t).select("season", "entity").distinct()
    return V.asset_coverage(w, games(t).where("kind = 'F'"), "season", "entity")


@query(f"WITH {GAMES} SELECT entity, priority, min(game) AS game, count(*) AS occurrences FROM games GROUP BY ALL")
def staging_dedupe(t):
    return V.staged(games(t), ["entity", "priority"], "game")


@query(f"WITH {GAMES}, n AS (SELECT game, CASE WHEN game % 5 = 0 THEN NULL ELSE 'N' || kind END AS kind FROM games WHERE game % 2 = 0) SELECT g.game, coalesce(n.kind, g.kind) AS kind, coalesce(n.kind, g.kind) IS DISTINCT FROM g.kind AS changed FROM games g LEFT JOIN n USING (game)")
def update_from_join(t):
    n = games(t).where("game % 2 = 0").select("game", F.when(F.col("game") % 5 != 0, F.concat(F.lit("N"), "kind")).alias("kind"))
    return V.updated(games(t).select("game", "kind"), n, ["game"], ["kind"])


@query(f"WITH {GAMES} SELECT game, day < DATE '1997-01-01' AND game NOT IN (SELECT game FROM games WHERE kind = 'F') AS goes FROM games")
def delete_stale(t):
    stays, goes = V.split_stale(games(t).select("game", "day"), games(t).where("kind = 'F'"), ["game"], F.col("day") < F.lit("1997-01-01").cast("date"))
    return stays.select("game", F.lit(False).alias("goes")).unionByName(goes.select("game", F.lit(True).alias("goes")))


@query(f"WITH {BOX} SELECT player, season, sum(mp)::BIGINT AS mp, round(sum(tov * mp)::DOUBLE / sum(mp), 5) AS tov, round(sum(orb * mp)::DOUBLE / sum(mp), 5) AS orb FROM box GROUP BY ALL")
def traded_rates(t):
    return V.additive_rates(box(t), ["player", "season"], ["tov", "orb"], "mp").select("player", "season", "mp", F.round("tov", 5).alias("tov"), F.round("orb", 5).alias("orb"))


@query(f"WITH {BOX}, c AS (SELECT unnest([5.0, 10.0, 20.0, 25.5, 40.0])::DOUBLE AS cut) SELECT cut, count(*) FILTER ((mp >= cut) = (flag = 'R')) AS right, count(*) AS n FROM box, c GROUP BY cut")
def threshold_grid(t):
    return V.best_cut(box(t).withColumn("label", F.col("flag") == "R"), "mp", "label", [5.0, 10.0, 20.0, 25.5, 40.0])


@query("WITH e AS (SELECT item_id, unnest(string_split('a' || item_id || ':' || item_id % 5 || ', b : x, c:' || item_id, ', ')) AS entry, generate_subscripts(string_split('a,b,c', ','), 1) - 1 AS position FROM benchmark) SELECT item_id, position::INTEGER AS position, CASE WHEN regexp_matches(entry, '^([^:]+):\\s*(\\d+)$') THEN regexp_extract(entry, '^([^:]+):', 1) END AS name, CASE WHEN regexp_matches(entry, '^([^:]+):\\s*(\\d+)$') THEN regexp_extract(entry, '(\\d+)$', 1)::BIGINT END AS tier, regexp_matches(entry, '^([^:]+):\\s*(\\d+)$') AS ok FROM e")
def tier_list(t):
    i = F.col("item_id").cast("string")
    text = F.concat(F.lit("a"), i, F.lit(":"), (F.col("item_id") % 5).cast("string"), F.lit(", b : x, c:"), i)
    return V.tier_list(t("benchmark").select("item_id", text.alias("list")), "item_id", "list")


@query(f"WITH {GAMES}, l AS (SELECT * FROM games QUALIFY row_number() OVER (PARTITION BY entity, season ORDER BY day DESC, game DESC) = 1) SELECT entity AS player_id, season AS scout_id, cents, coalesce(CASE WHEN season % 3 > 0 THEN (season % 3)::DOUBLE END, 1.0) AS help_weight FROM l")
def points_view(t):
    a = games(t).select(F.col("entity").alias("player_id"), F.col("season").alias("scout_id"), F.col("day").alias("report_date"), F.col("game").alias("report_id"), "cents")
    scouts = a.select("scout_id").distinct().withColumn("help_weight", F.when(F.col("scout_id") % 3 > 0, (F.col("scout_id") % 3).cast("double")))
    return V.points_view(a, scouts).select("player_id", "scout_id", "cents", "help_weight")


@query("SELECT p_partkey AS id, p_name ILIKE '%a%' AS has_a, lower(p_type) LIKE '%o%' AS has_o, p_size BETWEEN 10 AND 20 AS mid, p_brand IN ('Brand#11', 'Brand#12') AS listed FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)")
def predicates(t):
    p = t("part").join(t("lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey")), "p_partkey", "left_anti")
    return p.select(F.col("p_partkey").alias("id"), F.col("p_name").ilike("%a%").alias("has_a"), F.lower("p_type").like("%o%").alias("has_o"), F.col("p_size").between(10, 20).alias("mid"), F.col("p_brand").isin("Brand#11", "Brand#12").alias("listed"))
