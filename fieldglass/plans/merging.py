"""Merges of what arrives into what is there, changes, keys, sources."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from fieldglass.operators import merge as M
from fieldglass.operators import identity as I
from fieldglass.plans.registry import BOX, GAMES, box, games, query
from fieldglass.sources import lake, schedule

_OLD = "old AS (SELECT game, entity, kind, cents, day FROM games WHERE game % 3 <> 0), new AS (SELECT game, entity, 'N' AS kind, CASE WHEN game % 7 = 0 THEN NULL ELSE cents + 1 END AS cents, day FROM games WHERE game % 2 = 0)"


def _old(t):
    return games(t).where("game % 3 <> 0").select("game", "entity", "kind", "cents", "day")


def _new(t):
    return games(t).where("game % 2 = 0").select("game", "entity", F.lit("N").alias("kind"), F.when(F.col("game") % 7 != 0, F.col("cents") + 1).alias("cents"), "day")


@query(f"WITH {GAMES}, {_OLD} SELECT * FROM old UNION ALL SELECT * FROM new WHERE game NOT IN (SELECT game FROM old)")
def insert_ignore(t):
    return M.insert_ignore(_old(t), _new(t).union(_new(t)), ["game"], [F.col("cents")])


@query(f"WITH {GAMES}, {_OLD} SELECT * FROM old WHERE game NOT IN (SELECT game FROM new) UNION ALL SELECT * FROM new")
def upsert(t):
    return M.upsert(_old(t), _new(t), ["game"], [F.col("cents").desc()])


@query(f"WITH {GAMES}, {_OLD} SELECT game, coalesce(n.cents, o.cents) AS cents, coalesce(o.kind, n.kind) AS kind, coalesce(o.entity, n.entity) AS entity FROM old o FULL JOIN new n USING (game)")
def upsert_coalesce(t):
    return M.upsert_filling(_old(t), _new(t), ["game"], ["cents"], ["kind", "entity"])


@query(f"WITH {GAMES}, {_OLD} SELECT * FROM old WHERE year(day) NOT IN (SELECT year(day) FROM new WHERE year(day) < 1998) UNION ALL SELECT * FROM new WHERE year(day) < 1998")
def replace_slice(t):
    year = lambda df: df.withColumn("year", F.year("day"))
    return M.replace_slices(year(_old(t)), year(_new(t)).where("year < 1998"), ["year"]).drop("year")


@query(f"WITH {GAMES}, {_OLD}, k AS (SELECT DISTINCT entity, year(day) AS y FROM new) SELECT o.* FROM old o WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.entity = o.entity AND k.y = year(o.day)) UNION ALL SELECT * FROM new")
def merge_changed_seasons(t):
    """Career files: every season of an entity that the new rows cover is replaced."""
    year = lambda df: df.withColumn("year", F.year("day"))
    return M.replace_slices(year(_old(t)), year(_new(t)), ["entity", "year"]).drop("year")


@query(f"WITH {GAMES}, {_OLD}, b AS (SELECT entity, game, cents FROM old), a AS (SELECT entity, game, CASE WHEN game % 11 = 0 THEN cents + 5 ELSE cents END AS cents FROM old WHERE game % 13 <> 0) SELECT DISTINCT entity FROM ((SELECT * FROM b EXCEPT ALL SELECT * FROM a) UNION ALL (SELECT * FROM a EXCEPT ALL SELECT * FROM b))")
def changed_entities(t):
    b = _old(t).select("entity", "game", "cents")
    a = b.where("game % 13 <> 0").withColumn("cents", F.when(F.col("game") % 11 == 0, F.col("cents") + 5).otherwise(F.col("cents")))
    return M.changed_keys(b, a, ["entity"])


@query(f"WITH {GAMES}, h AS (SELECT md5(game || '|' || entity || '|' || kind || '|' || cents) AS h FROM games) SELECT count(*) AS rows, sum(('0x' || substr(h, 1, 8))::BIGINT)::BIGINT AS low, sum(('0x' || substr(h, 9, 8))::BIGINT)::BIGINT AS high FROM h")
def fingerprint(t):
    return M.fingerprint(games(t), ["game", "entity", "kind", "cents"])


@query("SELECT c_custkey AS id, 'P' || lpad((1000 + row_number() OVER (ORDER BY c_custkey))::VARCHAR, 8, '0') AS player_id FROM customer")
def surrogate_ids(t):
    new = t("customer").select(F.col("c_custkey").alias("id"))
    return M.surrogate_ids(new, 1000, "id", "player_id")


@query(f"WITH {GAMES} SELECT game, substr(md5(strftime(day, '%Y-%m-%d') || '|' || entity || '|' || priority), 1, 16) AS key FROM games")
def content_hash(t):
    return games(t).select("game", M.content_hash(F.col("day").cast("string"), F.col("entity").cast("string"), F.col("priority")).alias("key"))


@query(f"WITH {GAMES} SELECT game, entity, season, CASE WHEN season < 1998 THEN NULL ELSE priority END AS priority FROM games")
def hot_cold_union(t):
    """Seasons before 1998 come from an archive without a column that the hot table has."""
    cold = games(t).where("season < 1998").select("game", "entity", "season")
    return lake.hot_and_cold(cold, games(t).where("season >= 1998").select("game", "entity", "season", "priority"))


@query(f"WITH {GAMES} SELECT game, NULL::VARCHAR AS assist FROM games")
def optional_source(t):
    """A left join to a table that isn't there."""
    g = games(t).select("game")
    return g.join(lake.optional(None, g.sparkSession, "game bigint, assist string"), "game", "left")


@query("SELECT event_id, (props->>'k')::BIGINT AS k FROM events")
def json_flatten(t):
    return lake.flattened(t("events").select("event_id", "props"), "props", "k bigint").drop("props")


@query("SELECT l_orderkey AS game, l_linenumber::BIGINT AS line, metric, round(value, 2) AS value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME metric VALUE value)")
def long_unpivot(t):
    lines = t("lineitem").select(F.col("l_orderkey").alias("game"), F.col("l_linenumber").cast("bigint").alias("line"), "l_quantity", "l_discount", "l_tax")
    return lake.long_metrics(lines, ["game", "line"], ["l_quantity", "l_discount", "l_tax"]).withColumn("value", F.round("value", 2))


@query("SELECT event_type, lower(regexp_replace(regexp_replace(t, '([a-z0-9])([A-Z])', '\\1_\\2', 'g'), '[^A-Za-z0-9]+', '_', 'g')) AS name, count(*) AS n FROM (SELECT event_type, event_type || 'PerGame Rate' AS t FROM events) GROUP BY ALL")
def snake_metrics(t):
    e = t("events").select("event_type", F.concat("event_type", F.lit("PerGame Rate")).alias("t"))
    return e.groupBy("event_type", lake.snake(F.col("t")).alias("name")).agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {GAMES}, l AS (SELECT entity, kind, cents FROM games) SELECT entity, min(cents) FILTER (kind = 'F') AS \"F\", min(cents) FILTER (kind = 'O') AS \"O\", min(cents) FILTER (kind = 'P') AS \"P\" FROM l GROUP BY 1")
def wide_metrics(t):
    return lake.wide(games(t), ["entity"], "kind", ["F", "O", "P"], "cents")


@query("WITH RECURSIVE e AS (SELECT p_partkey AS id, p_partkey // 2 AS up FROM part WHERE p_partkey % 4 <> 1 AND p_partkey > 1), c AS (SELECT id, up, 1 AS n FROM e UNION ALL SELECT c.id, e.up, n + 1 FROM c JOIN e ON e.id = c.up) SELECT id, arg_max(up, n) AS survivor FROM c GROUP BY 1")
def merge_chain(t):
    edges = t("part").where("p_partkey % 4 <> 1 AND p_partkey > 1").select(F.col("p_partkey").alias("merged"), F.floor(F.col("p_partkey") / 2).cast("bigint").alias("survivor"))
    return I.survivors(edges)


@query(f"WITH {GAMES} SELECT CASE WHEN game % 4 = 0 THEN 'x' ELSE '00' || (game % 6)::VARCHAR || lpad((season % 100)::VARCHAR, 2, '0') || lpad(game::VARCHAR, 9, '0') END AS game_id, CASE WHEN game % 4 = 0 THEN CASE WHEN month(day) >= 10 THEN season ELSE season - 1 END ELSE 2000 + season % 100 END AS y, day AS game_date, CASE WHEN game % 4 = 0 THEN 'other' ELSE CASE game % 6 WHEN 1 THEN 'preseason' WHEN 2 THEN 'regular' WHEN 3 THEN 'allstar' WHEN 4 THEN 'playoff' WHEN 5 THEN 'playin' ELSE 'other' END END AS season_type, CASE kind WHEN 'O' THEN 'scheduled' WHEN 'F' THEN 'final' ELSE '?' END AS status, 'C' || (entity % 10)::VARCHAR || ' ' AS home_name, cents % 150 AS home_score FROM games WHERE entity % 5 > 0".replace("SELECT CASE", "SELECT game_id, y::VARCHAR || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') AS season, season_type, game_date, status, home_name, home_score FROM (SELECT CASE", 1) + ")")
def schedule_rows(t):
    """Payloads of a day's games each, written as JSON and read back; games of every fifth customer have no date."""
    g = games(t)
    id_ = F.when(F.col("game") % 4 == 0, "x").otherwise(F.concat(F.lit("00"), F.col("game") % 6, F.lpad((F.col("season") % 100).cast("string"), 2, "0"), F.lpad(F.col("game").cast("string"), 9, "0")))
    day = F.when(F.col("entity") % 5 > 0, F.concat(F.col("day").cast("string"), F.lit("T00:00:00Z"))).otherwise("TBD")
    team = F.struct(F.concat(F.lit("C"), F.col("entity") % 10).alias("teamCity"), (F.col("cents") % 150).cast("int").alias("score"))
    status = F.when(F.col("kind") == "O", 1).when(F.col("kind") == "F", 3)
    one = F.struct(id_.alias("gameId"), day.alias("gameDateEst"), status.alias("gameStatus"), team.alias("homeTeam"))
    days = g.groupBy("day").agg(F.collect_list(one).alias("games"))
    payload = F.to_json(F.struct(F.struct(F.array(F.struct(F.col("day").cast("string").alias("gameDate"), "games")).alias("gameDates")).alias("leagueSchedule")))
    got = schedule.rows(days.select(payload.alias("payload")), "payload")
    return got.select("game_id", "season", "season_type", "game_date", "status", "home_name", F.col("home_score").cast("bigint").alias("home_score"))


_HOT_COLD = """SELECT season, g.kind, count(DISTINCT g.game) AS games, count(*) AS lines, sum(pts)::BIGINT AS pts
FROM (SELECT game, season, kind FROM {cold}.games UNION ALL SELECT game, season, kind FROM {hot}.games) g JOIN {cold}.lines l ON l.game = g.game GROUP BY season, g.kind"""


@query(f"WITH {BOX} SELECT season, kind, count(DISTINCT game) AS games, count(*) AS lines, sum(pts)::BIGINT AS pts FROM box GROUP BY season, kind")
def hot_and_cold_schemas(t):
    """SQL over two named stores: the last seasons are hot, the others archived by season."""
    g = games(t).select("game", "season", "kind")
    spark, at = g.sparkSession, f"{lake.shared_folder(g.sparkSession)}/fieldglass/stores-{uuid.uuid4().hex}"
    lake.write_product(g.where("season >= 1997"), f"{at}/hot/games")
    lake.write_product(g.where("season < 1997"), f"{at}/cold/games", ["season"])
    lake.write_product(box(t).select("game", "pts"), f"{at}/cold/lines")
    lake.catalogued(spark, "hot", {"games": f"{at}/hot/games"})
    lake.catalogued(spark, "cold", {x: f"{at}/cold/{x}" for x in ("games", "lines")})
    return spark.sql(_HOT_COLD.format(hot="hot", cold="cold").replace("::BIGINT", ""))
