"""As-of joins, trailing windows, spells, tiers, quantiles, nearest and overlapping matches."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.operators import box_metrics as B
from fieldglass.operators import joins as J
from fieldglass.operators import windows as W
from fieldglass.plans.registry import BOX, DAYS, GAMES, box, by_player, games, query, user_days

_RUN = f"WITH {GAMES}, run AS (SELECT *, row_number() OVER w AS rn, sum(cents) OVER w AS c FROM games WINDOW w AS (PARTITION BY entity ORDER BY day, game ROWS UNBOUNDED PRECEDING))"
_LEAST = 50_000_000


@query(f"{_RUN} SELECT a.entity, a.game, a.c::BIGINT AS c, b.rn AS asof_rn, b.c::BIGINT AS asof_c FROM run a ASOF LEFT JOIN run b ON a.entity = b.entity AND a.c - {_LEAST} >= b.c")
def asof_left(t):
    w = Window.partitionBy("entity").orderBy("day", "game").rowsBetween(Window.unboundedPreceding, 0)
    run = games(t).select("entity", "game", F.row_number().over(Window.partitionBy("entity").orderBy("day", "game")).cast("bigint").alias("rn"), F.sum("cents").over(w).alias("c"))
    return J.asof_self(run, ["entity"], "c", _LEAST, ["rn", "c"]).select("entity", "game", "c", "asof_rn", "asof_c")


_WINDOW = f"{_RUN}, win AS (SELECT a.entity, a.game, a.rn, a.rn - coalesce(b.rn, 0) AS n, (a.c - coalesce(b.c, 0))::BIGINT AS win_cents FROM run a ASOF LEFT JOIN run b ON a.entity = b.entity AND a.c - {_LEAST} >= b.c WHERE a.c >= {_LEAST})"


def _windows(t):
    g = games(t).withColumn("size", F.col("cents"))
    return J.trailing_window(g, ["entity"], ["day", "game"], "size", _LEAST, ["cents"]).select("entity", "game", F.col("rn").cast("bigint").alias("rn"), F.col("n").cast("bigint").alias("n"), "win_cents")


@query(f"{_WINDOW} SELECT * FROM win")
def trailing_window(t):
    return _windows(t)


@query(f"{_WINDOW} SELECT count(*) AS pairs, round(sqrt(avg((a.win_cents - b.win_cents)::DOUBLE * (a.win_cents - b.win_cents))) / sqrt(2.0::DOUBLE), 1) AS noise FROM win a JOIN win b ON a.entity = b.entity AND a.rn - a.n = b.rn")
def adjacent_window_noise(t):
    w = _windows(t).withColumn("win_cents", F.col("win_cents").cast("double"))
    return J.adjacent_noise(w, ["entity"], "rn", "n", "win_cents").withColumn("noise", F.round("noise", 1))


@query(f"{_WINDOW}, s AS (SELECT entity, avg(cents)::DOUBLE AS season_mean FROM games GROUP BY 1) SELECT entity, game, rn, n, round(win_cents / n::DOUBLE - season_mean, 2) AS above FROM win JOIN s USING (entity)")
def career_arc(t):
    """Trailing windows against the career's mean."""
    mean = games(t).groupBy("entity").agg(F.avg("cents").alias("season_mean"))
    return _windows(t).join(mean, "entity").select("entity", "game", "rn", "n", F.round(F.col("win_cents") / F.col("n") - F.col("season_mean"), 2).alias("above"))


def _between(pair, at: str) -> str:
    return f"({pair[0]}::DOUBLE + ({at} - 1) / 4.0::DOUBLE * {pair[1] - pair[0]}::DOUBLE)"


def _raw_sql(of: dict, roles: dict, constants: tuple[float, float]) -> str:
    stat = lambda k: "(100.0::DOUBLE * pts / poss - context * 100.0::DOUBLE * tsa / poss)" if k == "pts" else f"(100.0::DOUBLE * {k} / poss)"
    sums = [*(f"{_between(v, 'pos')} * {stat(k)}" for k, v in of.items()), *(f"{_between(v, 'role')} * {stat(k)}" for k, v in roles.items())]
    return " + ".join([*sums, f"CASE WHEN pos < 3 THEN (3 - pos) * {constants[0] / 2}::DOUBLE ELSE 0 END", f"(3 - role) * {constants[1] / 2}::DOUBLE"])


_MINUTES = 200
#: Totals of a player's game, from the box line's minutes, line number and marks.
_TOTALS = {k: f"sum((mp * {a} + line * {b} + orb) % {m})" for k, a, b, m in (("pts", 7, 3, 31), ("fg3m", 5, 1, 4), ("ast", 3, 2, 9), ("tov", 2, 5, 5), ("orb", 11, 1, 4), ("drb", 13, 2, 8), ("stl", 17, 1, 3), ("blk", 19, 3, 3), ("pf", 23, 1, 6), ("fga", 29, 1, 20), ("fta", 31, 1, 8))}
_ARC = (
    f"WITH {BOX}, g AS (SELECT player, game, season, day, sum(mp)::BIGINT AS mp, sum(mp * 2 + 1)::BIGINT AS poss, " + ", ".join(f"{v}::BIGINT AS {k}" for k, v in _TOTALS.items()) + " FROM box GROUP BY ALL)"
    ", c AS (SELECT player, game, season, row_number() OVER w AS rn, " + ", ".join(f"sum({k}) OVER w AS {k}" for k in ("mp", "poss", *_TOTALS)) + " FROM g WINDOW w AS (PARTITION BY player ORDER BY day, game ROWS UNBOUNDED PRECEDING))"
    ", w AS (SELECT i.player, i.game, i.season, i.rn, i.rn - coalesce(k.rn, 0) AS n, " + ", ".join(f"(i.{k} - coalesce(k.{k}, 0))::DOUBLE AS {k}" for k in ("mp", "poss", *_TOTALS)) + f" FROM c i ASOF LEFT JOIN c k ON i.player = k.player AND i.mp - {_MINUTES} >= k.mp WHERE i.mp >= {_MINUTES})"
    ", ts AS (SELECT season, sum(pts)::DOUBLE / (2.0::DOUBLE * (sum(fga) + 0.44::DOUBLE * sum(fta))) AS ts FROM g GROUP BY 1)"
    ", p AS (SELECT *, 1 + player % 5 AS pos, 1 + (player + season) % 5 AS role, (player % 7 - 3) / 10.0::DOUBLE AS context, fga + 0.44::DOUBLE * fta AS tsa FROM w JOIN ts USING (season) WHERE (player + season) % 9 > 0)"
    f", v AS (SELECT player, game, season, rn, n, {_raw_sql(B.OVERALL, B.OVERALL_ROLE, B.OVERALL_CONSTANTS)} + (player % 11 + 1) / 13.0::DOUBLE AS bpm, {_raw_sql(B.OFFENCE, B.OFFENCE_ROLE, B.OFFENCE_CONSTANTS)} - (player % 3 + 1) / 17.0::DOUBLE AS obpm, pts / nullif(2.0::DOUBLE * tsa, 0) - ts AS ts_rel FROM p)"
)


def _arcs(t):
    g = by_player(t).groupBy("player", "game", "season", "day").agg(F.sum("mp").alias("mp"), F.sum(F.col("mp") * 2 + 1).alias("poss"), *(F.expr(v).alias(k) for k, v in _TOTALS.items()))
    w = J.trailing_window(g.withColumn("size", F.col("mp")), ["player"], ["day", "game"], "size", _MINUTES, ["poss", *_TOTALS])
    w = w.select("player", "game", "season", F.col("rn").cast("bigint").alias("rn"), F.col("n").cast("bigint").alias("n"), "win_poss", *(f"win_{k}" for k in _TOTALS))
    of = F.col("player")
    params = g.select("player", "season").distinct().where((of + F.col("season")) % 9 > 0)
    params = params.select("*", (1 + of % 5).alias("pos"), (1 + (of + F.col("season")) % 5).alias("role"), ((of % 7 - 3) / 10.0).alias("context"), ((of % 11 + 1) / 13.0).alias("bpm_adj"), (-(of % 3 + 1) / 17.0).alias("obpm_adj"))
    league = g.groupBy("season").agg((F.sum("pts") / (2.0 * (F.sum("fga") + 0.44 * F.sum("fta")))).alias("ts"))
    return B.arc_values(w, params, league, "player", "season").select("player", "game", "season", "rn", "n", "bpm", "obpm", "ts_rel")


@query(f"{_ARC} SELECT player, game, season, rn, n, " + ", ".join(f"CASE WHEN round({c}, {k}) = 0 THEN 0 ELSE round({c}, {k}) END AS {c}" for c, k in (("bpm", 2), ("obpm", 2), ("ts_rel", 4))) + " FROM v")
def arc_values(t):
    """Box plus-minus of every trailing window of 200 minutes, at the season's adjustment."""
    zero = lambda x: F.when(x == 0, 0.0).otherwise(x)  # of either sign
    return _arcs(t).withColumns({c: zero(F.round(c, k)) for c, k in (("bpm", 2), ("obpm", 2), ("ts_rel", 4))})


@query(f"{_ARC} SELECT count(*) AS pairs, round(sqrt(avg((a.bpm - b.bpm) * (a.bpm - b.bpm))) / sqrt(2.0::DOUBLE), 4) AS noise FROM v a JOIN v b ON a.player = b.player AND a.season = b.season AND a.rn - a.n = b.rn")
def arc_noise(t):
    """The noise of a window, from windows of one season that end where others begin."""
    return J.adjacent_noise(_arcs(t), ["player", "season"], "rn", "n", "bpm").withColumn("noise", F.round("noise", 4))


@query("WITH l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'), r AS (SELECT user_id, ts, max(event_id) AS seen FROM events WHERE event_type = 'view' GROUP BY ALL) SELECT l.event_id, l.user_id, r.seen FROM l ASOF LEFT JOIN r ON l.user_id = r.user_id AND l.ts >= r.ts")
def asof_two_table(t):
    e = t("events")
    left = e.where("event_type = 'purchase'").select("event_id", "user_id", "ts")
    right = e.where("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("seen"))
    return J.asof(left, right, ["user_id"], "ts", "ts", ["seen"]).select("event_id", "user_id", "seen")


@query(f"WITH {GAMES} SELECT entity, game, day FROM games QUALIFY row_number() OVER (PARTITION BY entity ORDER BY day DESC, game DESC) = 1")
def qualify_dedup(t):
    return W.latest(games(t).select("entity", "game", "day"), ["entity"], [F.col("day").desc(), F.col("game").desc()])


@query(f"WITH {GAMES} SELECT kind, season, game FROM games QUALIFY day = max(day) OVER (PARTITION BY kind, season)")
def qualify_latest(t):
    return W.at_maximum(games(t), ["kind", "season"], "day").select("kind", "season", "game")


@query(f"WITH {BOX}, s AS (SELECT team, count(DISTINCT game) // 10 AS games, nullif(count(*) % 5, 0) AS odd FROM box GROUP BY 1) SELECT team, games, rank() OVER (ORDER BY games DESC) AS place, rank() OVER (ORDER BY odd DESC NULLS LAST) AS odd_place, count(*) OVER () AS n FROM s")
def rank_with_ties(t):
    """Ranks over all teams, some thousands at most; ties share a rank."""
    s = box(t).groupBy("team").agg(F.floor(F.count_distinct("game") / 10).cast("bigint").alias("games"), F.nullif(F.count(F.lit(1)) % 5, F.lit(0).cast("bigint")).alias("odd"))
    rank = lambda c: F.rank().over(Window.orderBy(c)).cast("bigint")
    return s.select("team", "games", rank(F.col("games").desc()).alias("place"), rank(F.col("odd").desc_nulls_last()).alias("odd_place"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))


_SPELLS = f"WITH {DAYS}, cal AS (SELECT d, row_number() OVER (ORDER BY d) AS i, lead(d) OVER (ORDER BY d) AS nxt FROM (SELECT DISTINCT d FROM days)), r AS (SELECT who, d, nxt, i - row_number() OVER (PARTITION BY who ORDER BY d) AS g FROM days JOIN cal USING (d)), spells AS (SELECT who, min(d) AS first_day, max(d) AS last_day, arg_max(nxt, d) AS until_day, count(*) AS days FROM r GROUP BY who, g)"


def _spells(t):
    return W.spells(user_days(t).withColumn("all", F.lit(1)), ["all", "who"], ["all"], "d").drop("all")


@query(f"{_SPELLS} SELECT who, first_day, last_day, (SELECT min(d) FROM cal WHERE d > last_day) AS until_day, days FROM spells")
def gaps_islands_spells(t):
    return _spells(t)


@query(f"{_SPELLS}, s AS (SELECT who, first_day, (SELECT min(d) FROM cal WHERE d > last_day) AS until_day FROM spells), probe AS (SELECT DISTINCT d + 1 AS probe_day FROM days) SELECT probe_day, count(*) AS members, sum(who)::BIGINT AS who_sum FROM probe JOIN s ON first_day <= probe_day AND (until_day IS NULL OR until_day > probe_day) GROUP BY 1")
def membership_asof_day(t):
    probe = user_days(t).select((F.col("d") + 1).alias("probe_day"))
    return W.membership(_spells(t), probe, "first_day", "until_day", "probe_day", {"who_sum": "who"})


@query()
def membership_every_day(t):
    probe = user_days(t).select((F.col("d") + 1).alias("probe_day"))
    return W.membership(_spells(t), probe, "first_day", "until_day", "probe_day", {"who_sum": "who"})


@query(f"WITH {GAMES} SELECT DISTINCT ON (entity, kind) entity, kind, game, cents FROM games ORDER BY entity, kind, day DESC, game DESC")
def distinct_on_latest(t):
    return W.latest(games(t).select("entity", "kind", "game", "cents", "day"), ["entity", "kind"], [F.col("day").desc(), F.col("game").desc()]).drop("day")


@query("SELECT user_id, event_id, event_type FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id) QUALIFY row_number() OVER w = 1 OR event_type IS DISTINCT FROM lag(event_type) OVER w")
def change_points(t):
    return W.change_points(t("events"), ["user_id"], ["ts", "event_id"], ["event_type"]).select("user_id", "event_id", "event_type")


_BAL = "b AS (SELECT c_nationkey::BIGINT AS nation, c_custkey AS id, round(c_acctbal * 100)::BIGINT AS v FROM customer)"


def _balances(t):
    return t("customer").select(F.col("c_nationkey").cast("bigint").alias("nation"), F.col("c_custkey").alias("id"), F.round(F.col("c_acctbal") * 100).cast("bigint").alias("v"))


@query(f"WITH {_BAL} SELECT id, nation, v, CASE WHEN row_number() OVER (PARTITION BY nation ORDER BY v DESC, id) <= 5 THEN 'top' WHEN row_number() OVER (PARTITION BY nation ORDER BY v, id DESC) <= 5 THEN 'bottom' ELSE 'middle' END AS tier FROM b")
def tier_by_rank(t):
    return W.tiers(_balances(t), ["nation"], "v", "id", 5).select("id", "nation", "v", "tier")


@query(f"WITH {_BAL} SELECT nation, rank, v AS floor FROM (SELECT *, row_number() OVER (PARTITION BY nation ORDER BY v DESC, id) AS rank FROM b) WHERE rank IN (1, 5, 10, 25)")
def band_floors(t):
    return W.band_floors(_balances(t), ["nation"], "v", "id", [1, 5, 10, 25]).withColumn("rank", F.col("rank").cast("bigint"))


@query("SELECT user_id, event_id, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 2 WHEN event_type = 'click' THEN 1 ELSE -1 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS margin FROM events")
def running_margin(t):
    points = F.when(F.col("event_type") == "purchase", 2).when(F.col("event_type") == "click", 1).otherwise(-1)
    return W.running_before(t("events"), ["user_id"], ["ts", "event_id"], points, "margin").select("user_id", "event_id", F.col("margin").cast("bigint").alias("margin"))


@query(f"WITH {GAMES}, s AS (SELECT entity, season, sum(cents)::BIGINT AS cents FROM games GROUP BY ALL), r AS (SELECT *, cents >= 30000000 AS ok, max(cents >= 30000000) OVER (PARTITION BY entity) AS has FROM s), k AS (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY ok DESC, season DESC) AS recent, row_number() OVER (PARTITION BY entity ORDER BY cents DESC, season DESC) AS best FROM r) SELECT entity, season, cents FROM k WHERE (has AND ok AND recent <= 3) OR (NOT has AND best <= 3)")
def top3_recent_or_best(t):
    s = games(t).groupBy("entity", "season").agg(F.sum("cents").alias("cents"))
    return W.recent_or_best(s, ["entity"], "season", "cents", 30_000_000, 3)


@query(f"WITH {_BAL}, r AS (SELECT nation, v, row_number() OVER (PARTITION BY nation ORDER BY v, id) - 1 AS i, count(*) OVER (PARTITION BY nation) AS n FROM b), q AS (SELECT unnest([0.1, 0.25, 0.5, 0.9])::DOUBLE AS f) SELECT nation, f, v AS quantile FROM r, q WHERE i = least(floor(f * n), n - 1)")
def index_quantile(t):
    return W.index_quantiles(_balances(t), ["nation"], "v", "id", [0.1, 0.25, 0.5, 0.9])


@query(f"WITH {_BAL} SELECT id, greatest(0, least(100, round(100.0::DOUBLE * (rank() OVER (PARTITION BY nation ORDER BY v) - 1) / nullif(count(*) OVER (PARTITION BY nation) - 1, 0))))::DOUBLE AS up, 100 - greatest(0, least(100, round(100.0::DOUBLE * (rank() OVER (PARTITION BY nation ORDER BY v) - 1) / nullif(count(*) OVER (PARTITION BY nation) - 1, 0))))::DOUBLE AS down FROM b")
def percentile_rank(t):
    up = W.percentile_rank(_balances(t), ["nation"], "v").withColumnRenamed("percentile", "up")
    return W.percentile_rank(up, ["nation"], "v", True).select("id", "up", F.col("percentile").alias("down"))


_BANDS = [(None, 0, "debt"), (0, 100_000, "low"), (100_000, 500_000, "mid"), (500_000, None, "high")]


@query(f"WITH {_BAL} SELECT id, CASE WHEN v < 0 THEN 'debt' WHEN v < 100000 THEN 'low' WHEN v < 500000 THEN 'mid' ELSE 'high' END AS band FROM b")
def band_lookup(t):
    bands = t("nation").sparkSession.createDataFrame(_BANDS, "low bigint, high bigint, band string")
    return J.in_band(_balances(t), bands, "v", "low", "high", "band").select("id", "band")


@query(f"WITH {GAMES}, s AS (SELECT entity, min(day) AS start, max(day) AS stop FROM games WHERE kind = 'F' GROUP BY 1) SELECT g.game, g.entity FROM games g JOIN s ON g.entity = s.entity AND g.day >= s.start AND g.day < s.stop WHERE kind <> 'F'")
def range_overlap(t):
    s = games(t).where("kind = 'F'").groupBy("entity").agg(F.min("day").alias("start"), F.max("day").alias("stop"))
    return J.during(games(t).where("kind <> 'F'"), s, ["entity"], "day", "start", "stop").select("game", "entity")


def _nearest(t, lines):
    left = lines.select("game", "line", "team", "player", F.col("mp").alias("size"), F.floor(F.col("pts") / F.col("mp")).cast("bigint").alias("unit"))
    right = t("part").select(F.col("p_partkey").alias("part"), F.col("p_size").cast("bigint").alias("size"), F.round(F.col("p_retailprice") * 100).cast("bigint").alias("price"))
    return J.nearest_sorted(left, right, ["size"], ["game", "line", "team", "player"], "part", "unit", "price", 9000, 300).select("game", "line", "team", "player", "part", "distance")


@query(f"WITH {BOX}, p AS (SELECT p_partkey AS part, p_size::BIGINT AS size, round(p_retailprice * 100)::BIGINT AS price FROM part), l AS (SELECT game, line, team, player, mp AS size, pts // mp AS unit FROM box), d AS (SELECT game, line, team, player, part, abs(unit - price) AS distance FROM l JOIN p USING (size)), r AS (SELECT *, row_number() OVER w AS place, lead(distance) OVER w AS second FROM d WINDOW w AS (PARTITION BY game, line, team, player ORDER BY distance, part)) SELECT game, line, team, player, part, distance FROM r WHERE place = 1 AND distance <= 9000 AND (second IS NULL OR second - distance >= 300)")
def nearest_with_separation(t):
    """All players against the parts of one size; lines with the same ids are one."""
    return _nearest(t, box(t))


@query()
def nearest_with_separation_all(t):
    """All players against the parts of one size; lines with the same ids are one."""
    return _nearest(t, box(t))


@query(f"WITH {BOX} SELECT least(player, team) || '|' || greatest(player, team) AS pair, count(*) AS n FROM box GROUP BY 1")
def unordered_pair_key(t):
    return box(t).groupBy(J.pair_key(F.col("player"), F.col("team")).alias("pair")).agg(F.count(F.lit(1)).alias("n"))


@query("WITH c AS (SELECT c_custkey AS who, right(c_name, 2) AS k FROM customer UNION SELECT c_custkey, right(c_name, 4) FROM customer), o AS (SELECT s_suppkey AS id, right(s_name, 4) AS k FROM supplier UNION SELECT s_suppkey, '00' || right(s_name, 2) FROM supplier), f AS (SELECT id, count(DISTINCT who) AS n, min(who) AS first FROM o LEFT JOIN c USING (k) GROUP BY 1) SELECT id, CASE WHEN n = 1 THEN first END AS who, CASE WHEN n = 1 THEN 'resolved' WHEN n > 1 THEN 'ambiguous' ELSE 'unmatched' END AS status, n FROM f")
def candidate_uniqueness(t):
    c, s = t("customer"), t("supplier")
    tail = lambda x, n: F.right(F.col(x), F.lit(n))
    variants = c.select(F.col("c_custkey").alias("who"), tail("c_name", 2).alias("k")).union(c.select("c_custkey", tail("c_name", 4))).distinct()
    seen = s.select(F.col("s_suppkey").alias("id"), tail("s_name", 4).alias("k")).union(s.select("s_suppkey", F.concat(F.lit("00"), tail("s_name", 2)))).distinct()
    return J.unique_candidate(seen, variants, ["k"], ["id"], "who")


@query(f"WITH {GAMES}, pace AS (SELECT season, kind, avg(cents)::DOUBLE AS pace FROM games GROUP BY ALL HAVING count(*) % 2 = 0 OR kind = 'F') SELECT game, round(coalesce(a.pace, b.pace), 3) AS pace FROM games g LEFT JOIN pace a USING (season, kind) LEFT JOIN pace b ON b.season = g.season AND b.kind = 'F'")
def fallback_join(t):
    pace = games(t).groupBy("season", "kind").agg(F.avg("cents").alias("pace"), F.count(F.lit(1)).alias("n")).where("n % 2 = 0 OR kind = 'F'")
    return J.fallback(games(t).select("game", "season", "kind"), pace, ["season"], "kind", "F", ["pace"]).select("game", F.round("pace", 3).alias("pace"))


@query("SELECT c_custkey AS id, NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS idle FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) OR EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def anti_semi(t):
    c, o = t("customer").select(F.col("c_custkey").alias("id")), t("orders").select(F.col("o_custkey").alias("id"), "o_orderstatus")
    return c.join(o, "id", "left_anti").withColumn("idle", F.lit(True)).unionByName(c.join(o.where("o_orderstatus = 'P'"), "id", "left_semi").withColumn("idle", F.lit(False)))


@query(f"WITH {GAMES} SELECT game, cents FROM games g WHERE cents > 2 * (SELECT avg(cents) FROM games h WHERE h.entity = g.entity)")
def scalar_subquery(t):
    mean = games(t).groupBy("entity").agg(F.avg("cents").alias("mean"))
    return games(t).join(mean, "entity").where(F.col("cents") > 2 * F.col("mean")).select("game", "cents")


@query(f"WITH {BOX}, a AS (SELECT DISTINCT season, player % 50 AS x, team % 50 AS y FROM box WHERE flag = 'R'), b AS (SELECT season, team % 50 AS x, player % 50 AS y, min(game) AS g FROM box WHERE flag = 'A' GROUP BY ALL) SELECT a.season, a.x, a.y, coalesce(s.g, f.g) AS g, s.g IS NULL AND f.g IS NOT NULL AS flip FROM a LEFT JOIN b s ON s.season = a.season AND s.x = a.x AND s.y = a.y LEFT JOIN b f ON f.season = a.season AND f.x = a.y AND f.y = a.x")
def orientation_flip(t):
    mod = lambda c: F.col(c) % 50
    a = box(t).where("flag = 'R'").select("season", mod("player").alias("x"), mod("team").alias("y")).distinct()
    b = box(t).where("flag = 'A'").groupBy("season", mod("team").alias("x"), mod("player").alias("y")).agg(F.min("game").alias("g"))
    return J.either_orientation(a, b, ["season"], "x", "y", "g")


@query("WITH a AS (SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'P'), b AS (SELECT o_custkey AS id FROM orders WHERE o_orderpriority = '1-URGENT') SELECT 'both' AS what, id FROM (SELECT id FROM a INTERSECT SELECT id FROM b) UNION ALL SELECT 'either', id FROM (SELECT id FROM a UNION SELECT id FROM b) UNION ALL SELECT 'one', id FROM ((SELECT id FROM a EXCEPT SELECT id FROM b) UNION ALL (SELECT id FROM b EXCEPT SELECT id FROM a))")
def set_ops(t):
    a = t("orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("id"))
    b = t("orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    tag = lambda what, df: df.select(F.lit(what).alias("what"), "id")
    return tag("both", a.intersect(b)).unionByName(tag("either", a.union(b).distinct())).unionByName(tag("one", a.subtract(b).union(b.subtract(a))))


@query("WITH l AS (SELECT c_custkey AS id, round(c_acctbal * 100)::BIGINT AS v FROM customer) SELECT id, v FROM l ORDER BY v DESC, id LIMIT 25")
def top_k(t):
    """A report of the 25 highest balances."""
    return _balances(t).select("id", "v").orderBy(F.col("v").desc(), "id").limit(25)


@query("SELECT o_orderkey AS game, o_custkey AS entity, o_orderstatus AS kind FROM orders ORDER BY md5('7:' || o_orderkey), o_orderkey LIMIT 300")
def sample_rows(t):
    """A sample of exactly 300 games."""
    return W.sampled(games(t), ["game"], 300).select("game", "entity", "kind")
