"""Regressions, box metrics, possessions, stints, contracts, identity, classifiers, pages."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from fieldglass.functions import text as T
from fieldglass.operators import box_metrics, classify, contracts, older_feed, quota, service_years, transactions
from fieldglass.operators import games as G
from fieldglass.operators import identity as I
from fieldglass.operators import lineup_measures as lineup_measures_
from fieldglass.operators import models as R
from fieldglass.operators.classify import TRANSACTIONS
from fieldglass.plans.registry import BOX, GAMES, TWO, box, games, line_parts, query, two_teams
from fieldglass.sources import feeds, pages


@query("WITH s AS (SELECT l_returnflag AS flag, l_quantity::DOUBLE AS x, l_extendedprice / 1000 AS y, (1 + l_linenumber)::DOUBLE AS w FROM lineitem), a AS (SELECT flag, count(*) AS n, sum(w) AS w, sum(w*x) AS x, sum(w*y) AS y, sum(w*x*x) AS xx, sum(w*x*y) AS xy, sum(w*y*y) AS yy FROM s GROUP BY 1) SELECT flag, n, round((xy - x*y/w) / (xx - x*x/w), 6) AS slope, round((y - (xy - x*y/w) / (xx - x*x/w) * x) / w, 4) AS intercept, round(pow(xy - x*y/w, 2) / ((xx - x*x/w) * (yy - y*y/w)), 6) AS r2 FROM a")
def wls_simple(t):
    s = t("lineitem").select(F.col("l_returnflag").alias("flag"), F.col("l_quantity").alias("x"), (F.col("l_extendedprice") / 1000).alias("y"), (1 + F.col("l_linenumber")).cast("double").alias("w"))
    return R.simple_wls(s, ["flag"], "x", "y", "w").select("flag", "n", F.round("slope", 6).alias("slope"), F.round("intercept", 4).alias("intercept"), F.round("r2", 6).alias("r2"))


_FACTORS = ("one", "mp", "tov", "orb")
_GRAM = f"WITH {BOX}, f AS (SELECT kind, 1 AS one, mp, tov, orb FROM box)"


@query(_GRAM + " SELECT * FROM (" + " UNION ALL ".join(f"SELECT kind, {i} AS i, {j} AS j, sum({a} * {b})::BIGINT AS value FROM f GROUP BY kind" for i, a in enumerate(_FACTORS) for j, b in enumerate(_FACTORS) if i <= j) + ")")
def ridge_normal_equations(t):
    f = box(t).withColumn("one", F.lit(1))
    return R.gram(f, ["kind"], list(_FACTORS)).withColumn("value", F.round("value").cast("bigint"))


@query(f"WITH {BOX} SELECT a, b, round(r, 6) AS r FROM (SELECT unnest(['mp', 'mp', 'mp', 'tov', 'tov', 'orb']) AS a, unnest(['mp', 'tov', 'orb', 'tov', 'orb', 'orb']) AS b, unnest([corr(mp, mp), corr(mp, tov), corr(mp, orb), corr(tov, tov), corr(tov, orb), corr(orb, orb)]) AS r FROM box)")
def corr_matrix(t):
    return R.correlations(box(t), ["mp", "tov", "orb"]).withColumn("r", F.round("r", 6))


@query(f"WITH {GAMES} SELECT ('0x' || substr(md5('7:' || game), 1, 8))::BIGINT % 5 AS fold, count(*) AS n, sum(cents)::BIGINT AS cents FROM games GROUP BY 1")
def cv_folds(t):
    fold = F.conv(F.substring(F.md5(F.concat(F.lit("7:"), F.col("game").cast("string"))), 1, 8), 16, 10).cast("bigint") % 5
    return games(t).groupBy(fold.alias("fold")).agg(F.count(F.lit(1)).alias("n"), F.sum("cents").alias("cents"))


def _stints(t):
    """Lines of a game, paired by place, as stints of five against five: numbers of teams stand for players."""
    b = box(t).select("game", "line", (F.col("team") % 40).cast("int").alias("p"), "mp", "orb")
    ids = lambda shift: F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: ((F.col("p") * 7 + k * 3 + shift) % 40).cast("bigint"))
    return b.select("game", ids(0).alias("home_ids"), ids(1).alias("away_ids"), F.col("orb").alias("home_pts"), (F.col("mp") % 7).alias("away_pts"), (F.col("mp") % 5 + 1).alias("home_poss"), (F.col("mp") % 3 + 1).alias("away_poss"))


@query()
def ridge_impact(t):
    players = t("orders").sparkSession.range(40).select(F.col("id").alias("player"), F.col("id").cast("int").alias("k"))
    folds = games(t).select("game", (F.col("game") % 5).alias("fold"))
    return R.player_impact(_stints(t), players, folds)


def _tallied(t):
    """``_stints`` with tallies of either side, whose possessions and points follow from them."""
    b = box(t).select("game", "line", (F.col("team") % 40).cast("int").alias("p"), "mp", "orb", "tov")
    ids = lambda shift: F.transform(F.sequence(F.lit(0), F.lit(4)), lambda k: ((F.col("p") * 7 + k * 3 + shift) % 40).cast("bigint"))
    s = b.select("game", ids(0).alias("home_ids"), ids(1).alias("away_ids"), "mp", "line", "orb", "tov")
    for k, side in enumerate(("home", "away")):
        x = F.col("mp") * (7 + 4 * k) + F.col("line")
        of = lambda n, side=side: F.col(f"{side}_{n}")
        s = s.withColumns({f"{side}_fga": 12 + x % 9, f"{side}_fta": x % 5, f"{side}_orb": (F.col("orb") + k) % 5, f"{side}_drb": 5 + x % 6, f"{side}_tov": (F.col("tov") + 3 * k) % 7, f"{side}_fgm": 3 + (x * 5) % 8})
        s = s.withColumns({f"{side}_fg3m": of("fgm") % 4, f"{side}_ftm": F.floor(of("fta") * (x % 3) / 2)})
        s = s.withColumns({f"{side}_pts": 2 * of("fgm") + of("fg3m") + of("ftm"), f"{side}_poss": of("fga") + F.floor(0.44 * of("fta")) - of("orb") + of("tov")})
    return s


@query()
def six_factor_impact(t):
    players = t("orders").sparkSession.range(40).select(F.col("id").alias("player"), F.col("id").cast("int").alias("k"))
    return R.six_factors(_tallied(t), players, games(t).select("game", (F.col("game") % 5).alias("fold")))


#: Models of points per 100 possessions from team games.
FACTOR_MODELS = {"four": ("efg", "tov", "orb", "ft"), "six": ("ts", "tov", "orb"), "six+ft": ("ts", "tov", "orb", "ft")}


@query()
def wls_multi(t):
    """Betas by model and term, with the model's r2, its r2 of seasons left out (mean and least) and the term's deviation."""
    ways = R.two_ways(_tallied(t), R.TALLIES).join(games(t).select("game", "season"), "game")
    sides = R.settled(R.team_games(ways, ["season", "game"]))
    rows = []
    for model, terms in FACTOR_MODELS.items():
        got = R.wls(sides, "season", list(terms), "y", "poss")
        if got:
            held = list(got["held"].values()) or [float("nan")]
            tail = (got["r2"], sum(held) / len(held), min(held), got["n"])
            rows += [(model, term, float(b), sd, *tail) for term, b, sd in zip(("constant", *terms), got["betas"], (None, *got["sd"]), strict=True)]
    return sides.sparkSession.createDataFrame(rows, "model string, term string, beta double, sd double, r2 double, held_mean double, held_least double, n long")


@query(f"WITH {BOX} SELECT season, round(100.0::DOUBLE * sum(pts) / sum(mp), 2) AS rate FROM box GROUP BY 1")
def league_rate(t):
    return box(t).groupBy("season").agg(F.round(100.0 * F.sum("pts") / F.sum("mp"), 2).alias("rate"))


def _season_box(t):
    s = box(t).select("season", "team", F.concat_ws("-", "player", "line").alias("who"), "game", (F.col("mp") * 40).alias("mp"), *(((F.col(c) * k) % m).alias(n) for n, c, k, m in (("pts", "pts", 1, 31), ("fg3m", "orb", 1, 5), ("ast", "tov", 1, 11), ("tov", "tov", 1, 5), ("orb", "orb", 1, 4), ("drb", "orb", 3, 9), ("stl", "mp", 3, 4), ("blk", "mp", 7, 3), ("pf", "line", 1, 6), ("fga", "mp", 5, 23), ("fta", "mp", 11, 9))))
    return s.withColumn("trb", F.col("orb") + F.col("drb")).withColumn("fgm", F.floor(F.col("fga") / 2))


@query()
def bpm_like(t):
    stats = ["pts", "fg3m", "ast", "tov", "orb", "drb", "trb", "stl", "blk", "pf", "fga", "fta", "fgm"]
    s, n = _season_box(t), line_parts(t)
    s = s.repartition(n, "season", "team") if n else s
    players = s.groupBy("season", "team", "who").agg(F.sum("mp").alias("mp"), *(F.sum(c).alias(c) for c in stats))
    team = s.groupBy("season", "team").agg(F.sum("mp").alias("team_mp"), F.sum("pts").alias("pts_team"), F.count_distinct("game").alias("gp"), *(F.sum(c).alias(f"t_{c}") for c in stats))
    team = team.withColumn("poss", F.col("t_fga") + 0.44 * F.col("t_fta") - F.col("t_orb") + F.col("t_tov")).withColumn("opp_poss", F.col("poss")).withColumn("opp_pts", F.col("pts_team") - 2)
    league = team.groupBy("season").agg((100.0 * F.sum("pts_team") / F.sum("poss")).alias("league_ortg"))
    return box_metrics.box_plus_minus(players, team.join(F.broadcast(league), "season"), ["season", "team"], "who")


@query("WITH p AS (SELECT p_partkey AS id, (72 + p_size % 15)::DOUBLE AS h, (180 + p_size * 2)::DOUBLE AS w, 1 + (p_partkey % 41) / 10.0::DOUBLE AS r, (p_partkey % 3) * 800 AS m FROM part), s AS (SELECT *, greatest(1.0, least(5.0, 1.0 + (h - 73) / 2.5 + (w - (190 + 6.5 * (h - 73))) / 75))::DOUBLE AS size FROM p), c AS (SELECT *, (0.45::DOUBLE * size + 0.55::DOUBLE * r) AS score FROM s) SELECT id, round(size, 4) AS size, round(score, 4) AS pos_score, CASE WHEN score < 1.9::DOUBLE THEN 'PG' WHEN score < 2.7::DOUBLE THEN 'SG' WHEN score < 3.5::DOUBLE THEN 'SF' WHEN score < 4.3::DOUBLE THEN 'PF' ELSE 'C' END AS position, round(greatest(0.05, least(1.0, least(abs(score - 1.9::DOUBLE), abs(score - 2.7::DOUBLE), abs(score - 3.5::DOUBLE), abs(score - 4.3::DOUBLE)) / 0.35::DOUBLE) * CASE WHEN m >= 1000 THEN 1 ELSE 0.7::DOUBLE END * CASE WHEN abs(size - r) > 1 THEN 0.7::DOUBLE ELSE 1 END), 4) AS confidence FROM c")
def position_estimate(t):
    p = t("part").select(F.col("p_partkey").alias("id"), (72 + F.col("p_size") % 15).cast("double").alias("h"), (180 + F.col("p_size") * 2).cast("double").alias("w"), (1 + (F.col("p_partkey") % 41) / 10.0).alias("r"), ((F.col("p_partkey") % 3) * 800).alias("m"))
    return box_metrics.position_estimate(p, "h", "w", "r", "m").select("id", F.round("size", 4).alias("size"), F.round("pos_score", 4).alias("pos_score"), "position", F.round("confidence", 4).alias("confidence"))


def play_columns() -> list:
    """Events as plays of two sides: types stand for kinds of play."""
    kind = F.create_map(*(F.lit(x) for p in (("click", "Made Shot"), ("view", "Missed Shot"), ("purchase", "Rebound"), ("signup", "Turnover"), ("error", "Free Throw")) for x in p))[F.col("event_type")]
    k = F.get_json_object("props", "$.k").cast("int")
    return [F.col("event_id").alias("action_id"), (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"), F.lit(720.0 - F.minute("ts") * 12.0).alias("secs"), kind.alias("kind"), F.when(k % 2 == 0, "Bad Pass").otherwise("1 of 1").alias("sub_kind"), F.when(F.col("event_id") % 2 == 0, "H").otherwise("A").alias("team"), (k % 2 + 2).cast("int").alias("value"), F.lit(None).cast("string").alias("result"), F.when(k % 3 == 0, "MISS").otherwise("make").alias("text")]


def game_of_day():
    """A game of the day: the events of every eighth user."""
    return F.concat_ws("-", F.date_format("ts", "yyyy-MM-dd"), (F.col("user_id") % 8).cast("string"))


def _feed(t):
    """Events of a user as a game."""
    return t("events").select(F.col("user_id").cast("string").alias("game_id"), *play_columns())


@query()
def possessions(t):
    return G.possessions(_feed(t))


def _context(t):
    e = t("events").select(F.col("user_id").cast("string").alias("game_id")).distinct()
    g = e.select("game_id", F.lit("H").alias("home"), F.lit("A").alias("away"), F.lit("2024-25").alias("season"), F.when(F.col("game_id").cast("int") % 3 == 0, "playoff").otherwise("regular").alias("season_type"))
    return G.possession_context(G.possessions(_feed(t)), g)


@query()
def possession_context(t):
    return _context(t)


@query()
def possession_values(t):
    return G.possession_values(_context(t), ["season", "season_type"])


@query("WITH s AS (SELECT *, role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS c FROM conversations), r AS (SELECT *, sum(c::INT) OVER (PARTITION BY conv_id ORDER BY turn) AS run FROM s) SELECT conv_id, run::BIGINT AS run, min(turn) AS first_turn, max(turn) AS last_turn, count(*) AS turns, any_value(role) AS role FROM r GROUP BY conv_id, run")
def role_possessions(t):
    """Runs of turns of one role: possession by change of side, in SQL's reach."""
    from pyspark.sql.window import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    s = t("conversations").withColumn("c", (~F.col("role").eqNullSafe(F.lag("role").over(w)) | (F.row_number().over(w) == 1)).cast("int"))
    r = s.withColumn("run", F.sum("c").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return r.groupBy("conv_id", "run").agg(F.min("turn").alias("first_turn"), F.max("turn").alias("last_turn"), F.count(F.lit(1)).alias("turns"), F.min("role").alias("role"))


def _floor(t):
    e = t("events").select(F.col("user_id").cast("string").alias("game_id"), "event_id", "event_type", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.minute("ts").alias("m"), (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"))
    person = F.col("k") % 14
    actions = e.select("game_id", F.col("event_id").alias("order_number"), "period", (720.0 - F.col("m") * 12.0).alias("seconds_left"), F.when(F.col("event_type") == "signup", "substitution").otherwise("2pt").alias("kind"), F.when(F.col("k") % 3 == 0, "out").otherwise("in").alias("sub_kind"), person.alias("person"), F.when(F.col("event_type") == "purchase", 2).otherwise(0).alias("points"), F.when(person < 7, "home").otherwise("away").alias("possession"))
    box_ = e.select("game_id").distinct().crossJoin(e.sparkSession.range(14)).select("game_id", F.col("id").alias("person"), F.when(F.col("id") < 7, "home").otherwise("away").alias("team"), (F.col("id") % 7 < 5).alias("starter"), F.lit(1200.0).alias("seconds"), F.lit(None).cast("int").alias("team_points"))
    return actions, box_


@query()
def stints(t):
    return G.stints(*_floor(t)).withColumn("home_ids", F.array_join(F.col("home_ids").cast("array<string>"), "-")).withColumn("away_ids", F.array_join(F.col("away_ids").cast("array<string>"), "-"))


def _tally_floor(t):
    """``_floor`` with kinds of play and who helped, so that actions have box lines."""
    actions, box_ = _floor(t)
    n = F.col("order_number")
    kind = F.when(F.col("kind") == "substitution", "substitution").otherwise(F.element_at(F.array(*(F.lit(x) for x in ("2pt", "3pt", "freethrow", "rebound", "turnover"))), (n % 5 + 1).cast("int")))
    sub = F.when(F.col("kind") == "substitution", F.col("sub_kind")).otherwise(F.when(n % 2 == 0, "offensive").otherwise("defensive"))
    made = F.when(n % 3 == 0, ": Made").otherwise("Missed")
    a = actions.withColumns({"sub_kind": sub, "kind": kind, "result": made, "team": F.col("possession"), "assist": n % 4, "block": n % 7, "steal": n % 2})
    return G.with_tallies(a), box_


@query("WITH a AS (SELECT user_id::VARCHAR AS game_id, event_id AS n, (json_extract_string(props, '$.k')::BIGINT) % 14 AS person FROM events WHERE event_type <> 'signup'), b AS (SELECT game_id, n, person, CASE WHEN person < 7 THEN 1 ELSE 0 END AS home FROM a) SELECT game_id, count(*) FILTER (home = 1 AND n % 5 < 2) AS home_fga, count(*) FILTER (home = 1 AND n % 5 < 2 AND n % 3 = 0) AS home_fgm, count(*) FILTER (home = 0 AND n % 5 = 2) AS away_fta, count(*) FILTER (home = 1 AND n % 5 = 3 AND n % 2 = 0 AND person <> 0) AS home_orb, count(*) FILTER (home = 0 AND n % 5 = 4 AND n % 2 <> 0) AS home_stl, count(*) FILTER (home = 0 AND n % 5 < 2 AND n % 3 = 0 AND n % 4 <> 0) AS away_ast, count(*) FILTER (home = 1 AND n % 5 < 2 AND n % 3 <> 0 AND n % 7 <> 0) AS away_blk FROM b WHERE game_id IN (SELECT user_id::VARCHAR FROM events) GROUP BY 1")
def stint_tallies(t):
    """Box lines of the stints of a game, added up: every action is in one stint."""
    s = G.stints(*_tally_floor(t))
    return s.groupBy("game_id").agg(*(F.sum(c).alias(c) for c in ("home_fga", "home_fgm", "away_fta", "home_orb", "home_stl", "away_ast", "away_blk")))


@query()
def stint_units(t):
    return G.units(G.stints(*_floor(t)), ["game_id"])


_OLDER = """e AS (
  SELECT event_id AS n, strftime(ts, '%Y-%m-%d') || '-' || user_id % 8 AS game_id, user_id % 8 AS g, (hour(ts) // 6 + 1)::INTEGER AS period, 720.0::DOUBLE - ((hour(ts) % 6) * 3600 + minute(ts) * 60 + second(ts)) // 30 AS secs,
         event_type IN ('signup', 'error') AS sub, event_type IN ('signup', 'view') AS home, json_extract_string(props, '$.k')::BIGINT % 5 + 1 AS inc FROM events),
b AS (SELECT *, sum(CASE WHEN sub AND home THEN inc ELSE 0 END) OVER w AS h, sum(CASE WHEN sub AND NOT home THEN inc ELSE 0 END) OVER w AS a, row_number() OVER (PARTITION BY game_id ORDER BY n) AS place FROM e WINDOW w AS (PARTITION BY game_id ORDER BY n)),
edges AS (
  SELECT game_id, g, period, n, 0 AS o, 720.0::DOUBLE AS s, h - CASE WHEN sub AND home THEN inc ELSE 0 END AS h, a - CASE WHEN sub AND NOT home THEN inc ELSE 0 END AS a FROM b QUALIFY row_number() OVER (PARTITION BY game_id, period ORDER BY n) = 1
  UNION ALL SELECT game_id, g, period, n, 1, secs, h, a FROM b WHERE sub),
cut AS (SELECT *, coalesce(lead(s) OVER (PARTITION BY game_id, period ORDER BY n, o), 0.0) AS t, coalesce(lead(n) OVER (PARTITION BY game_id ORDER BY n, o), (SELECT max(n) FROM e WHERE e.game_id = edges.game_id)) AS end_n FROM edges)"""
_SIX = "(SELECT string_agg(x::VARCHAR, '-' ORDER BY x) FROM (SELECT unnest(range({0}, {0} + 6)) AS x) WHERE x <> {0} + (5 + {1}) % 6)"


@query(f"WITH {_OLDER} SELECT game_id, period, s AS start_secs, t AS end_secs, n AS start_action, end_n AS end_action, {_SIX.format(0, 'h')} AS home_ids, {_SIX.format(10, 'a')} AS away_ids, false AS failed FROM cut WHERE g <> 7 AND t < s UNION ALL SELECT DISTINCT game_id, NULL::INTEGER, NULL::DOUBLE, NULL::DOUBLE, NULL::BIGINT, NULL::BIGINT, NULL, NULL, true FROM e WHERE g = 7")
def older_stints(t):
    """Stints of the older feed: a day's events of some users are a game of six against six, of whom one sits and comes in by
    a surname that three share; in every eighth game somebody on the bench is said to act first."""
    from pyspark.sql.window import Window

    k = F.get_json_object("props", "$.k").cast("bigint")
    sub, home = F.col("event_type").isin("signup", "error"), F.col("event_type").isin("signup", "view")
    e = t("events").select(
        game_of_day().alias("game_id"), F.col("event_id").alias("action_id"), (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("period"),
        (720 - F.floor(((F.hour("ts") % 6) * 3600 + F.minute("ts") * 60 + F.second("ts").cast("int")) / 30)).cast("double").alias("secs"), sub.alias("sub"), F.when(home, "home").otherwise("away").alias("team"), (k % 5 + 1).alias("inc"),
    )
    before = Window.partitionBy("game_id", "team").orderBy("action_id").rowsBetween(Window.unboundedPreceding, -1)
    bench = (5 + F.coalesce(F.sum(F.when(F.col("sub"), F.col("inc")).otherwise(0)).over(before), F.lit(0))) % 6
    first = F.row_number().over(Window.partitionBy("game_id").orderBy("action_id")) == 1
    acting = F.when(F.endswith("game_id", F.lit("-7")) & first, F.col("bench")).otherwise((F.col("bench") + F.col("inc")) % 6)
    names = F.array(*(F.lit(x) for x in ("Al Smith", "Jo Smith", "Cy Smith", "Di Šmid Jr.", "Ed O'Neal", "Flo Lee-Day")))
    text = F.concat(F.lit("SUB: "), F.regexp_replace(F.get(names, F.col("bench").cast("int")), r"^\S+ ", ""), F.lit(" FOR X"))
    plays = e.withColumn("bench", bench).withColumn("person", acting).withColumn("text", text).withColumn("person", F.col("person") + F.when(F.col("team") == "home", 0).otherwise(10))
    side = lambda k, team: F.struct((F.lit(k) + F.col("id")).alias("person"), F.lit(team).alias("team"), (F.col("id") < 5).alias("starter"), F.get(names, F.col("id").cast("int")).alias("name"))
    roster = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(5).cast("bigint")), lambda i: i)
    box_ = e.select("game_id").distinct().withColumn("id", F.explode(roster)).select("game_id", F.inline(F.array(side(0, "home"), side(10, "away"))))
    ids = lambda c: F.array_join(F.col(c).cast("array<string>"), "-").alias(c)
    got = older_feed.older_stints(plays, box_)
    return got.select("game_id", "period", "start_secs", "end_secs", "start_action", "end_action", ids("home_ids"), ids("away_ids"), F.col("problem").isNotNull().alias("failed")).where("NOT failed").unionByName(
        got.where("problem IS NOT NULL").select("game_id", F.lit(True).alias("failed")).distinct(), allowMissingColumns=True)


_SPELL_KINDS = (("signup", "sign"), ("purchase", "trade"), ("error", "waive"), ("click", "claim"), ("view", "twoway_sign"))
_EVENTS = "e AS (SELECT user_id::VARCHAR AS player_id, ts::DATE AS date, event_id AS seq, CASE event_type " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _SPELL_KINDS) + " END AS kind, 'T' || (event_id % 5) AS team FROM events)"


# Spells begin with every event but a waiver and end with the next one.  A trade carries the kind of the spell that it ends on;
# a claim looks at the spell that had ended before: the one that a waiver ended, or the one before the open one.
@query(f"""WITH RECURSIVE {_EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY player_id ORDER BY date, seq) AS k FROM e),
f AS (
  SELECT player_id, k, date, kind, team, CASE WHEN kind = 'waive' THEN NULL WHEN kind = 'twoway_sign' THEN 'two_way' ELSE 'standard' END AS open, NULL::VARCHAR AS last, NULL::DATE AS last_end FROM n WHERE k = 1
  UNION ALL
  SELECT n.player_id, n.k, n.date, n.kind, n.team,
         CASE n.kind WHEN 'waive' THEN NULL WHEN 'sign' THEN 'standard' WHEN 'twoway_sign' THEN 'two_way' WHEN 'trade' THEN coalesce(f.open, 'standard')
              ELSE CASE WHEN f.last IS NOT NULL AND n.date - f.last_end <= 7 THEN f.last ELSE 'standard' END END,
         coalesce(f.open, f.last), CASE WHEN f.open IS NULL THEN f.last_end ELSE n.date END
  FROM f JOIN n ON n.player_id = f.player_id AND n.k = f.k + 1)
SELECT player_id, open AS type, team, date AS start_date, lead(date) OVER (PARTITION BY player_id ORDER BY k) AS end_date FROM f QUALIFY open IS NOT NULL""")
def contract_intervals(t):
    kind = F.create_map(*(F.lit(x) for p in _SPELL_KINDS for x in p))[F.col("event_type")]
    e = t("events").select(F.col("user_id").cast("string").alias("player_id"), F.to_date("ts").alias("date"), F.col("event_id").alias("seq"), kind.alias("kind"), F.concat(F.lit("T"), F.col("event_id") % 5).alias("team"))
    return contracts.intervals(e)


@query(f"WITH {GAMES}, s AS (SELECT entity, season, count(*) FILTER (kind = 'F') AS n, bool_or(priority = '1-URGENT') AS signed, bool_or(kind = 'P') AS two FROM games GROUP BY ALL), a AS (SELECT entity, count(*) FILTER (n > 0 OR signed) AS yos, count(*) FILTER (signed AND n = 0) AS no_game, count(*) FILTER (two) AS twoway_seasons FROM s GROUP BY 1) SELECT entity AS player_id, yos, twoway_seasons, CASE WHEN yos <= 2 THEN 'two_years' WHEN yos = 3 THEN 'one_year' WHEN yos = 4 AND no_game > 0 THEN 'exception' ELSE 'ineligible' END AS status FROM a")
def eligibility(t):
    s = games(t).groupBy(F.col("entity").alias("player_id"), "season").agg(F.count_if(F.col("kind") == "F").alias("standard_games"), F.bool_or(F.col("priority") == "1-URGENT").alias("signed_standard"), F.bool_or(F.col("kind") == "P").alias("two_way"))
    return contracts.eligibility(s)


@query(f"WITH {GAMES}, m AS (SELECT entity, game, day, CASE WHEN kind <> 'P' THEN priority END AS to_team FROM games WHERE day <= DATE '1998-01-01' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY day DESC, game DESC) = 1) SELECT entity, to_team FROM m WHERE to_team IS NOT NULL")
def roster_asof(t):
    m = games(t).select("entity", F.col("game").alias("seq"), "day", F.when(F.col("kind") != "P", F.col("priority")).alias("to_team"))
    return contracts.roster_at(m, "entity", "day", F.lit("1998-01-01").cast("date")).select("entity", "to_team")


@query(f"WITH {GAMES}, u AS (SELECT entity, game, row_number() OVER (PARTITION BY entity ORDER BY day, game) AS n, count(*) OVER (PARTITION BY entity) AS used FROM games WHERE kind = 'F') SELECT entity, used, greatest(0, 5 - used) AS left_, (SELECT min(game) FROM u v WHERE v.entity = u.entity AND n = 5) AS limit_game FROM u GROUP BY entity, used")
def quota_ledger(t):
    """Games used of a quota of five, and the one that reaches it."""
    from pyspark.sql.window import Window

    u = games(t).where("kind = 'F'").withColumn("n", F.row_number().over(Window.partitionBy("entity").orderBy("day", "game")))
    a = u.groupBy("entity").agg(F.count(F.lit(1)).alias("used"), F.min(F.when(F.col("n") == 5, F.col("game"))).alias("limit_game"))
    return a.select("entity", "used", F.greatest(F.lit(0).cast("bigint"), 5 - F.col("used")).alias("left_"), "limit_game")


# A player is one of four of a team; games up to June are played, later ones to come; a quota is of 12 games.
_ROSTERED = "ros AS (SELECT *, team * 10 + player % 4 AS p, 'T' || team AS club FROM box)"


@query(f"""WITH {BOX}, {_ROSTERED},
sched AS (SELECT season, game, max(day) AS day, club, bool_and(month(day) <= 6) AS final FROM ros GROUP BY season, game, club),
bounds AS (SELECT season, min(day) AS f, max(day) AS l FROM sched GROUP BY 1),
sg AS (SELECT season, p, day, CASE WHEN tov % 3 = 0 THEN 'T' || (team + 1) ELSE club END AS club, CASE WHEN status = 'O' THEN 'feed' ELSE 'page' END AS source FROM ros WHERE flag = 'R' AND mp <= 12),
sign AS (SELECT season, p, day, club, source FROM sg QUALIFY row_number() OVER (PARTITION BY season, p ORDER BY source, day DESC, club DESC) = 1),
listed AS (SELECT season, p, club, min(day) AS seen, min(min(day)) OVER (PARTITION BY season) AS first_list FROM ros WHERE line = 1 GROUP BY season, p, club),
r AS (SELECT li.*, CASE WHEN s.club = li.club THEN s.day WHEN seen > first_list AND seen > f THEN seen END AS signed, CASE WHEN s.club = li.club THEN s.source WHEN seen > first_list AND seen > f THEN 'list' ELSE 'none' END AS src, f, l
      FROM listed li JOIN bounds USING (season) LEFT JOIN sign s USING (season, p)),
q AS (SELECT *, CASE WHEN signed IS NULL OR signed <= f THEN 12 ELSE round_even(12 * (l - signed + 1) / (l - f + 1)::DOUBLE, 0) END::BIGINT AS quota FROM r),
app AS (SELECT season, p, club, game, max(day) AS day, bool_or(flag <> 'N') AS active, bool_or(mp > 9) AS played, sum(mp)::BIGINT AS seconds FROM ros GROUP BY season, p, club, game),
u AS (SELECT *, (SELECT count(*) FROM app a WHERE a.season = q.season AND a.p = q.p AND a.club = q.club AND active AND day >= coalesce(signed, f)) AS used FROM q),
v AS (SELECT *, greatest(0, quota - used) AS rest FROM u),
ahead AS (SELECT season, club, game, day, row_number() OVER (PARTITION BY season, club ORDER BY day, game) AS n, count(*) OVER (PARTITION BY season, club) AS total FROM sched WHERE NOT final),
late AS (SELECT season, club, game FROM sched WHERE final QUALIFY row_number() OVER (PARTITION BY season, club ORDER BY day DESC, game DESC) <= 10),
ln AS (SELECT season, club, count(*) AS n FROM late GROUP BY ALL),
lp AS (SELECT season, p, club, count(*) FILTER (active) AS a, count(*) FILTER (played) AS b, sum(seconds)::BIGINT AS c FROM app JOIN late USING (season, club, game) GROUP BY ALL)
SELECT v.season, v.p AS player, v.club AS team, signed, src AS signed_source, quota, used, rest AS left_, coalesce(t.total, 0) AS team_games_left, h.game AS limit_game, h.day AS limit_day, rest <= coalesce(t.total, 0) AS can_reach,
       coalesce(ln.n, 0) AS recent_games, coalesce(lp.a, 0) AS recent_active, coalesce(lp.b, 0) AS recent_played, coalesce(lp.c, 0)::BIGINT AS recent_seconds
FROM v LEFT JOIN (SELECT DISTINCT season, club, total FROM ahead) t USING (season, club) LEFT JOIN ahead h ON h.season = v.season AND h.club = v.club AND h.n = rest LEFT JOIN ln ON ln.season = v.season AND ln.club = v.club LEFT JOIN lp ON lp.season = v.season AND lp.p = v.p AND lp.club = v.club""")
def quota_tracker(t):
    """Quotas prorated by the day of signing, when they are used up, and the team's last ten games, of all seasons."""
    r = box(t).withColumn("club", F.concat(F.lit("T"), "team")).withColumn("p", F.col("team") * 10 + F.col("player") % 4)
    own = [F.col("p").alias("player"), F.col("club").alias("team")]
    schedule = r.select("season", "game", "day", F.col("club").alias("home"), F.lit(None).cast("string").alias("away"), (F.month("day") <= 6).alias("final")).distinct()
    signings = r.where("flag = 'R' AND mp <= 12").select("season", own[0], "day", F.when(F.col("tov") % 3 == 0, F.concat(F.lit("T"), F.col("team") + 1)).otherwise(F.col("club")).alias("team"), F.when(F.col("status") == "O", "feed").otherwise("page").alias("source"), F.when(F.col("status") == "O", 0).otherwise(1).alias("rank"))
    seen = r.where("line = 1").select("season", *own, "day").groupBy("season", "player", "team").agg(F.min("day").alias("first_seen"))
    listed = seen.join(seen.groupBy("season").agg(F.min("first_seen").alias("first_list")), "season")
    appearances = r.select("season", *own, "game", "day", "flag", "mp").groupBy("season", "player", "team", "game").agg(F.max("day").alias("day"), F.bool_or(F.col("flag") != "N").alias("active"), F.bool_or(F.col("mp") > 9).alias("played"), F.sum("mp").alias("seconds"))
    got = quota.tracker(listed, signings, appearances, schedule, 12)
    return got.drop("first_seen", "first_list").withColumnRenamed("left", "left_")


@query(f"WITH {GAMES}, last AS (SELECT entity, max(day) AS d FROM games GROUP BY 1) SELECT c_custkey AS id, CASE WHEN d >= DATE '2001-06-01' THEN 'rostered' WHEN d IS NOT NULL THEN 'free_agent' END AS status FROM customer LEFT JOIN last ON entity = c_custkey")
def roster_status(t):
    last = games(t).groupBy("entity").agg(F.max("day").alias("d"))
    c = t("customer").join(last, F.col("entity") == F.col("c_custkey"), "left")
    return c.select(F.col("c_custkey").alias("id"), F.when(F.col("d") >= F.lit("2001-06-01").cast("date"), "rostered").when(F.col("d").isNotNull(), "free_agent").alias("status"))


@query("SELECT c_custkey AS id, regexp_replace(lower(c_name), '[^a-z]', '', 'g') AS key FROM customer")
def name_normalise_letters(t):
    return t("customer").select(F.col("c_custkey").alias("id"), T.letters_only(F.col("c_name"), lambda x: x).alias("key"))


@query()
def name_normalise_folded(t):
    d = t("documents").select("doc_id", F.col("text").alias("name"))
    return d.select("doc_id", T.name_key(F.col("name")).alias("key"), T.name_bare(F.col("name")).alias("bare"), T.name_base(F.col("name")).alias("base"))


def _overlaps(words: str, least: float) -> str:
    return f"w AS ({words}) SELECT a.id AS a, b.id AS b, round(len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s)))::DOUBLE, 6) AS jaccard FROM w a JOIN w b ON a.id < b.id WHERE len(list_intersect(a.s, b.s)) / len(list_distinct(list_concat(a.s, b.s)))::DOUBLE >= {least}"


@query("WITH d AS (SELECT min(p_partkey) AS id, lower(concat_ws(' ', p_name, p_brand, p_type)) AS s FROM part GROUP BY 2), " + _overlaps("SELECT id, list_distinct(string_split(s, ' ')) AS s FROM d", 0.6))
def identity_jaccard(t):
    """Token overlap of 0.6 or more between the distinct descriptions of all parts, each by its least part."""
    d = t("part").groupBy(F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("s")).agg(F.min("p_partkey").alias("id"))
    return I.token_pairs(d, "id", "s", 0.6).withColumn("jaccard", F.round("jaccard", 6))


@query("WITH " + _overlaps("SELECT item_id AS id, list_distinct(string_split(lower(text), ' ')) AS s FROM benchmark", 0.05))
def identity_jaccard_tokens(t):
    """Token overlap of 0.05 or more between all passages; no two of them have more than a tenth of their tokens in common."""
    w = t("benchmark").select(F.col("item_id").alias("id"), F.lower("text").alias("s"))
    return I.token_pairs(w, "id", "s", 0.05).withColumn("jaccard", F.round("jaccard", 6))


_DESCRIBED = "named AS (SELECT p_partkey AS player, lower(concat_ws(' ', p_name, p_brand, p_type)) AS key FROM part UNION ALL SELECT p_partkey, lower(concat_ws(' ', p_name, p_brand)) FROM part WHERE p_size > 45)"


def _described(t):
    """Parts by their descriptions, and large ones by a shorter alias too."""
    key = lambda *c: F.lower(F.concat_ws(" ", *c)).alias("key")
    p = t("part")
    return p.select(F.col("p_partkey").alias("player"), key("p_name", "p_brand", "p_type")).unionByName(p.where("p_size > 45").select(F.col("p_partkey").alias("player"), key("p_name", "p_brand")))


@query(f"""WITH {_DESCRIBED}, playing AS (SELECT DISTINCT l_partkey AS player, true AS is_on FROM lineitem WHERE l_quantity >= 49),
k AS (SELECT key, min(player) AS a, max(player) AS b, min(player) FILTER (is_on) AS c, max(player) FILTER (is_on) AS d, count(DISTINCT player) AS n FROM named LEFT JOIN playing USING (player) GROUP BY 1)
SELECT m.player AS mention, m.key, CASE WHEN n = 1 THEN a WHEN c = d THEN c END AS player FROM named m LEFT JOIN k USING (key)""")
def name_match(t):
    """Each description to the one part it can mean, namesakes told apart by whether they appear in a large line."""
    playing = t("lineitem").where("l_quantity >= 49").select(F.col("l_partkey").alias("player"))
    mentions = _described(t).select(F.col("player").alias("mention"), "key")
    return I.match_names(mentions, "key", _described(t), playing)


@query(f"""WITH {_DESCRIBED}, ln AS (SELECT l_partkey AS source_id, lower(concat_ws(' ', p_name, p_brand, p_type)) AS key, l_suppkey % 5 AS team FROM lineitem JOIN part ON p_partkey = l_partkey),
s AS (SELECT source_id, max(key) AS key, max(team) AS team, count(*) AS occurrences FROM ln GROUP BY 1),
linked AS (SELECT p_partkey AS source_id, p_partkey AS player FROM part WHERE p_size % 10 = 0),
sole AS (SELECT key, min(player) AS p, count(DISTINCT player) AS n FROM named WHERE player NOT IN (SELECT player FROM linked) GROUP BY 1),
ros AS (SELECT l_partkey AS p, max(l_suppkey % 5) AS rt FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM lineitem JOIN orders ON o_orderkey = l_orderkey) GROUP BY 1),
d AS (SELECT s.*, linked.player AS lp, sole.p, coalesce(n, 0) AS n, rt FROM s LEFT JOIN linked USING (source_id) LEFT JOIN sole USING (key) LEFT JOIN ros ON ros.p = sole.p),
w AS (SELECT *, CASE WHEN lp IS NOT NULL THEN 'linked' WHEN n = 0 THEN 'unknown' WHEN n > 1 THEN 'namesakes' WHEN rt IS NULL THEN 'no_roster' WHEN team <> rt THEN 'other_team' ELSE 'roster' END AS why FROM d)
SELECT source_id, key, team, occurrences, CASE WHEN why IN ('linked', 'roster', 'no_roster') THEN 'link' ELSE 'review' END AS decision, CASE WHEN why = 'linked' THEN lp WHEN why IN ('roster', 'no_roster', 'other_team') THEN p END AS player, why, n AS candidates FROM w""")
def staged_links(t):
    """Parts that lines name, linked by description unless the last year's lines have them in another team."""
    part = t("part").select(F.col("p_partkey").alias("player"), F.col("p_size"), F.lower(F.concat_ws(" ", "p_name", "p_brand", "p_type")).alias("key"))
    ln = t("lineitem").select("l_orderkey", F.col("l_partkey").alias("player"), (F.col("l_suppkey") % 5).alias("team"))
    staged = ln.join(part, "player").select(F.col("player").alias("source_id"), "key", "team", F.lit(None).cast("bigint").alias("occurrences"))
    linked = part.where("p_size % 10 = 0").select(F.col("player").alias("source_id"), "player")
    roster = ln.join(t("orders").select(F.col("o_orderkey").alias("l_orderkey"), F.year("o_orderdate").alias("day")), "l_orderkey").select("player", "team", "day")
    return I.staged_links(staged, _described(t), linked, roster)


_MATES = """ppl AS (SELECT c_custkey AS person, CASE WHEN c_custkey % 17 <> 0 THEN c_custkey // 2 END AS player, CASE c_custkey % 13 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE 70 + c_custkey % 7 END AS height, CASE WHEN c_custkey % 11 <> 0 THEN replace(substr(c_mktsegment, 1, 1), 'B', 'C') END AS position FROM customer),
st AS (SELECT season, mp AS seconds, (player % 3) AS home, 3 + team % 3 AS away, list_transform(range(0, 5), lambda i: entity + i * 3) AS hf, list_transform(range(0, 5), lambda i: entity // 3 + i * 4) AS af, tov AS hp, orb AS ap, line AS hq, 1 + tov % 4 AS aq FROM box WHERE flag <> 'N'),
sd AS (SELECT season, seconds, home AS team, hf AS five, hp AS pf, ap AS pa, hq AS qf, aq AS qa FROM st UNION ALL SELECT season, seconds, away, af, ap, hp, aq, hq FROM st),
fv AS (SELECT season, team, five, sum(seconds) AS sec, sum(pf) AS pf, sum(pa) AS pa, sum(qf) AS qf, sum(qa) AS qa FROM sd GROUP BY ALL),
ea AS (SELECT fv.*, person, ppl.player, CASE WHEN height <> 0 THEN height END AS height, position FROM (SELECT *, unnest(five) AS person FROM fv) fv LEFT JOIN ppl USING (person)),
tg AS (SELECT season, team, five, count(height) AS hs, max(height) AS top, list({'player': player, 'position': position}) AS m FROM ea GROUP BY ALL),
mt AS (SELECT ea.*, hs = 5 AS measured, height = top AS tall, list_filter(m, lambda x: x.player IS NOT NULL AND x.player <> ea.player) AS mates FROM ea JOIN tg USING (season, team, five) WHERE ea.player IS NOT NULL),
pl AS (SELECT *, len(mates) = 4 AND len(list_filter(mates, lambda x: x.position IS NOT NULL)) = 4 AS placed, len(list_filter(mates, lambda x: x.position = 'C')) > 0 AS c FROM mt),
own AS (SELECT season, team, player, sum(sec)::BIGINT AS seconds, sum(pf)::BIGINT AS pts_for, sum(pa)::BIGINT AS pts_against, sum(qf)::BIGINT AS poss_for, sum(qa)::BIGINT AS poss_against, coalesce(sum(sec) FILTER (placed), 0) AS ps, coalesce(sum(sec) FILTER (placed AND c), 0) AS cs, coalesce(sum(sec) FILTER (measured), 0) AS ms, coalesce(sum(sec) FILTER (measured AND tall), 0) AS ts FROM pl GROUP BY ALL),
tt AS (SELECT season, team, sum(pf) AS f, sum(pa) AS a, sum(qf) AS q, sum(qa) AS r FROM fv GROUP BY ALL),
rt AS (SELECT own.*, 100 * pts_for / poss_for::DOUBLE - 100 * pts_against / poss_against::DOUBLE AS net, CASE WHEN q - poss_for > 20 AND r - poss_against > 20 THEN 100 * (f - pts_for) / (q - poss_for)::DOUBLE - 100 * (a - pts_against) / (r - poss_against)::DOUBLE END AS off FROM own JOIN tt USING (season, team))"""


@query(f"WITH {BOX}, {_MATES} SELECT season, team, player, seconds, pts_for, pts_against, poss_for, poss_against, round(net, 6) AS on_net, round(off, 6) AS off_net, round(net - off, 6) AS on_off, round(cs / nullif(ps, 0)::DOUBLE, 6) AS with_centre, round(ps / seconds::DOUBLE, 6) AS position_coverage, round(ts / nullif(ms, 0)::DOUBLE, 6) AS tallest, round(ms / seconds::DOUBLE, 6) AS height_coverage FROM rt")
def lineup_measures(t):
    """Each line as a stint of two fives: every third, and every fourth, of the customers by the order's own."""
    b = box(t)
    five = lambda first, step: F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: first + i * step)
    stints = b.select(
        "season", F.col("mp").alias("seconds"), (F.col("player") % 3).alias("home"), (3 + F.col("team") % 3).alias("away"), five(F.col("entity"), 3).alias("home_ids"), five(F.floor(F.col("entity") / 3), 4).alias("away_ids"),
        F.col("tov").alias("home_pts"), F.col("orb").alias("away_pts"), F.col("line").alias("home_poss"), (1 + F.col("tov") % 4).alias("away_poss"), (F.col("flag") != "N").alias("reliable"),
    )
    k = F.col("c_custkey")
    people = t("customer").select(
        k.alias("person"), F.when(k % 17 != 0, F.floor(k / 2)).alias("player"), F.when(k % 13 == 0, None).when(k % 13 == 1, 0).otherwise(70 + k % 7).alias("height"), F.when(k % 11 != 0, F.translate(F.substring("c_mktsegment", 1, 1), "B", "C")).alias("position"),
    )
    got = lineup_measures_.player_measures(stints, people, line_parts(t)).drop("on_ortg", "on_drtg")
    return got.select(*(F.round(c, 6).alias(c) if d == "double" else c for c, d in got.dtypes))


def _people(t, prefix: str):
    c = t("customer")
    name = F.concat(F.lit("Ann "), F.translate(F.right("c_name", F.lit(4)), "0123456789", "abcdefghij"), F.when(F.col("c_custkey") % 5 == 0, " Jr.").otherwise(""))
    born = F.date_add(F.lit("1980-01-01").cast("date"), (F.col("c_custkey") % 3000).cast("int"))
    return c.select(F.col("c_custkey").alias(f"{prefix}id"), name.alias(f"{prefix}name"), born.alias(f"{prefix}birthdate"), (F.col("c_custkey") % 9).alias(f"{prefix}draft"), F.lit(None).cast("string").alias(f"{prefix}school"), (F.col("c_custkey") % 12 + 70).alias(f"{prefix}height"))


def _both(t):
    return _people(t, ""), _people(t, "c_").withColumn("confirmed", F.col("c_id") % 2 == 0)


@query()
def identity_score(t):
    return I.scored_pairs(*_both(t)).select("id", "c_id", "sim", "score", "decision")


@query()
def rank_candidates(t):
    return I.best_pairs(*_both(t)).select("id", "c_id", "place", "score")


@query("WITH o AS (SELECT s_suppkey AS source_id, right(s_name, 3) AS name_key, CASE WHEN s_suppkey % 3 > 0 THEN s_nationkey END AS birthdate FROM supplier), r AS (SELECT c_custkey AS player_id, right(c_name, 3) AS name_key, c_nationkey AS birthdate FROM customer WHERE c_custkey % 2 = 0), ids AS (SELECT s_suppkey AS source_id, s_suppkey * 2 AS player_id FROM supplier WHERE s_suppkey % 4 = 0), n AS (SELECT r.*, ids.player_id IS NOT NULL AS taken FROM r LEFT JOIN (SELECT DISTINCT player_id FROM ids) ids USING (player_id)), j AS (SELECT o.*, count(*) FILTER (NOT taken) AS free, count(*) FILTER (taken) AS tk, min(player_id) FILTER (NOT taken) AS cand, min(n.birthdate) FILTER (NOT taken) AS cb FROM o LEFT JOIN n USING (name_key) GROUP BY o.source_id, o.name_key, o.birthdate), a AS (SELECT j.*, ids.player_id AS linked, CASE WHEN ids.player_id IS NOT NULL THEN 'already' WHEN free = 1 AND birthdate = cb THEN 'link' WHEN free = 1 AND birthdate IS NULL THEN 'stage' WHEN free > 1 THEN 'stage' WHEN free = 0 AND tk > 0 THEN 'stage' ELSE 'create' END AS action FROM j LEFT JOIN ids USING (source_id)) SELECT source_id, name_key, birthdate, action, CASE WHEN action = 'stage' THEN CASE WHEN free = 1 THEN 0.6 WHEN free > 1 THEN 0.4 ELSE 0.3 END ELSE 1.0 END::DOUBLE AS confidence, CASE WHEN action = 'already' THEN linked WHEN action = 'link' OR (free = 1 AND action = 'stage') THEN cand END AS player_id FROM a")
def three_tier_resolve(t):
    s, c = t("supplier"), t("customer")
    o = s.select(F.col("s_suppkey").alias("source_id"), F.right("s_name", F.lit(3)).alias("name_key"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_nationkey")).alias("birthdate"))
    r = c.where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("player_id"), F.right("c_name", F.lit(3)).alias("name_key"), F.col("c_nationkey").alias("birthdate"))
    ids = s.where("s_suppkey % 4 = 0").select(F.col("s_suppkey").alias("source_id"), (F.col("s_suppkey") * 2).alias("player_id"))
    return I.resolve_tiers(o, r, ids)


@query("WITH u AS (SELECT c_custkey AS item FROM customer WHERE c_custkey % 10 = 0 AND c_custkey % 30 <> 0), c AS (SELECT c_custkey - c_custkey % 10 AS item, c_custkey AS candidate, abs(c_acctbal) AS score FROM customer WHERE c_custkey % 10 <> 0), r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, candidate) AS place FROM c) SELECT item, string_agg(candidate, ',' ORDER BY place) AS candidates FROM u LEFT JOIN (SELECT * FROM r WHERE place <= 6) USING (item) GROUP BY 1")
def review_queue(t):
    c = t("customer")
    unresolved = c.where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("item"))
    ignored = c.where("c_custkey % 30 = 0").select(F.col("c_custkey").alias("item"))
    cand = c.where("c_custkey % 10 <> 0").select((F.col("c_custkey") - F.col("c_custkey") % 10).alias("item"), F.col("c_custkey").alias("candidate"), F.abs("c_acctbal").alias("score"), F.lit("near").alias("why"))
    q = I.review_queue(unresolved, cand, ignored)
    return q.select("item", F.array_join(F.transform("candidates", lambda x: x["candidate"].cast("string")), ",").alias("candidates"))


@query(f"WITH {GAMES} SELECT entity AS item, kind AS action FROM games QUALIFY row_number() OVER (PARTITION BY entity ORDER BY day DESC, kind) = 1")
def decision_apply(t):
    return I.decisions(games(t).select(F.col("entity").alias("item"), F.col("day").alias("decided_at"), F.col("kind").alias("action"))).select("item", "action")


def _cases(column: str, classes, other: str) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({column}, '{p.replace(chr(39), chr(39) * 2)}') THEN '{n}'" for n, p in classes) + f" ELSE {other} END"


_MADE = "(item_id || ' the club ' || CASE item_id % 7 WHEN 0 THEN 'Traded him in a 3-team trade' WHEN 1 THEN 'waived and signed' WHEN 2 THEN 'signed to an Exhibit 10' WHEN 3 THEN 'recalled' WHEN 4 THEN 'named him head coach' WHEN 5 THEN 'two-way option' ELSE text END)"


@query(f"SELECT item_id, {_cases('t', TRANSACTIONS, chr(39) + 'other' + chr(39))} AS class FROM (SELECT item_id, lower({_MADE}) AS t FROM benchmark)")
def ordered_regex_classifier(t):
    b = t("benchmark").selectExpr("item_id", f"{_MADE} AS t")
    return b.select("item_id", classify.transaction_class(F.col("t")).alias("class"))


_HURT = "CASE item_id % 6 WHEN 0 THEN 'Injury/Illness - Left Knee; Soreness' WHEN 1 THEN 'Injury/Illness - Right High Ankle Sprain; Injury Management' WHEN 2 THEN 'Injury/Illness - Low Back Spasms' WHEN 3 THEN 'Rest' WHEN 4 THEN 'G League - Two-Way' ELSE 'Injury/Illness - Illness' END"


@query(f"SELECT item_id, v[1] AS category, v[2] AS side, v[3] AS part, v[4] AS region, v[5] AS injury FROM (SELECT item_id, CASE item_id % 6 WHEN 0 THEN ['injury', 'left', 'knee', 'knee', 'soreness'] WHEN 1 THEN ['injury', 'right', 'high ankle', 'ankle', 'sprain'] WHEN 2 THEN ['injury', NULL, 'low back', 'back', 'spasms'] WHEN 3 THEN ['rest', NULL, NULL, NULL, NULL] WHEN 4 THEN ['two_way', NULL, NULL, NULL, NULL] ELSE ['injury', NULL, 'illness', 'illness', 'illness'] END AS v FROM benchmark)")
def reason_parser(t):
    b = t("benchmark").selectExpr("item_id", f"{_HURT} AS why")
    return classify.injury_reason(b, "why").drop("why")


_LINK = """'<a href="/player/x/' || c_custkey || '">' || c_name || '</a>'"""
_CLUBS = """'<a href="/team/1">N' || c_nationkey || '</a>'""", """'<a href="/team/2">S ' || c_mktsegment || '</a>'"""
_MOVES = f"""'<h3>Mar 4, 2021</h3><ul><li>' || CASE c_custkey % 5 WHEN 0 THEN {_LINK} || ' signed a two-way contract with the ' || {_CLUBS[0]} || ' and ' || {_CLUBS[1]} WHEN 1 THEN 'The ' || {_CLUBS[0]} || ' recalled ' || {_LINK} || ' from the ' || {_CLUBS[1]}
 WHEN 2 THEN 'The  placed the contract of ' || {_LINK} || ' on waivers' WHEN 3 THEN {_LINK} || ' returned to the ' || {_CLUBS[1]} || ' after an NBA call up' ELSE {_LINK} || ' went home' END || '.</li></ul>'"""


@query("SELECT c_custkey AS id, DATE '2021-03-04' AS txn_date, ['twoway_sign', 'recall', 'gl_waive', 'return_from_callup', 'other'][(c_custkey % 5 + 1)::INT] AS kind, c_name AS name, c_custkey::VARCHAR AS player_id, CASE WHEN c_custkey % 5 = 1 THEN 'S ' || c_mktsegment END AS from_team, CASE WHEN c_custkey % 5 IN (0, 3) THEN 'S ' || c_mktsegment END AS to_team, CASE WHEN c_custkey % 5 <= 1 THEN 'N' || c_nationkey END AS nba_team FROM customer")
def sentence_moves(t):
    """A page of one sentence for each customer."""
    pages = t("customer").selectExpr("c_custkey AS id", f"{_MOVES} AS html")
    return transactions.sentence_moves(pages, "id", "html").select("id", "txn_date", "kind", "name", "player_id", "from_team", "to_team", "nba_team")


_TRADE = """'<li><span>May 9, 2022</span><p>The <a data-attr-from="AAA" href="/t">A</a> traded <a href="/players/a/p' || c_custkey || '.html">' || c_name || '</a> to the <a data-attr-to="BBB" href="/t">B</a> for ' || CASE WHEN c_custkey % 3 = 0 THEN 'cash' ELSE 'a ' || (2020 + c_nationkey) || ' second-round pick' END || '.</p></li>'"""


@query("SELECT c_custkey AS id, 'T20220509_000' AS transaction_id, 'player' AS item_type, 'p' || c_custkey AS player_id, 'AAA' AS from_team, 'BBB' AS to_team, NULL::INTEGER AS pick_year, NULL::INTEGER AS pick_round FROM customer UNION ALL SELECT c_custkey, 'T20220509_000', CASE WHEN c_custkey % 3 = 0 THEN 'cash' ELSE 'pick' END, NULL, 'BBB', 'AAA', CASE WHEN c_custkey % 3 <> 0 THEN (2020 + c_nationkey)::INTEGER END, CASE WHEN c_custkey % 3 <> 0 THEN 2 END FROM customer")
def entry_items(t):
    """A page of one trade for each customer, with what goes which way."""
    pages = t("customer").selectExpr("c_custkey AS id", f"{_TRADE} AS html")
    return transactions.entry_items(transactions.entries(pages, "id", "html"), "id").select("id", "transaction_id", "item_type", "player_id", "from_team", "to_team", "pick_year", "pick_round")


@query("SELECT page_id, (generate_subscripts(h, 1) - 1)::INTEGER AS position, unnest(h) AS href FROM (SELECT page_id, regexp_extract_all(html, 'href=\"([^\"]*)\"', 1) AS h FROM pages)")
def html_links(t):
    return classify.links(t("pages"), "page_id", "html")


def _box_pages(t):
    """Box pages of the games of two teams: a table for either, the away one within a comment; who had no rebound didn't
    play, and a line that parts the table follows whoever had more than five turnovers."""
    lines = two_teams(t)
    cell = lambda stat, x: F.concat(F.lit(f'<td data-stat="{stat}">'), x, F.lit("</td>"))
    text = lambda c: F.col(c).cast("string")
    played = F.concat(cell("mp", F.concat(text("mp"), F.lit(":0"), text("orb"))), cell("pts", text("pts")), cell("orb", text("orb")))
    body = F.when(F.col("orb") == 0, F.concat(F.lit('<td data-stat="reason" colspan="3">Line '), text("line"), F.lit("</td>"))).otherwise(played)
    row = F.concat(F.lit('<tr><th data-stat="player" data-append-csv="'), text("player"), F.lit('">P <i>'), text("player"), F.lit("</i></th>"), body, F.lit("</tr>"), F.when(F.col("tov") > 5, '<tr class="over thead"><th>Reserves</th></tr>').otherwise(""))
    side = F.when(F.col("team") == F.col("home"), "HOM").otherwise("AWY")
    # A game has at most seven lines.
    rows = lines.groupBy("game", side.alias("side")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "player", "pts", "mp", row.alias("row")))), lambda x: x["row"]), "").alias("rows"))
    table = F.concat(F.lit('<table id="box-'), F.col("side"), F.lit('-game-basic"><thead><tr><th rowspan=1>Who</th><th colspan=3>What</th></tr></thead><tbody>'), F.col("rows"), F.lit("</tbody></table>"))
    hidden = F.when(F.col("side") == "AWY", F.concat(F.lit("<!-- "), table, F.lit(" -->"))).otherwise(table)
    return rows.groupBy("game").agg(F.concat(F.lit("<html><body>"), F.array_join(F.array_sort(F.collect_list(hidden)), "<hr>"), F.lit("</body></html>")).alias("html"), F.max("side").alias("home"))


_PAGES = f"WITH {TWO}, p AS (SELECT *, CASE WHEN team = home THEN 'HOM' ELSE 'AWY' END AS side, row_number() OVER w AS n, coalesce(sum((tov > 5)::INTEGER) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS parts, sum((orb <> 0)::INTEGER) OVER w AS nth FROM two WINDOW w AS (PARTITION BY game, team ORDER BY line, player, pts, mp))"


@query(f"{_PAGES} SELECT game, 'box-' || side || '-game-basic' AS table_id, (n + parts)::INTEGER AS row_no, 'P ' || player AS text, true AS header FROM p UNION ALL SELECT game, 'box-' || side || '-game-basic', (n + parts + 1)::INTEGER, 'Reserves', true FROM p WHERE tov > 5 UNION ALL SELECT DISTINCT game, 'box-' || side || '-game-basic', 0, 'Who', true FROM p")
def html_table_cells(t):
    """The first cells of all rows of the box pages' tables."""
    return pages.cells(_box_pages(t), ["game"], "html").where("col_no = 0").select("game", "table_id", "row_no", "text", "header")


@query(f"{_PAGES} SELECT game, side AS team, CASE side WHEN 'HOM' THEN 'AWY' ELSE 'HOM' END AS opponent, side = 'HOM' AS is_home, player::VARCHAR AS player, orb <> 0 AND parts = 0 AND nth <= 5 AS started, orb <> 0 AS played, CASE WHEN orb = 0 THEN 'Line ' || line END AS dnp_reason, CASE WHEN orb <> 0 THEN (mp * 60 + orb)::INTEGER END AS seconds_played, CASE WHEN orb <> 0 THEN orb::INTEGER END AS orb, CASE WHEN orb <> 0 THEN pts::INTEGER END AS pts FROM p")
def box_page_lines(t):
    """Players' lines read off the box pages."""
    cells, n = pages.cells(_box_pages(t), ["game", "home"], "html"), line_parts(t)
    lines = pages.box_lines(cells.repartition(n, "game") if n else cells, ["game"], "home")
    return lines.select("game", "team", "opponent", "is_home", "player", "started", "played", "dnp_reason", "seconds_played", "orb", "pts")


@query("SELECT doc_id, length(text) AS n, md5(text) AS digest FROM documents WHERE text IS NOT NULL")
def mojibake(t):
    """Texts broken as Latin-1 and repaired again, where that can be done."""
    d = t("documents").where("text IS NOT NULL")
    broken = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    whole = d.select("doc_id", T.repair_mojibake(broken).alias("text"))
    return whole.select("doc_id", F.length("text").cast("bigint").alias("n"), F.md5("text").alias("digest"))


@query("SELECT l_orderkey AS game, l_linenumber::BIGINT AS line, (l_quantity::BIGINT * 60 + l_linenumber)::BIGINT AS seconds, (6 * 12 + l_linenumber)::BIGINT AS inches, CASE WHEN l_linenumber <= 4 THEN l_linenumber * 720 - 30 ELSE 2880 + (l_linenumber - 4) * 300 - 30 END::BIGINT AS elapsed FROM lineitem")
def unit_parse(t):
    x = t("lineitem").select(F.col("l_orderkey").alias("game"), F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_quantity").cast("bigint").alias("q"))
    clock = F.concat(F.col("q").cast("string"), F.lit(":"), F.lpad(F.col("line").cast("string"), 2, "0"))
    return x.select("game", "line", T.clock_seconds(clock).alias("seconds"), T.height_inches(F.concat(F.lit("6-"), F.col("line").cast("string"))).alias("inches"), T.elapsed_seconds(F.col("line"), F.lit(30)).cast("bigint").alias("elapsed"))


@query("SELECT l_orderkey AS game, l_linenumber::BIGINT AS line, (l_quantity * 60 + l_linenumber + 0.5)::DOUBLE AS seconds FROM lineitem")
def clock_parse(t):
    x = t("lineitem")
    iso = F.concat(F.lit("PT"), F.col("l_quantity").cast("int").cast("string"), F.lit("M"), F.lpad(F.col("l_linenumber").cast("string"), 2, "0"), F.lit(".50S"))
    return x.select(F.col("l_orderkey").alias("game"), F.col("l_linenumber").cast("bigint").alias("line"), T.iso_clock_seconds(iso).alias("seconds"))




@query(f"WITH {TWO} SELECT game, player::VARCHAR AS person, team = home AS is_home, CASE WHEN team = home THEN home ELSE away END::VARCHAR AS team, CASE WHEN team = home THEN away ELSE home END::VARCHAR AS opponent, 'P ' || player AS name, line <= 3 AS started, orb <> 0 AS played, CASE WHEN orb = 0 THEN CASE WHEN tov = 0 THEN 'Did Not Play' ELSE 'Line ' || line END END AS dnp_reason, CASE WHEN orb <> 0 THEN (mp * 60 + orb)::INTEGER END AS seconds_played, CASE WHEN orb <> 0 THEN pts::INTEGER END AS pts, tov::INTEGER AS tov, (tov - orb)::INTEGER AS plus_minus FROM two")
def feed_box_lines(t):
    """Box lines of payloads without a fixed schema, one for each game of two teams; who had no rebound didn't play."""
    played = F.col("orb") != 0
    minutes = F.when(played, F.concat(F.col("mp").cast("string"), F.lit(":0"), F.col("orb").cast("string"))).otherwise("")
    stats = F.struct(minutes.alias("minutes"), F.when(played, F.col("pts")).alias("points"), F.col("tov").alias("turnovers"), (F.col("tov") - F.col("orb")).cast("double").alias("plusMinusPoints"))
    comment = F.when(F.col("tov") != 0, F.concat(F.lit(" Line "), F.col("line").cast("string")))
    one = F.struct(F.col("player").alias("personId"), F.lit("P").alias("firstName"), F.col("player").cast("string").alias("familyName"), F.when(F.col("line") <= 3, "G").otherwise(" ").alias("position"), comment.alias("comment"), stats.alias("statistics"))
    team = lambda c: F.struct(F.first(c).cast("string").alias("teamTricode"), F.collect_list(F.when(F.col("team") == F.col(c), one)).alias("players")).alias(f"{c}Team")
    # A game has at most seven lines.
    payloads = two_teams(t).groupBy("game").agg(F.to_json(F.struct(F.struct(team("home"), team("away")).alias("boxScoreTraditional"))).alias("payload"))
    lines = feeds.traditional_lines(payloads, ["game"], "payload")
    return lines.select("game", "person", "is_home", "team", "opponent", "name", "started", "played", "dnp_reason", "seconds_played", "pts", "tov", "plus_minus")


_ACTS = """a AS (SELECT strftime(ts, '%Y-%m-%d') || '-' || user_id % 8 AS game, event_id AS n, event_type AS e, json_extract_string(props, '$.k')::BIGINT AS k FROM events),
s AS (SELECT *, k % 10 + 1 AS person, n % 3 = 0 AS made, CASE e WHEN 'click' THEN 2 WHEN 'view' THEN 3 WHEN 'purchase' THEN 1 ELSE 0 END AS pts FROM a)"""


@query(f"WITH {_ACTS} SELECT game, n AS action_id, person, CASE WHEN e IN ('click', 'view') THEN CASE WHEN made THEN 'Made Shot' ELSE 'Missed Shot' END WHEN e = 'purchase' THEN 'Free Throw' WHEN e = 'signup' THEN 'Turnover' ELSE 'Foul' END AS kind, CASE WHEN e IN ('click', 'view') THEN CASE WHEN k % 2 = 0 THEN 'Running Layup Shot' ELSE 'Layup Shot' END WHEN e = 'purchase' THEN 'Free Throw 1 of 2' WHEN e = 'signup' THEN CASE WHEN k % 2 = 0 THEN '3 Second Violation' ELSE 'Bad Pass' END ELSE 'Loose Ball' END AS sub_kind, CASE WHEN person <= 5 THEN 'h' ELSE 'v' END AS location, CASE WHEN e IN ('click', 'view', 'purchase') THEN CASE WHEN made THEN 'Made' ELSE 'Missed' END ELSE '' END AS result, CASE WHEN made AND pts > 0 THEN (sum(CASE WHEN made THEN pts ELSE 0 END) OVER (PARTITION BY game, person ORDER BY n))::BIGINT END AS points_total FROM s")
def feed_actions(t):
    """Actions of payloads in the older feed's words: a day's events of some users each are a game."""
    k, kind = F.get_json_object("props", "$.k").cast("bigint"), F.col("event_type")
    person, shot = k % 10 + 1, kind.isin("click", "view")
    types = F.create_map(*(F.lit(x) for p in (("click", "2pt"), ("view", "3pt"), ("purchase", "freethrow"), ("signup", "turnover"), ("error", "foul")) for x in p))[kind]
    sub = F.when(shot, "layup").when(kind == "purchase", "1of2").when(kind == "signup", F.when(k % 2 == 0, "3-second-violation").otherwise("bad pass")).otherwise("personal")
    more = F.when(shot & (k % 2 == 0), "running").when(kind == "error", "loose ball")
    result = F.when(F.col("event_id") % 3 == 0, ": Made").otherwise("Missed")
    act = F.struct(F.col("event_id").alias("orderNumber"), (-F.col("event_id")).alias("actionNumber"), types.alias("actionType"), sub.alias("subType"), more.alias("descriptor"), result.alias("shotResult"), person.alias("personId"), F.when(person <= 5, 10).otherwise(20).alias("teamId"))
    # A game is an eighth of a day; its payload is one text, as the feed sends it.
    payloads = t("events").groupBy(game_of_day().alias("game")).agg(F.to_json(F.struct(F.struct(F.collect_list(act).alias("actions")).alias("game"))).alias("payload")).withColumn("home", F.lit(10))
    got = feeds.translated(payloads, ["game"], "payload", "home")
    return got.select("game", "action_id", "person", "kind", "sub_kind", "location", "result", "points_total")


_CAREERS = f"""{GAMES},
days AS (SELECT entity AS player, season || '-' || lpad(((season + 1) % 100)::VARCHAR, 2, '0') AS season, 'T' || game % 3 AS team, day, year(day) AS y FROM (SELECT game, entity, day, year(day) - CASE WHEN month(day) < 7 THEN 1 ELSE 0 END AS season FROM games WHERE kind = 'F')),
spells AS (SELECT entity AS player, CASE WHEN priority = '1-URGENT' THEN 'standard' ELSE 'two_way' END AS type, 'T' || game % 3 AS team, day AS s, day + 200 AS e, year(day) - CASE WHEN month(day) < 7 THEN 1 ELSE 0 END AS y FROM games WHERE priority IN ('1-URGENT', '2-HIGH')),
bounds AS (SELECT y || '-' || lpad(((y + 1) % 100)::VARCHAR, 2, '0') AS season, y, make_date(y, 10, 20) AS a, make_date(y + 1, 6, 10) AS b FROM (SELECT unnest(range(1991, 1999)) AS y)),
each AS (SELECT d.player, b.season, d.team, EXISTS (SELECT 1 FROM spells s WHERE s.type = 'two_way' AND s.player = d.player AND s.team = d.team AND s.s <= d.day AND s.e >= d.day AND s.s <= b.b AND s.e >= b.a) AS tw FROM days d JOIN bounds b USING (season)),
g AS (SELECT player, season, count(*) FILTER (NOT tw) AS std_games, count(*) FILTER (tw) AS tw_games FROM each GROUP BY 1, 2),
here AS (SELECT s.player, b.season, s.type, s.team FROM spells s JOIN bounds b ON b.y = s.y AND s.s <= b.b AND s.e >= b.a),
tm AS (SELECT player, season, list_sort(list(DISTINCT team)) AS teams FROM (SELECT player, season, team FROM each WHERE tw UNION SELECT player, season, team FROM here WHERE type = 'two_way') GROUP BY 1, 2),
r AS (SELECT k.player, k.season, coalesce(std_games, 0) AS std_games, coalesce(tw_games, 0) AS tw_games, coalesce(teams, []) AS teams, CASE WHEN std_games > 0 THEN 'games' WHEN EXISTS (SELECT 1 FROM here h WHERE h.player = k.player AND h.season = k.season AND h.type = 'standard') THEN 'contract' END AS how
      FROM (SELECT DISTINCT player, season FROM days JOIN bounds USING (season)) k LEFT JOIN g USING (player, season) LEFT JOIN tm USING (player, season))"""


def _careers(t):
    """Careers of entities: finished games are days, urgent and high ones contracts of 200 days."""
    g = games(t)
    team = F.concat(F.lit("T"), (F.col("game") % 3).cast("string"))
    days = g.where("kind = 'F'").select(F.col("entity").alias("player"), service_years.league_year(F.col("day")).alias("season"), team.alias("team"), "day")
    type_ = F.when(F.col("priority") == "1-URGENT", service_years.STANDARD).otherwise(service_years.TWO_WAY)
    spells = g.where("priority IN ('1-URGENT', '2-HIGH')").select(F.col("entity").alias("player"), type_.alias("type"), team.alias("team"), F.col("day").alias("start"), F.date_add("day", 200).alias("end"))
    spark = g.sparkSession
    year = F.col("id").cast("int")
    bounds = spark.range(1991, 1999).select(service_years.season_of_year(year).alias("season"), F.make_date(year, F.lit(10), F.lit(20)).alias("first"), F.make_date(year + 1, F.lit(6), F.lit(10)).alias("last"))
    return service_years.service(days, spells, spark.createDataFrame([], "player bigint, team string"), bounds, "1997-98", date(1998, 1, 1))


@query(f"WITH {_CAREERS} SELECT player, season, std_games, tw_games, array_to_string(teams, ',') AS tw_teams, how FROM r")
def service_seasons(t):
    """Seasons of service with what they count for."""
    return _careers(t)[0].select("player", "season", "std_games", "tw_games", F.array_join("tw_teams", ",").alias("tw_teams"), "how")


@query(f"""WITH {_CAREERS},
c AS (SELECT player, list_sort(list(season) FILTER (season < '1997-98' AND how IS NOT NULL)) AS counted, count(*) FILTER (season < '1997-98' AND how IS NOT NULL) AS yos, count(*) FILTER (season <= '1997-98' AND how IS NOT NULL) AS yos_next,
      count(*) FILTER (len(teams) > 0) AS tw_seasons, coalesce(bool_or(season < '1997-98' AND how = 'contract' AND std_games = 0 AND tw_games = 0), false) AS idle, coalesce(bool_or(season < '1997-98' AND how IS NULL AND len(teams) > 0), false) AS only_tw FROM r GROUP BY 1),
x AS (SELECT player, string_agg(team, ',' ORDER BY team) AS blocked FROM (SELECT player, team FROM (SELECT player, unnest(teams) AS team FROM r) GROUP BY 1, 2 HAVING count(*) >= 3) GROUP BY 1),
p AS (SELECT DISTINCT player FROM (SELECT player FROM days UNION SELECT player FROM spells))
SELECT player, coalesce(yos, 0) AS yos, coalesce(yos_next, 0) AS yos_next, coalesce(tw_seasons, 0) AS tw_seasons, coalesce(blocked, '') AS blocked,
       CASE WHEN coalesce(yos, 0) <= 2 THEN 'eligible' WHEN yos = 3 THEN 'one_year' WHEN yos = 4 AND idle THEN 'exception' ELSE 'ineligible' END AS status,
       CASE WHEN yos BETWEEN 1 AND 5 THEN 'medium' ELSE 'high' END AS confidence,
       ((yos BETWEEN 1 AND 5)::INTEGER + (yos BETWEEN 1 AND 5 AND counted[-1][:4]::INTEGER - counted[1][:4]::INTEGER + 1 > yos)::INTEGER + (yos = 4 AND idle)::INTEGER + only_tw::INTEGER) AS n_notes
FROM p LEFT JOIN c USING (player) LEFT JOIN x USING (player)""".replace("AS n_notes", "AS n_notes_").replace("SELECT player, coalesce(yos, 0) AS yos", "SELECT * EXCLUDE n_notes_, coalesce(n_notes_, 0) AS n_notes FROM (SELECT player, coalesce(yos, 0) AS yos") + ")")
def service_years_assessed(t):
    """What the seasons of service make a player eligible for; all of these are before contract records begin."""
    return _careers(t)[1].select("player", "yos", "yos_next", "tw_seasons", F.array_join("blocked", ",").alias("blocked"), "status", "confidence", F.size("notes").alias("n_notes"))
