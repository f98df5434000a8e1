"""Service operators: bridges between sources, reports that settle, coverage, staging, thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.operators.joins import nearest
from fieldglass.operators.seasons import majority
from fieldglass.operators.windows import latest


def matchup(text: Column) -> Column:
    """(own, other, home) of "A vs. B" or "A @ B"; null if it is neither."""
    own, sign, other = (F.regexp_extract(text, r"^\s*(\S+)\s+(vs\.|@)\s+(\S+)\s*$", k) for k in (1, 2, 3))
    return F.when(own != "", F.struct(own.alias("own"), other.alias("other"), (sign == "vs.").alias("home")))


def games_from_lines(lines: DataFrame, game: str, text: str, points: str) -> DataFrame:
    """Games with home, away and both scores, the sums of their players' points, from lines that name their match."""
    m = lines.withColumn("_m", matchup(F.col(text))).where("_m IS NOT NULL")
    home = F.when(F.col("_m.home"), F.col("_m.own")).otherwise(F.col("_m.other"))
    away = F.when(F.col("_m.home"), F.col("_m.other")).otherwise(F.col("_m.own"))
    score = lambda at_home: F.coalesce(F.sum(F.when(F.col("_m.home") == at_home, F.col(points))), F.lit(0))
    return m.groupBy(game).agg(F.min(home).alias("home"), F.min(away).alias("away"), score(True).alias("home_score"), score(False).alias("away_score"))


def bridge_games(a: DataFrame, b: DataFrame, day: str, teams: list[str], a_id: str, b_id: str) -> DataFrame:
    """(a_id, b_id) of games on one day between the same two teams, in either order; days with two such games are none."""
    key = [F.col(day).alias("_day"), F.least(*teams).alias("_one"), F.greatest(*teams).alias("_two")]
    once = lambda df, c: df.groupBy(*key).agg(F.min(c).alias(c), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    return once(a, a_id).join(once(b, b_id), ["_day", "_one", "_two"]).select(a_id, b_id)


def fingerprint_bridge(a: DataFrame, b: DataFrame, key: list[str], line: list[str], a_id: str, b_id: str, minutes: str, share: float = 0.8) -> DataFrame:
    """The b_id of each a_id by equal stat lines in the same game and team, the nearest minutes where lines are shared (at
    most 90 seconds off, the next at least 30 worse), and a vote of so large a share over all games."""
    left = a.select(*key, *line, a_id, F.col(minutes).alias("_a_minutes"))
    right = b.select(*key, *line, b_id, F.col(minutes).alias("_b_minutes"))
    votes = nearest(left, right, [*key, *line], [*key, a_id], b_id, "_a_minutes", "_b_minutes", 90, 30)
    return majority(votes, a_id, b_id, share)


def settled_reports(rows: DataFrame, game: str, team: str, stamp: str, pending: str) -> DataFrame:
    """Each team's list in a game from the latest report that has one: a list not yet handed in counts only where there is
    no other."""
    w = Window.partitionBy(game, team).orderBy(F.col(pending).asc(), F.col(stamp).desc())
    return rows.withColumn("_rank", F.dense_rank().over(w)).where("_rank = 1").drop("_rank")


def asset_coverage(wanted: DataFrame, have: DataFrame, season: str, entity: str) -> DataFrame:
    """exact where there is a file of the season, fallback where there is one of the season before, else missing."""
    own = have.select(season, entity).distinct()
    exact = own.withColumn("_exact", F.lit(True))
    before = own.withColumn(season, F.col(season) + 1).withColumn("_before", F.lit(True))
    both = wanted.join(exact, [season, entity], "left").join(before, [season, entity], "left")
    return both.select(*wanted.columns, F.when(F.col("_exact"), "exact").when(F.col("_before"), "fallback").otherwise("missing").alias("coverage"))


def staged(rows: DataFrame, key: list[str], id_: str) -> DataFrame:
    """One row for each key: the least id and how often it occurs."""
    return rows.groupBy(*key).agg(F.min(id_).alias(id_), F.count(F.lit(1)).alias("occurrences"))


def updated(df: DataFrame, new: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """df with columns taken from new where it has the key and a value; changed tells rows that are not as before."""
    n = new.select(*key, *(F.col(c).alias(f"_new_{c}") for c in columns))
    values = {c: F.coalesce(f"_new_{c}", c) for c in columns}
    changed = F.lit(False)
    for c, v in values.items():
        changed = changed | ~v.eqNullSafe(F.col(c))
    return df.join(n, key, "left").select(*(c for c in df.columns if c not in columns), *(v.alias(c) for c, v in values.items()), changed.alias("changed"))


def split_stale(queue: DataFrame, still: DataFrame, key: list[str], stale: Column) -> tuple[DataFrame, DataFrame]:
    """(what stays, what goes): rows that are stale and no longer listed go."""
    listed = queue.join(still.select(*key).distinct().withColumn("_listed", F.lit(True)), key, "left")
    goes = F.coalesce(stale, F.lit(False)) & F.col("_listed").isNull()
    return listed.where(~goes).drop("_listed"), listed.where(goes).drop("_listed")


def additive_rates(rows: DataFrame, key: list[str], rates: list[str], weight: str) -> DataFrame:
    """Rates of one who changed teams: sums of rate times weight over the sum of weights."""
    return rows.groupBy(*key).agg(F.sum(weight).alias(weight), *((F.sum(F.col(r) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0))).alias(r) for r in rates))


def best_cut(df: DataFrame, value: str, label: str, cuts: list[float]) -> DataFrame:
    """(cut, right, n): how many rows each cut sorts right (label true at or above it), the best first.  One aggregate."""
    one = df.agg(F.count(F.lit(1)).alias("n"), *(F.count_if((F.col(value) >= c) == F.col(label)).alias(f"c{k}") for k, c in enumerate(cuts)))
    rows = F.array(*(F.struct(F.lit(float(c)).alias("cut"), F.col(f"c{k}").alias("right")) for k, c in enumerate(cuts)))
    return one.select(F.inline(rows), "n").orderBy(F.col("right").desc(), "cut")


def tier_list(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, position, name, tier, ok) from "name:tier, name:tier": entries that aren't such a pair have ok false."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")
    each = df.select(key, F.posexplode(parts).alias("position", "entry"))
    name, tier = F.trim(F.regexp_extract("entry", r"^([^:]+):\s*(\d+)$", 1)), F.nullif(F.regexp_extract("entry", r"^([^:]+):\s*(\d+)$", 2), F.lit(""))
    return each.select(key, "position", F.nullif(name, F.lit("")).alias("name"), tier.cast("bigint").alias("tier"), tier.isNotNull().alias("ok"))


def latest_vector(df: DataFrame, key: list[str], day: str) -> DataFrame:
    """All rows of each key's latest day."""
    from fieldglass.operators.windows import at_maximum

    return at_maximum(df, key, day)


def points_view(assessments: DataFrame, scouts: DataFrame) -> DataFrame:
    """Each scout's latest assessment of each player with the weight of the scout, null weights as 1."""
    last = latest(assessments, ["player_id", "scout_id"], [F.col("report_date").desc(), F.col("report_id").desc()])
    return last.join(scouts, "scout_id").withColumn("help_weight", F.coalesce("help_weight", F.lit(1.0)))
