"""Season aggregates, conditional pivots, audits and consensus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fieldglass.sources.lake import settled

FREE_THROW_WEIGHT = 0.44


def conditional_pivot(df: DataFrame, key: list[str], column: str, values: list[str], totals: dict[str, Column]) -> DataFrame:
    """A column {value}_{name} for each value of column: the total over the rows that have it.  One pass, no pivot job:
    the values are given."""
    return df.groupBy(*key).agg(*(F.coalesce(F.sum(F.when(F.col(column) == v, t)), F.lit(0)).alias(f"{v}_{name}") for v in values for name, t in totals.items()))


def player_season(box: DataFrame, key: list[str], stats: list[str], game: str, team: str, day: str, parts: int | None = None) -> DataFrame:
    """Games, sums, first and last day, number of teams, and the alphabetically last team.

    Rows are dealt out once, by key, and the first of each team is marked there: two distinct counts in one aggregate would
    send every row three times, and again.  parts: into how many, if not as many as Spark finds fit."""
    first = F.row_number().over(Window.partitionBy(*key, team).orderBy(game)) == 1
    rows = box.select(*dict.fromkeys([*key, *stats, game, team, day])).repartition(*([parts] if parts else []), *key).withColumn("_first", first & F.col(team).isNotNull())
    return rows.groupBy(*key).agg(
        F.count_distinct(game).alias("gp"),
        *(F.sum(s).alias(s) for s in stats),
        F.count_if("_first").alias("teams"),
        F.max(team).alias("last_team"),
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
    )


def own_and_opponent(box: DataFrame, key: list[str], team: str, opponent: str, stats: list[str]) -> DataFrame:
    """Sums of a team's rows and, as opp_*, of the rows against it.  A team without either has no row.

    Each row is sent once for each side and both sums are one aggregate, instead of two and a join."""
    sides = F.array(
        F.struct(F.col(team).alias("side"), F.lit(True).alias("own")),
        F.struct(F.col(opponent).alias("side"), F.lit(False).alias("own")),
    )
    rows = box.select(*key, *stats, F.explode(sides).alias("s")).where("s.side IS NOT NULL")
    sums = [F.sum(F.when(F.col("s.own") == own, F.col(v))).alias(p + v) for own, p in ((True, ""), (False, "opp_")) for v in stats]
    counts = [F.count_if("s.own").alias("_own"), F.count_if(~F.col("s.own")).alias("_opp")]
    return rows.groupBy(*key, F.col("s.side").alias(team)).agg(*sums, *counts).where("_own > 0 AND _opp > 0").drop("_own", "_opp")


def team_records(games: DataFrame, key: list[str], home: str, away: str, home_score: str, away_score: str) -> DataFrame:
    """Wins, losses (a tie is one for both), win share and mean margin from games with both scores."""
    two = F.inline(
        F.array(
            F.struct(F.col(home).alias("team"), F.col(home_score).alias("own"), F.col(away_score).alias("other")),
            F.struct(F.col(away).alias("team"), F.col(away_score).alias("own"), F.col(home_score).alias("other")),
        )
    )
    rows = games.where(F.col(home_score).isNotNull() & F.col(away_score).isNotNull()).select(*key, two)
    won = F.count_if(F.col("own") > F.col("other"))
    return rows.groupBy(*key, "team").agg(won.alias("wins"), (F.count(F.lit(1)) - won).alias("losses"), F.sum(F.col("own") - F.col("other")).alias("point_diff"), (won / F.count(F.lit(1))).alias("win_pct"), F.avg(F.col("own") - F.col("other")).alias("mov"))


def career(rows: DataFrame, player: str, season: str, games: Column, points: Column) -> DataFrame:
    """Seasons, the first and last of them, games and points of each player, from rows of any grain: box lines count one
    game each, season rows the games they hold."""
    return rows.groupBy(player).agg(F.count_distinct(season).alias("seasons"), F.min(season).alias("first_season"), F.max(season).alias("last_season"), F.sum(games).alias("career_gp"), F.sum(points).alias("career_pts"))


def possessions_estimate(fga: Column, fta: Column, orb: Column, tov: Column) -> Column:
    return fga + fta * FREE_THROW_WEIGHT - orb + tov


def reconcile(a: DataFrame, b: DataFrame, key: list[str], value: str, share: float = 0.1, least: float = 5.0) -> DataFrame:
    """Keys of either side with both values, the difference, and whether it is within max(least, share of b)."""
    both = a.select(*key, F.col(value).alias("a_value")).join(b.select(*key, F.col(value).alias("b_value")), key, "full_outer")
    x, y = F.coalesce("a_value", F.lit(0)), F.coalesce("b_value", F.lit(0))
    return both.select(*key, "a_value", "b_value", (x - y).alias("diff"), (F.abs(x - y) <= F.greatest(F.lit(least), y * share)).alias("ok"), (x / F.nullif(y.cast("double"), F.lit(0.0))).alias("ratio"))


def consensus(df: DataFrame, key: list[str], value: str, weight: str) -> DataFrame:
    """Weighted mean, population deviation, spread and count."""
    return df.groupBy(*key).agg((F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0))).alias("mean"), F.stddev_pop(value).alias("sd"), (F.max(value) - F.min(value)).alias("spread"), F.count(value).alias("n"))


def on_off(rows: DataFrame, team: list[str], member: str, value: str, weight: str, least: float) -> DataFrame:
    """Each member's rate on and the team's rate without it, both with at least ``least`` weight.

    rows: one for each member and stint; totals of the team come from stints counted once."""
    on = rows.groupBy(*team, member).agg(F.sum(value).alias("on_value"), F.sum(weight).alias("on_weight"))
    total = rows.dropDuplicates([*team, "stint"]).groupBy(*team).agg(F.sum(value).alias("t_value"), F.sum(weight).alias("t_weight"))
    off = on.join(total, team).withColumn("off_weight", F.col("t_weight") - F.col("on_weight"))
    both = off.where((F.col("on_weight") >= least) & (F.col("off_weight") >= least))
    on_rate, off_rate = F.col("on_value") / F.col("on_weight"), (F.col("t_value") - F.col("on_value")) / F.col("off_weight")
    return both.select(*team, member, on_rate.alias("on_rate"), off_rate.alias("off_rate"), (on_rate - off_rate).alias("diff"))


def weighted_shares(df: DataFrame, key: list[str], weight: str, tests: dict[str, Column]) -> DataFrame:
    """For each test, the share of the weight where it holds among the weight where it is known."""
    return df.groupBy(*key).agg(*(x for name, t in tests.items() for x in ((F.sum(F.when(t, F.col(weight)).otherwise(0)) / F.nullif(F.sum(F.when(t.isNotNull(), F.col(weight)).otherwise(0)), F.lit(0))).alias(f"{name}_share"), F.sum(F.when(t.isNotNull(), F.col(weight)).otherwise(0)).alias(f"{name}_known"))))


def subsets(members: Column, sizes: tuple[int, ...]) -> Column:
    """All subsets of these sizes of a sorted array of distinct members, each sorted.

    Subsets of one size come from those of the size before, by each later member: no more are made than are asked for."""
    at = F.sequence(F.lit(0), F.size(members) - 1)
    grown, kept = F.transform(at, lambda i: F.array(i)), []
    for size in range(1, max(sizes) + 1):
        if size > 1:
            grown = F.flatten(F.transform(grown, lambda s: F.transform(F.filter(at, lambda i: i > F.element_at(s, -1)), lambda i: F.concat(s, F.array(i)))))
        if size in sizes:
            kept.append(grown)
    return F.transform(F.concat(*kept), lambda s: F.transform(s, lambda i: F.get(members, i)))


def _subset_rows(units: DataFrame, key: list[str], values: list[str], sizes: tuple[int, ...]) -> DataFrame:
    each = units.where("size(_m) > 0").withColumn("_s", F.explode(subsets(F.col("_m"), sizes)))
    return each.select(*key, F.array_join(F.col("_s").cast("array<string>"), "-").alias("unit"), F.size("_s").alias("size"), *values)


def lattice(units: DataFrame, key: list[str], members: str, values: list[str], sizes: tuple[int, ...] = (2, 3, 4, 5)) -> DataFrame:
    """Sums over every subset of these sizes of every unit's members (an array of any length; repeats count once).

    Subsets are made in the JVM, row by row.  Units of one key that share a subset of two or more share a pair, so hashes of
    pairs are looked through first: subsets of a unit none of whose pairs comes again are rows as they are, and only those of
    the others are shuffled and added up.  Pairs of one hash count as the same, which adds up more than need be."""
    own = units.select(*key, *values, F.array_sort(F.array_distinct(members)).alias("_m"))
    sums = lambda of, n: _subset_rows(of, key, values, n).groupBy(*key, "unit", "size").agg(*(F.sum(v).alias(v) for v in values))
    small, large = tuple(n for n in sizes if n < 2), tuple(n for n in sizes if n >= 2)
    if not large:
        return sums(own, small)
    own = settled(own.withColumn("_u", F.monotonically_increasing_id()))
    pair = F.transform(subsets(F.col("_m"), (2,)), lambda s: F.xxhash64(*key, s))
    pairs = own.where("size(_m) > 1").select("_u", F.explode(pair).alias("_pair"))
    # Few come again, so that there is nothing to combine before the shuffle.
    again = settled(pairs.select("_pair").repartition("_pair").groupBy("_pair").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_pair"))
    shared = settled(pairs.join(again, "_pair", "left_semi").select("_u").distinct())
    added = sums(own.join(shared, "_u", "left_semi"), large)
    alone = _subset_rows(own.join(shared, "_u", "left_anti"), key, values, large)
    out = added.unionByName(alone.select(*key, "unit", "size", *(F.col(v).cast(added.schema[v].dataType).alias(v) for v in values)))
    return out.unionByName(sums(own, small)) if small else out


def majority(votes: DataFrame, of: str, to: str, share: float = 0.8) -> DataFrame:
    """The candidate with at least this share of the votes of each, the number of its votes, and a confidence."""
    n = votes.groupBy(of, to).agg(F.count(F.lit(1)).alias("votes"))
    w = Window.partitionBy(of)
    ranked = n.withColumn("total", F.sum("votes").over(w)).withColumn("_rn", F.row_number().over(w.orderBy(F.col("votes").desc(), to)))
    good = ranked.where((F.col("_rn") == 1) & (F.col("votes") >= F.col("total") * share))
    return good.select(of, to, "votes", "total", F.least(F.lit(1.0), 0.5 + F.col("votes") / 20.0).alias("confidence"))


def overtimes(team_minutes: Column) -> Column:
    """Overtime periods from the minutes of a team, 240 in regulation and 25 in each further period."""
    return F.greatest(F.lit(0), F.round((team_minutes - 240) / 25.0)).cast("bigint")


def season_types(games: DataFrame, season: str, day: str, playoff: str, dense: int = 5) -> DataFrame:
    """games with kind: playoff as flagged; playin strictly between the season's last day before its first playoff game
    with at least ``dense`` games and that game; tournament for a December day with a single game; else regular."""
    first = games.where(playoff).groupBy(season).agg(F.min(day).alias("_first"))
    by_day = games.groupBy(season, day).agg(F.count(F.lit(1)).alias("_games"))
    last = by_day.join(first, season).where((F.col(day) < F.col("_first")) & (F.col("_games") >= dense)).groupBy(season).agg(F.max(day).alias("_dense"))
    joined = games.join(first, season, "left").join(last, season, "left").join(by_day, [season, day])
    kind = (
        F.when(F.col(playoff), "playoff")
        .when((F.col(day) > F.col("_dense")) & (F.col(day) < F.col("_first")), "playin")
        .when((F.month(day) == 12) & (F.col("_games") == 1), "tournament")
        .otherwise("regular")
    )
    return joined.select(*games.columns, kind.alias("kind"))
