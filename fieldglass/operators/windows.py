"""Window idioms: latest rows, spells, change points, tiers, ranks and quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order given."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_rn = 1").drop("_rn")


def at_maximum(df: DataFrame, key: list[str], value: str) -> DataFrame:
    """All rows of each key that hold its maximum: the latest snapshot, ties and all."""
    return df.withColumn("_max", F.max(value).over(Window.partitionBy(*key))).where(F.col(value) == F.col("_max")).drop("_max")


def spells(days: DataFrame, key: list[str], calendar: list[str], day: str) -> DataFrame:
    """Runs of days of key in a row, as numbered by the calendar of its group: first, last and until, the calendar's next
    day after the run, null while the run is the calendar's last.

    days: distinct (key..., calendar..., day); calendar columns are among the key."""
    every = days.select(*calendar, day).distinct()
    w = Window.partitionBy(*calendar).orderBy(day)
    numbered = every.select(*calendar, day, F.row_number().over(w).alias("_i"), F.lead(day).over(w).alias("_next"))
    own = days.join(numbered, [*calendar, day]).withColumn("_run", F.col("_i") - F.row_number().over(Window.partitionBy(*key).orderBy(day)))
    return own.groupBy(*key, "_run").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.max_by("_next", day).alias("until_day"), F.count(F.lit(1)).alias("days")).drop("_run")


def membership(spells: DataFrame, probes: DataFrame, first: str, until: str, probe: str, sums: dict[str, str]) -> DataFrame:
    """Each probe's number of members, the spells with first <= probe and (until null or probe < until), and sums by name
    of their columns; probes that nobody holds are left out.

    A spell is +1 at its first day and -1 at its until day.  These are added up by day, and the days' sums, a row for each
    day and no spell against a day, are accumulated over the calendar."""
    cells = [F.lit(1).cast("long").alias("members"), *(F.col(c).alias(n) for n, c in sums.items())]
    names = ["members", *sums]
    begin = spells.select(F.col(first).alias(probe), *cells)
    end = spells.where(F.col(until).isNotNull()).select(F.col(until).alias(probe), *cells).select(probe, *((-F.col(n)).alias(n) for n in names))
    days = begin.unionByName(end).groupBy(probe).agg(*(F.sum(n).alias(n) for n in names))
    w = Window.orderBy(probe).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    asked = probes.select(probe).distinct().withColumn("_asked", F.lit(True))
    run = days.join(asked, probe, "full").select(probe, "_asked", *(F.sum(F.coalesce(n, F.lit(0))).over(w).alias(n) for n in names))
    return run.where("_asked AND members > 0").drop("_asked")


def change_points(df: DataFrame, key: list[str], order: list[str], values: list[str]) -> DataFrame:
    """Rows whose values differ from the key's row before, the first ones with them."""
    w = Window.partitionBy(*key).orderBy(*order)
    first = F.row_number().over(w) == 1
    changed = first
    for v in values:
        changed = changed | ~F.col(v).eqNullSafe(F.lag(v).over(w))
    return df.withColumn("_changed", changed).where("_changed").drop("_changed")


def tiers(df: DataFrame, group: list[str], value: str, tie: str, n: int) -> DataFrame:
    """tier: top for the n highest of each group, bottom for the n lowest, else middle."""
    w = Window.partitionBy(*group)
    up = F.row_number().over(w.orderBy(F.col(value).desc(), tie))
    down = F.row_number().over(w.orderBy(F.col(value), F.col(tie).desc()))
    return df.withColumn("tier", F.when(up <= n, "top").when(down <= n, "bottom").otherwise("middle"))


def band_floors(df: DataFrame, group: list[str], value: str, tie: str, ranks: list[int]) -> DataFrame:
    """The value at each of these ranks, from the highest, of each group."""
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(value).desc(), tie))
    return df.withColumn("rank", rank).where(F.col("rank").isin(*ranks)).select(*group, "rank", F.col(value).alias("floor"))


def running_before(df: DataFrame, key: list[str], order: list[str], value: Column, name: str) -> DataFrame:
    """The sum of value over the key's rows before."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(name, F.coalesce(F.sum(value).over(w), F.lit(0)))


def recent_or_best(df: DataFrame, key: list[str], season: str, size: str, enough: float, n: int) -> DataFrame:
    """Each key's n latest seasons with enough of size, or where none has enough, its n largest."""
    ok = F.col(size) >= enough
    w = Window.partitionBy(*key)
    recent = F.row_number().over(w.orderBy(ok.desc(), F.col(season).desc()))
    best = F.row_number().over(w.orderBy(F.col(size).desc(), F.col(season).desc()))
    ranked = df.withColumn("_any", F.max(ok).over(w)).withColumn("_recent", recent).withColumn("_best", best)
    return ranked.where((F.col("_any") & ok & (F.col("_recent") <= n)) | (~F.col("_any") & (F.col("_best") <= n))).drop("_any", "_recent", "_best")


def index_quantiles(df: DataFrame, group: list[str], value: str, tie: str, at: list[float]) -> DataFrame:
    """The value at index floor(f * n), from 0, of each group in ascending order, for each f: no interpolation."""
    w = Window.partitionBy(*group)
    ranked = df.select(*group, value, F.row_number().over(w.orderBy(value, tie)).alias("_rn"), F.count(F.lit(1)).over(w).alias("_n"))
    pick = F.explode(F.array(*map(F.lit, at))).alias("f")
    return ranked.select("*", pick).where(F.col("_rn") - 1 == F.least(F.floor(F.col("f") * F.col("_n")), F.col("_n") - 1)).select(*group, "f", F.col(value).alias("quantile"))


def percentile_rank(df: DataFrame, group: list[str], value: str, higher_is_worse: bool = False) -> DataFrame:
    """percentile: 0 to 100, the share of the group's others that are lower, turned round if higher is worse."""
    w = Window.partitionBy(*group)
    below = F.rank().over(w.orderBy(value)) - 1
    share = F.round(100.0 * below / F.nullif(F.count(F.lit(1)).over(w) - 1, F.lit(0)), 0)
    share = F.greatest(F.lit(0.0), F.least(F.lit(100.0), share))
    return df.withColumn("percentile", (100.0 - share) if higher_is_worse else share)


def sampled(df: DataFrame, key: list[str], n: int, seed: int = 7) -> DataFrame:
    """Exactly n rows (all, if there are fewer), the same ones however the rows are dealt out: those of the least hashes of
    seed and key.  Each task keeps its n least before anything travels."""
    text = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in key))
    return df.withColumn("_order", F.md5(text)).orderBy("_order", *key).limit(n).drop("_order")
