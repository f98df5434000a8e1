"""Joins beyond equality: as-of, nearest, intervals, unordered pairs, fallbacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def asof_self(df: DataFrame, key: list[str], order: str, back: float, values: list[str], prefix: str = "asof_") -> DataFrame:
    """Each row with values of the last row of its key whose order is at most its own less back: one window by range,
    no join."""
    w = Window.partitionBy(*key).orderBy(order).rangeBetween(Window.unboundedPreceding, -back)
    last = F.max(F.struct(F.col(order).alias("_by"), *values)).over(w)
    return df.withColumn("_last", last).select("*", *(F.col(f"_last.{v}").alias(prefix + v) for v in values)).drop("_last")


def asof(left: DataFrame, right: DataFrame, key: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """Each row of left with values of the last row of right of its key at or before its time, null if there is none.

    The two are put in one sorted stream by key, and the last values carried on: one shuffle, and a key of any size is
    sorted outside memory."""
    l = left.select("*", F.col(left_time).alias("_time"), F.lit(1).alias("_side"), *(F.lit(None).cast(right.schema[v].dataType).alias(f"_v_{v}") for v in values))  # noqa: E741
    r = right.select(*(F.col(c) if c in key else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), *(F.col(v).alias(f"_v_{v}") for v in values))
    w = Window.partitionBy(*key).orderBy("_time", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.struct(*(F.col(f"_v_{v}").alias(v) for v in values))
    last = F.last(F.when(F.col("_side") == 0, carried), ignorenulls=True).over(w)
    return l.unionByName(r).withColumn("_last", last).where("_side = 1").select(*left.columns, *(F.col(f"_last.{v}").alias(v) for v in values))


def trailing_window(df: DataFrame, key: list[str], order: list[str], size: str, least: float, values: list[str]) -> DataFrame:
    """Sums of values over the rows that follow the last row before which at least ``least`` of size remain: the shortest
    trailing window of whole rows with that much, for rows that have that much behind them.

    Running totals and an as-of look-up of the total at least ``least`` lower; the window is their difference."""
    w = Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = df.select("*", F.row_number().over(w).alias("rn"), F.sum(size).over(w).alias("run_size"), *(F.sum(v).over(w).alias(f"run_{v}") for v in values))
    back = asof_self(run, key, "run_size", least, ["rn", *(f"run_{v}" for v in values)], "back_")
    start = F.coalesce(F.col("back_rn"), F.lit(0))
    return back.where(F.col("run_size") >= least).select(*df.columns, "rn", (F.col("rn") - start).alias("n"), *((F.col(f"run_{v}") - F.coalesce(F.col(f"back_run_{v}"), F.lit(0))).alias(f"win_{v}") for v in values))


def adjacent_noise(windows: DataFrame, key: list[str], rn: str, n: str, value: str) -> DataFrame:
    """Root mean square of the difference of adjacent windows that don't overlap, over root 2, for each key's group."""
    before = windows.select(*key, F.col(rn).alias("_at"), F.col(value).alias("_before"))
    pairs = windows.withColumn("_at", F.col(rn) - F.col(n)).join(before, [*key, "_at"])
    d = F.col(value) - F.col("_before")
    return pairs.agg(F.count(F.lit(1)).alias("pairs"), (F.sqrt(F.avg(d * d)) / F.sqrt(F.lit(2.0))).alias("noise"))


def nearest(left: DataFrame, right: DataFrame, key: list[str], left_id: list[str], right_id: str, left_value: str, right_value: str, most: float, apart: float) -> DataFrame:
    """Each left row's nearest right row of its key, if it is within most and the runner-up at least apart worse."""
    d = F.abs(F.col(left_value) - F.col(right_value))
    w = Window.partitionBy(*left_id).orderBy("distance", right_id)
    ranked = left.join(right, key).withColumn("distance", d).withColumn("place", F.row_number().over(w)).withColumn("second", F.lead("distance").over(w))
    clear = F.col("second").isNull() | (F.col("second") - F.col("distance") >= apart)
    return ranked.where((F.col("place") == 1) & (F.col("distance") <= most) & clear).drop("place", "second")


def nearest_sorted(left: DataFrame, right: DataFrame, key: list[str], left_id: list[str], right_id: str, left_value: str, right_value: str, most: float, apart: float) -> DataFrame:
    """As nearest, without a product: the two values on either side of a left row's come from sorted streams by key.

    Right rows of one value are one, with their least id and their number; of left rows with the same key and value, one
    is looked up for all.  Left rows with the same ids are one, as in nearest."""
    asked = left.where(F.col(left_value).isNotNull()).select(*key, F.col(left_value).alias("_v")).distinct()
    values = right.where(F.col(right_value).isNotNull()).groupBy(*key, F.col(right_value).alias("_v")).agg(F.min(right_id).alias("id"), F.count(F.lit(1)).alias("n"))
    one = F.struct(F.col("_v").alias("v"), "id", "n")
    by = Window.partitionBy(*key)
    known = values.select(*key, "_v", one.alias("_own"), F.lag(one).over(by.orderBy("_v")).alias("_below"), F.lead(one).over(by.orderBy("_v")).alias("_above"))
    nothing = F.lit(None).cast(known.schema["_own"].dataType)
    both = known.select("*", F.lit(0).alias("_side")).unionByName(asked.select(*key, "_v", *(nothing.alias(c) for c in ("_own", "_below", "_above")), F.lit(1).alias("_side")))
    up = by.orderBy("_v", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    down = by.orderBy(F.col("_v").desc(), F.col("_side").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = lambda other, w: F.last(F.when(F.col("_side") == 0, F.array("_own", other)), ignorenulls=True).over(w)
    around = both.select(*key, "_v", "_side", seen("_below", up).alias("_low"), seen("_above", down).alias("_high")).where("_side = 1")
    near = F.filter(F.concat(F.coalesce("_low", F.array(nothing)), F.coalesce("_high", F.array(nothing))), lambda x: x.isNotNull())
    ranked = F.array_sort(F.transform(near, lambda x: F.struct(F.abs(F.col("_v") - x["v"]).alias("distance"), x["id"].alias("id"), x["n"].alias("n"))))
    found = around.select(*key, F.col("_v").alias(left_value), ranked.alias("_near")).where(F.size("_near") > 0)
    joined = left.join(found, [*key, left_value]).groupBy(*left_id).agg(F.array_sort(F.flatten(F.collect_list("_near"))).alias("_near"))
    best = F.get("_near", F.lit(0))
    second = F.when((best["n"] > 1), best["distance"]).otherwise(F.get("_near", F.lit(1))["distance"])
    out = joined.select(*left_id, best["id"].alias(right_id), best["distance"].alias("distance"), second.alias("_second"))
    return out.where((F.col("distance") <= most) & (F.col("_second").isNull() | (F.col("_second") - F.col("distance") >= apart))).drop("_second")


def during(facts: DataFrame, spells: DataFrame, key: list[str], day: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """Facts joined to the spells of their key that hold on the day: start <= day and (end null or day < end)."""
    on = [facts[k] == spells[k] for k in key] + [facts[day] >= spells[start], spells[end].isNull() | (facts[day] < spells[end])]
    joined = facts.join(spells, on, how)
    for k in key:
        joined = joined.drop(spells[k])
    return joined


def pair_key(a: Column, b: Column) -> Column:
    """The same for (a, b) and (b, a)."""
    return F.concat_ws("|", F.least(a, b).cast("string"), F.greatest(a, b).cast("string"))


def unique_candidate(observed: DataFrame, variants: DataFrame, key: list[str], of: list[str], candidate: str) -> DataFrame:
    """Each observed row's candidate through any of its keys: resolved if one distinct, ambiguous if more, unmatched if
    none."""
    found = observed.join(variants, key, "left").groupBy(*of).agg(F.count_distinct(candidate).alias("n"), F.min(candidate).alias("first"))
    status = F.when(F.col("n") == 1, "resolved").when(F.col("n") > 1, "ambiguous").otherwise("unmatched")
    return found.select(*of, F.when(F.col("n") == 1, F.col("first")).alias(candidate), status.alias("status"), "n")


def fallback(left: DataFrame, right: DataFrame, key: list[str], kind: str, default: str, values: list[str]) -> DataFrame:
    """Values of right by key and kind, or else by key and the default kind."""
    own = right.select(*key, kind, *(F.col(v).alias(f"_own_{v}") for v in values))
    other = right.where(F.col(kind) == default).select(*key, *(F.col(v).alias(f"_default_{v}") for v in values))
    joined = left.join(own, [*key, kind], "left").join(other, key, "left")
    return joined.select(*left.columns, *(F.coalesce(f"_own_{v}", f"_default_{v}").alias(v) for v in values))


def either_orientation(left: DataFrame, right: DataFrame, same: list[str], a: str, b: str, right_id: str) -> DataFrame:
    """right_id by (same, a, b), or else by (same, b, a) with flip true."""
    straight = right.select(*same, a, b, F.col(right_id).alias("_straight"))
    turned = right.select(*same, F.col(b).alias(a), F.col(a).alias(b), F.col(right_id).alias("_turned"))
    joined = left.join(straight, [*same, a, b], "left").join(turned, [*same, a, b], "left")
    flip = F.col("_straight").isNull() & F.col("_turned").isNotNull()
    return joined.select(*left.columns, F.coalesce("_straight", "_turned").alias(right_id), flip.alias("flip"))


def in_band(df: DataFrame, bands: DataFrame, value: str, low: str, high: str, label: str) -> DataFrame:
    """The band of value, low <= value < high; an open end is null.  bands is a dimension of some dozens of rows, given by
    the caller, not by the data, and its size is checked before it is broadcast."""
    if bands.count() > 10_000:
        raise ValueError("bands is meant to be a small dimension")
    v = F.col(value)
    on = (F.col(low).isNull() | (v >= F.col(low))) & (F.col(high).isNull() | (v < F.col(high)))
    return df.join(F.broadcast(bands.select(low, high, label)), on, "left").drop(low, high)
