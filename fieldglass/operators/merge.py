"""Merges into plain tables: each makes the new state of a table from the old one and what arrived."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldglass.operators.windows import latest
from fieldglass.sources.lake import settled


def insert_ignore(old: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """old and those rows of new whose key it has not; of new rows with one key the first in order."""
    first = latest(new.join(old.select(*key), key, "left_anti"), key, order)
    return old.unionByName(first.select(*old.columns))


def upsert(old: DataFrame, new: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """new rows over old ones; of new rows with one key the first in order."""
    first = latest(new, key, order)
    return old.join(first.select(*key), key, "left_anti").select(*old.columns).unionByName(first.select(*old.columns))


def upsert_filling(old: DataFrame, new: DataFrame, key: list[str], newer: list[str], older: list[str]) -> DataFrame:
    """Full outer merge by key: columns in newer take the new value unless it is null, those in older the old one."""
    n = new.select(*key, *(F.col(c).alias(f"_new_{c}") for c in [*newer, *older]))
    both = old.join(n, key, "full_outer")
    return both.select(*key, *(F.coalesce(f"_new_{c}", c).alias(c) for c in newer), *(F.coalesce(c, f"_new_{c}").alias(c) for c in older))


def replace_slices(old: DataFrame, new: DataFrame, slices: list[str]) -> DataFrame:
    """old without the slices that new has rows of, and new."""
    return old.join(new.select(*slices).distinct(), slices, "left_anti").select(*old.columns).unionByName(new.select(*old.columns))


def changed_keys(before: DataFrame, after: DataFrame, key: list[str]) -> DataFrame:
    """Keys of the rows in one of the two and not in the other, repeats counted."""
    one, two = before.exceptAll(after), after.exceptAll(before)
    return one.unionByName(two).select(*key).distinct()


def fingerprint(df: DataFrame, columns: list[str]) -> DataFrame:
    """rows and a digest that doesn't depend on their order: sums of parts of each row's MD5."""
    digest = F.md5(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns)))
    part = lambda k: F.sum(F.conv(F.substring(digest, k, 8), 16, 10).cast("long"))
    return df.agg(F.count(F.lit(1)).alias("rows"), part(1).alias("low"), part(9).alias("high"))


def content_hash(*columns: Column) -> Column:
    """16 hexadecimal digits of the MD5 of the columns, a key for inserts that are run again."""
    return F.substring(F.md5(F.concat_ws("|", *columns)), 1, 16)


def surrogate_ids(new: DataFrame, highest: int, order: str, name: str) -> DataFrame:
    """Ids P00000001 on, after the highest number in use, in order.

    Numbers come from the counts of rows in each partition of the sorted table, so no task sees all rows."""
    from pyspark.sql.window import Window

    # Stored with its partition, so that counts and numbers are of the same rows whatever is computed again.
    ranged = settled(new.repartitionByRange(F.col(order)).withColumn("_part", F.spark_partition_id()))
    sizes = sorted(ranged.groupBy("_part").count().collect())
    starts, total = {}, 0
    for part, n in sizes:
        starts[part], total = total, total + n
    rn = F.row_number().over(Window.partitionBy("_part").orderBy(order))
    base = F.create_map(*(F.lit(v) for pair in starts.items() for v in pair))[F.col("_part")] if starts else F.lit(0)
    return ranged.withColumn(name, F.concat(F.lit("P"), F.lpad((rn + base + F.lit(highest)).cast("string"), 8, "0"))).drop("_part")
