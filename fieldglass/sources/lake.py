"""Reading and writing the lake: an immutable archive and a hot table read as one, optional tables, partitioned products,
manifests."""

from __future__ import annotations

import json
import tempfile
import uuid
from graphlib import TopologicalSorter

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files or folders by column name, columns that one lacks null."""
    return spark.read.option("mergeSchema", True).parquet(*paths)


def with_source(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """df with what pattern's first group finds in each row's file path."""
    return df.withColumn(name, F.regexp_extract(F.col("_metadata.file_path"), pattern, 1))


def hot_and_cold(cold: DataFrame, hot: DataFrame) -> DataFrame:
    """Both by name, columns that one lacks null."""
    return cold.unionByName(hot, allowMissingColumns=True)


def optional(df: DataFrame | None, spark: SparkSession, schema: str) -> DataFrame:
    """df, or a table of that schema without rows."""
    return spark.createDataFrame([], schema) if df is None else df


def optional_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """df with those of columns (name: type) that it lacks as nulls."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns})


def catalogued(spark: SparkSession, schema: str, tables: dict[str, str]) -> None:
    """Parquet tables by name under a schema of the session's catalogue, so that SQL reads ``schema.name``; columns that some
    files lack are null.  A schema stands for one store, as hot or cold; tables of the same name are replaced."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS `{schema}`")
    for name, path in tables.items():
        spark.sql(f"DROP TABLE IF EXISTS `{schema}`.`{name}`")
        spark.catalog.createTable(f"`{schema}`.`{name}`", path, "parquet", spark.read.option("mergeSchema", True).parquet(path).schema)


def uncatalogued(spark: SparkSession, *schemas: str) -> None:
    """Schemas taken out of the catalogue again; their files stay."""
    for schema in schemas:
        spark.sql(f"DROP SCHEMA IF EXISTS `{schema}` CASCADE")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def text_csv(spark: SparkSession, path: str, names: list[str]) -> DataFrame:
    """CSV with every column as text, empty ones null."""
    return spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("nullValue", "").option("emptyValue", None).csv(path)


def result_rows(df: DataFrame, headers: str, rows: str) -> DataFrame:
    """Payloads of a header array and rows of values as a map for each row."""
    each = df.withColumn("_row", F.explode(rows))
    return each.withColumn("values", F.map_from_arrays(headers, "_row")).drop("_row")


def long_metrics(df: DataFrame, key: list[str], metrics: list[str]) -> DataFrame:
    """(key, metric, value): numeric columns under each other, nulls left out."""
    return df.select(*key, *(F.col(m).cast("double").alias(m) for m in metrics)).unpivot(key, metrics, "metric", "value").where("value IS NOT NULL")


def snake(name: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1_$2"), r"[^A-Za-z0-9]+", "_"))


def wide(df: DataFrame, key: list[str], column: str, values: list[str], value: str) -> DataFrame:
    """A column for each of values: the first by size of what column has under it."""
    return df.groupBy(*key).pivot(column, values).agg(F.min(value))


def write_product(df: DataFrame, path: str, by: list[str] | None = None, order: list[str] | None = None) -> bool:
    """df as ZSTD Parquet, partitioned by columns and sorted in the files; nothing is written if it is empty.

    One job writes the files of all keys: rows are dealt out by key first, so a key is in as few files as its size asks."""
    if df.isEmpty():
        return False
    if by:
        df = df.repartition(*by)
    if order:
        df = df.sortWithinPartitions(*(by or []), *order)
    out = df.write.mode("overwrite").option("compression", "zstd")
    (out.partitionBy(*by) if by else out).parquet(path)
    return True


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """The partitions that df has rows of, replaced; the others stay."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(*by).parquet(path)


def archived(spark: SparkSession, hot: DataFrame, path: str, season: str, done: list[str]) -> DataFrame:
    """Seasons that are done moved to the archive: written, counted again there, and only then left out of what is hot."""
    old = hot.where(F.col(season).isin(*done))
    replace_partitions(old, path, [season])
    kept = {r[0]: r[1] for r in spark.read.parquet(path).where(F.col(season).isin(*done)).groupBy(season).count().collect()}
    given = {r[0]: r[1] for r in old.groupBy(season).count().collect()}
    if {str(k): v for k, v in kept.items()} != {str(k): v for k, v in given.items()}:
        raise ValueError(f"the archive has {kept}, not {given}")
    return hot.where(~F.col(season).isin(*done) | F.col(season).isNull())


def _files(spark: SparkSession, path: str):
    """(file system, path) of Hadoop, on which folders are renamed whichever store holds them."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def swapped(df: DataFrame, path: str) -> int:
    """df written beside path, counted there and only then put in its place; the old table stays as path.old until the
    next swap.  Returns the rows.

    df may read from path.  A swap that ended between the two renames is taken up again by ``restored``."""
    spark = df.sparkSession
    new, old = f"{path}.new", f"{path}.old"
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(new)
    given, kept = seen.get["rows"], spark.read.parquet(new).count()
    if given != kept:
        raise ValueError(f"{new} has {kept} rows, not {given}")
    fs, at = _files(spark, path)
    if fs.exists(at):
        fs.delete(_files(spark, old)[1], True)
        fs.rename(at, _files(spark, old)[1])
    if not fs.rename(_files(spark, new)[1], at):
        raise OSError(f"{new} can't be renamed to {path}")
    return kept


def restored(spark: SparkSession, path: str) -> DataFrame:
    """The table at path; if a swap ended before its last rename, the table it had put aside."""
    (fs, at), (_, old) = _files(spark, path), _files(spark, f"{path}.old")
    if not fs.exists(at) and fs.exists(old):
        fs.rename(old, at)
    return spark.read.parquet(path)


def copied(spark: SparkSession, source: str, target: str, parents: dict[str, dict[str, str]], key: dict[str, str]) -> dict[str, int]:
    """Tables copied from one folder to another, parents before children; rows by table.  parents: for each table its
    columns that refer to others, {table: {column: parent}}; key: the parents' key columns.  A row that refers to a parent
    that isn't there is an error, and then nothing from this table on is replaced."""
    out = {}
    for name in TopologicalSorter({t: set(of.values()) - {t} for t, of in parents.items()}).static_order():
        df = table(spark, source, name)
        for column, parent in parents.get(name, {}).items():
            there = (df if parent == name else table(spark, target, parent)).select(F.col(key[parent]).alias(column))
            lost = df.where(F.col(column).isNotNull()).join(there, column, "left_anti").limit(1).count()
            if lost:
                raise ValueError(f"{name}.{column} refers to rows that {parent} lacks")
        out[name] = swapped(df, f"{target}/{name}.parquet")
    return out


def report_csv(df: DataFrame, path: str, confidence: str, tie: list[str]) -> None:
    """df as CSV, least confidence first: files in order, each sorted, by ranges and not through one task."""
    df.orderBy(F.col(confidence).asc_nulls_first(), *tie).write.mode("overwrite").option("header", True).csv(path)


def combined(spark: SparkSession, path: str, order: list[str]) -> DataFrame:
    """The partitions of a product as one table in order, columns that some lack null."""
    return merged(spark, path).orderBy(*order)


def manifest(df: DataFrame, season: str, entity: str) -> DataFrame:
    """One row of JSON: rows and distinct entities by season."""
    by = df.groupBy(season).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(entity).alias("entities"))
    return by.agg(F.to_json(F.array_sort(F.collect_list(F.struct(season, "rows", "entities")))).alias("manifest"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster shares, from spark.checkpoint.dir; a temporary one in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="fieldglass-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df written once in the shared folder and read from there: rounds of an iteration neither repeat each other's work
    nor depend on the executors that did it."""
    path = f"{shared_folder(df.sparkSession)}/fieldglass/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flattened(df: DataFrame, column: str, schema: T.StructType | str) -> DataFrame:
    """df with the fields of a JSON column beside the others."""
    return df.withColumn("_json", F.from_json(column, schema)).select(*(c for c in df.columns), "_json.*")


def document(name: str, rows: list[dict]) -> str:
    """A small JSON document of aggregates."""
    return json.dumps({"name": name, "rows": rows}, default=str, sort_keys=True)
