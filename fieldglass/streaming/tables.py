"""Streams into tables: micro-batches merged by key, duplicates dropped within a watermark, state folded by key."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.operators.windows import latest


def deduplicated(stream: DataFrame, key: list[str], time: str, late: str) -> DataFrame:
    """Each key once, as far back as late rows may come."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark(key)


def windowed_counts(stream: DataFrame, time: str, late: str, size: str, by: list[str], value: str) -> DataFrame:
    """Rows and sums by window of event time, given out once the watermark has passed."""
    w = stream.withWatermark(time, late).groupBy(F.window(time, size), *by)
    return w.agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("window.start").alias("start"), *by, "n", "total")


#: Batches that a table keeps as they came before one writes it whole.
COMPACT = 32


def merge_into(stream: DataFrame, path: str, key: list[str], version: str, checkpoint: str, compact: int = COMPACT):
    """Every micro-batch merged into the table at path by key, the highest version last, and of equal ones the later batch.

    A batch writes its own rows only, one for each key, as ``rows/batch=number``; every compact-th one writes the whole
    table so far as ``whole/batch=number``, from which reading begins.  So what a batch writes doesn't grow with the table.
    A batch that is run again writes the same."""
    spark = stream.sparkSession

    def apply(batch: DataFrame, number: int) -> None:
        # The highest version first; nulls are last, as they never replace a version.
        latest(batch, key, [F.col(version).desc()]).write.mode("overwrite").parquet(f"{path}/rows/batch={number:09d}")
        if number % compact == compact - 1:
            current(spark, path, key, version, number).write.mode("overwrite").parquet(f"{path}/whole/batch={number:09d}")

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _batches(spark: SparkSession, path: str) -> list[str]:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    at = hadoop.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.listStatus(at) if fs.exists(at) else []
    return sorted(s.getPath().getName() for s in found if fs.exists(hadoop.Path(s.getPath(), "_SUCCESS")))


def current(spark: SparkSession, path: str, key: list[str], version: str, through: int | None = None) -> DataFrame | None:
    """The table through a batch, or as it is: of each key, the last batch's row among those of the highest version."""
    last = f"batch={through:09d}" if through is not None else "batch=:"
    whole = [x for x in _batches(spark, f"{path}/whole") if x < last][-1:]
    rows = [x for x in _batches(spark, f"{path}/rows") if x <= last and x > (whole or [""])[0]]
    parts = [*(f"{path}/whole/{x}" for x in whole), *(f"{path}/rows/{x}" for x in rows)]
    if not parts:
        return None
    each = [spark.read.parquet(p).withColumn("_batch", F.lit(k)) for k, p in enumerate(parts)]
    return latest(reduce(DataFrame.unionByName, each), key, [F.col(version).desc(), F.col("_batch").desc()]).drop("_batch")


RUNS = "key long, run int, value string, n long, first_id long, last_id long"


def folded_runs(stream: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """Runs of equal values (null is one too) of each key, closed by the next value: possession by change of side.  Batches
    follow in order of arrival, the rows of one by order.

    State is one open run for each key; a task holds one key's rows of a batch at a time."""

    def fold(k: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        run, now, n, first, last = state.get if state.exists else (0, None, 0, None, None)
        out = []
        # A key's rows come in several frames, in no order across them.
        pdf = pd.concat(list(batches), ignore_index=True).sort_values(order, kind="stable")
        ids, values = pdf[order].to_list(), [None if pd.isna(v) else v for v in pdf[value]]
        for i, v in zip(ids, values, strict=True):
            if n and v != now:
                out.append((k[0], run, now, n, first, last))
                run, n, first = run + 1, 0, None
            now, n, last = v, n + 1, int(i)
            first = last if first is None else first
        state.update((run, now, n, first, last))
        yield pd.DataFrame(out, columns=[x.split()[0] for x in RUNS.split(", ")])

    return stream.select(F.col(key).cast("long").alias("key"), order, value).groupBy("key").applyInPandasWithState(fold, RUNS, "run int, value string, n long, first long, last long", "append", "NoTimeout")
