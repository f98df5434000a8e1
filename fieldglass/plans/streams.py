"""Streams replayed to their end: what they leave is what a batch makes of the same rows."""

from __future__ import annotations

import uuid
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.plans.registry import ORACLE_SQL, QUERIES
from fieldglass.sources.lake import shared_folder, table
from fieldglass.streaming import tables


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{sf_dir}/events.parque[t]"  # a pattern, as a stream takes one file for no folder
    return spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(path)


def _folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/fieldglass/stream-{uuid.uuid4().hex}"


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each user's latest event, merged batch by batch."""
    at = _folder(spark)
    rows = _events(spark, sf_dir).select("user_id", "event_id", "event_type")
    tables.merge_into(rows, f"{at}/table", ["user_id"], "event_id", f"{at}/checkpoint").awaitTermination()
    return tables.current(spark, f"{at}/table", ["user_id"], "event_id")


def _kept(stream: DataFrame, at: str) -> DataFrame:
    """The rows that a stream gives out: a folder for each batch, written anew if the batch is run again."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{at}/rows/batch={number}")

    stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).option("recursiveFileLookup", True).parquet(f"{at}/rows")


def stream_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed runs of one event type of each user."""
    runs = tables.folded_runs(_events(spark, sf_dir), "user_id", "event_id", "event_type")
    return _kept(runs, _folder(spark)).withColumn("run", F.col("run").cast("bigint"))


def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once each, though every one arrives twice."""
    e = _events(spark, sf_dir).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    twice = e.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    return _kept(tables.deduplicated(twice, ["event_id"], "ts", "1 hour").select("event_id", "user_id"), _folder(spark))


#: Parts in which a table lands.
LANDS = 4


def stream_possessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Possessions by end and points of a replayed stream of games, a day's events of some users each, that land in
    parts; apart counts the possessions that stream and batch don't share."""
    from fieldglass.operators import games as batch
    from fieldglass.plans.models import game_of_day, play_columns
    from fieldglass.streaming import games as live

    at = _folder(spark)
    e = table(spark, sf_dir, "events")
    plays = e.select(game_of_day().alias("game_id"), *play_columns(), F.col("ts").cast("timestamp").alias("at"))
    # Land after land, as files are taken by their age; a row of its own days later lets the watermark pass all others.
    first, last = plays.agg(F.min("at"), F.max("at")).first()
    for k in range(LANDS):
        part = F.floor(LANDS * (F.unix_millis("at") - F.unix_millis(F.lit(first))) / (F.unix_millis(F.lit(last)) - F.unix_millis(F.lit(first)) + 1))
        plays.where(part == k).write.parquet(f"{at}/landed/{k}")
    spark.createDataFrame([("end", 0, last + timedelta(days=9))], "game_id string, action_id long, at timestamp").write.parquet(f"{at}/landed/{LANDS}")
    stream = spark.readStream.schema(plays.schema).option("maxFilesPerTrigger", 8).option("recursiveFileLookup", True).parquet(f"{at}/landed")
    before = spark.conf.get(live.STORE, None)
    live.with_state_store(spark)
    try:
        got = _kept(live.possessions(stream, "at", "1 hour", 43200), at).where("game_id <> 'end'")
    finally:
        spark.conf.unset(live.STORE) if before is None else spark.conf.set(live.STORE, before)
    own = ["game_id", "period", "poss_num", "off_team", "start_action", "end_action", "points", "end_reason", "start_type", "orebs"]
    both = got.select(*own).withColumn("d", F.lit(1)).unionByName(batch.possessions(plays.drop("at")).select(*own).withColumn("d", F.lit(-1)))
    apart = both.groupBy(*own).agg(F.sum("d").alias("d"), F.count_if(F.col("d") == 1).alias("n"))
    return apart.groupBy("end_reason", "points").agg(F.sum("n").alias("n"), F.sum(F.abs("d")).alias("apart"))


QUERIES |= {f.__name__: f for f in (stream_latest, stream_runs, stream_distinct, stream_possessions)}
ORACLE_SQL |= {
    "stream_latest": "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type FROM events GROUP BY 1",
    "stream_runs": "WITH s AS (SELECT user_id, event_id, event_type, (event_type IS DISTINCT FROM lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id))::INT AS c FROM events), r AS (SELECT *, sum(c) OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS run FROM s), g AS (SELECT user_id AS key, run::BIGINT AS run, any_value(event_type) AS value, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id FROM r GROUP BY user_id, run) SELECT * FROM g QUALIFY run < max(run) OVER (PARTITION BY key)",
    "stream_distinct": "SELECT event_id, user_id FROM events",
}
