"""How queries are registered, and views that they share.

Roles that the tables play: an order is a game, its date the day, its year the season, its status the kind of season; a
line is a box line of player l_partkey for team l_suppkey; events are logs of user_id, in order of event_id."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.sources.lake import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function of a table reader t(name) under its name, with DuckDB SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        QUERIES[f.__name__].__doc__ = f.__doc__
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


#: Rows that a task has about of what is dealt out by key.
ROWS_A_TASK = 300_000


def parts(t, rows: int) -> int | None:
    """Parts that grow in number with the rows, so that what a task sorts or adds up doesn't grow; None if the cores' parts are
    small enough.

    Spark makes its own shuffles fewer again, down to the cores or to 64 MB of packed rows, which unpacked take over a GB."""
    spark, n = t("nation").sparkSession, -(-rows // ROWS_A_TASK)
    return None if n <= spark.sparkContext.defaultParallelism else max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))


def line_parts(t) -> int | None:
    return parts(t, t("lineitem").count())


def by_player(t) -> DataFrame:
    """Box lines dealt out by player, for windows over a player's lines or games."""
    n = line_parts(t)
    return box(t).repartition(n, "player") if n else box(t)


def games(t) -> DataFrame:
    return t("orders").select(
        F.col("o_orderkey").alias("game"), F.col("o_custkey").alias("entity"), F.year("o_orderdate").cast("bigint").alias("season"), F.to_date("o_orderdate").alias("day"), F.col("o_orderstatus").alias("kind"),
        F.col("o_orderpriority").alias("priority"), F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents"),
    )


#: The same in SQL, to begin a WITH.
GAMES = "games AS (SELECT o_orderkey AS game, o_custkey AS entity, year(o_orderdate)::BIGINT AS season, o_orderdate::DATE AS day, o_orderstatus AS kind, o_orderpriority AS priority, round(o_totalprice * 100)::BIGINT AS cents FROM orders)"


def box(t) -> DataFrame:
    """Box lines with their game; the least and the greatest team of a game are home and away, others are left out."""
    lines = t("lineitem").select(
        F.col("l_orderkey").alias("game"), F.col("l_partkey").alias("player"), F.col("l_suppkey").alias("team"), F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_quantity").cast("bigint").alias("mp"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("pts"), F.round(F.col("l_discount") * 100).cast("bigint").alias("tov"), F.round(F.col("l_tax") * 100).cast("bigint").alias("orb"), F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
    )
    n = line_parts(t)
    return lines.repartition(n, "game").join(games(t).repartition(n, "game"), "game") if n else lines.join(games(t), "game")


BOX = GAMES + (
    ", box AS (SELECT l_orderkey AS game, l_partkey AS player, l_suppkey AS team, l_linenumber::BIGINT AS line, l_quantity::BIGINT AS mp, round(l_extendedprice * 100)::BIGINT AS pts, round(l_discount * 100)::BIGINT AS tov,"
    " round(l_tax * 100)::BIGINT AS orb, l_returnflag AS flag, l_linestatus AS status, entity, season, day, kind, priority, cents FROM lineitem JOIN games ON game = l_orderkey)"
)


def two_teams(t) -> DataFrame:
    """Box lines of the games with exactly two teams, with the opponent."""
    b = box(t)
    sides = b.groupBy("game").agg(F.min("team").alias("home"), F.max("team").alias("away"), F.count_distinct("team").alias("teams")).where("teams = 2").drop("teams")
    return b.join(sides, "game").withColumn("opponent", F.when(F.col("team") == F.col("home"), F.col("away")).otherwise(F.col("home")))


TWO = BOX + (
    ", sides AS (SELECT game, min(team) AS home, max(team) AS away FROM box GROUP BY game HAVING count(DISTINCT team) = 2)"
    ", two AS (SELECT box.*, home, away, CASE WHEN team = home THEN away ELSE home END AS opponent FROM box JOIN sides USING (game))"
)


def user_days(t) -> DataFrame:
    """Distinct (user, five-minute step) of events, as days of a calendar that all users share."""
    return t("events").select(F.col("user_id").alias("who"), F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600).cast("bigint").alias("d")).distinct()


DAYS = "days AS (SELECT DISTINCT user_id AS who, floor(epoch(ts) / 3600)::BIGINT AS d FROM events)"
