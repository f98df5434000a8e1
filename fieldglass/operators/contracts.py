"""Contract intervals from ordered events, and eligibility from them."""

from __future__ import annotations

from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INTERVAL = "player_id string, type string, team string, start_date date, end_date date"
CLAIM_DAYS = 7


def fold_contracts(events: list[tuple]) -> list[tuple]:
    """(type, team, start, end) from (date, kind, team) in order: end is None while it holds."""
    done: list[list] = []
    now = None
    for day, kind, team in events:
        if kind not in ("waive", "trade", "claim", "sign", "convert_to_standard", "twoway_sign", "convert_to_twoway"):
            continue
        closed = done[-1] if done else None  # the last spell that had ended before
        before = now or closed
        if now:
            now[3] = day
            done.append(now)
        if kind == "waive":
            now = None
            continue
        if kind == "trade":
            type_ = now[0] if now else "standard"
        elif kind == "claim":
            # A claim goes by the spell that ended before, never by the one that it ends.
            type_ = closed[0] if closed and day - closed[3] <= timedelta(days=CLAIM_DAYS) else "standard"
        else:
            type_ = "two_way" if "twoway" in kind else "standard"
        now = [type_, team or (before[1] if before and kind not in ("trade", "claim") else None), day, None]
    return [tuple(x) for x in done + ([now] if now else [])]


def intervals(events: DataFrame) -> DataFrame:
    """Contract intervals of every player from events (player_id, date, seq, kind, team)."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values(["date", "seq"])
        rows = fold_contracts([(d, k, None if t is None or t != t else t) for d, k, t in zip(p["date"], p["kind"], p["team"], strict=True)])
        return pd.DataFrame([(pdf["player_id"].iloc[0], *x) for x in rows], columns=["player_id", "type", "team", "start_date", "end_date"])

    return events.groupBy("player_id").applyInPandas(run, INTERVAL)


def dedupe_events(events: DataFrame, key: list[str], day: str, days: int = 3) -> DataFrame:
    """Events of a key without those within so many days after one that is kept: state carried along the sorted key."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values([day, "priority"])
        keep, last = [], None
        for d in p[day]:
            ok = last is None or (d - last).days > days
            keep.append(ok)
            last = d if ok else last
        return p[keep]

    return events.groupBy(*key).applyInPandas(run, events.schema)


def eligibility(seasons: DataFrame) -> DataFrame:
    """(player_id, yos, twoway_seasons, status) from (player_id, season, standard_games, signed_standard, two_way).

    A season counts with a standard game, or a standard contract signed in it.  Up to 2 seasons: two years left; 3: one;
    4 with one that had no game: an exception; else none."""
    counts = (F.col("standard_games") > 0) | F.col("signed_standard")
    a = seasons.groupBy("player_id").agg(F.count_if(counts).alias("yos"), F.count_if(counts & (F.col("standard_games") == 0)).alias("no_game"), F.count_if("two_way").alias("twoway_seasons"))
    status = F.when(F.col("yos") <= 2, "two_years").when(F.col("yos") == 3, "one_year").when((F.col("yos") == 4) & (F.col("no_game") > 0), "exception").otherwise("ineligible")
    return a.select("player_id", "yos", "twoway_seasons", status.alias("status"))


def roster_at(moves: DataFrame, key: str, day: str, at) -> DataFrame:
    """Each one's last move on or before a day, if it put them on a team (to_team not null)."""
    w = Window.partitionBy(key).orderBy(F.col(day).desc(), F.col("seq").desc())
    return moves.where(F.col(day) <= at).withColumn("_rn", F.row_number().over(w)).where("_rn = 1 AND to_team IS NOT NULL").drop("_rn")
