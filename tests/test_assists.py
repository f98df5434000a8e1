"""Assists by name, schedules, tables copied and swapped, reports."""

import json

import pytest
from pyspark.sql import functions as F

from fieldglass.functions.shots import ZONES
from fieldglass.operators import assists
from fieldglass.sources import lake, schedule


def test_passers(spark):
    pool = spark.createDataFrame(
        [("g", "A", "p1", "Jokić", "Nikola Jokić"), ("g", "A", "p2", "Green", "Jeff Green"), ("g", "A", "p3", "Green", "Jalen Green"), ("g", "A", "p4", None, "Otto Porter Jr."), ("g", "B", "p5", "Murray", "Jamal Murray"), ("g", "A", "p6", "Solo", None)],
        "game string, team string, player string, shown string, full string",
    )
    texts = {
        1: ("x Dunk (2 PTS) (Jokic 3 AST)", "p9", ("resolved", "p1", "Jokic")), 2: ("x (Green 1 AST)", "p9", ("ambiguous", None, "Green")), 3: ("x (Je. Green 1 AST)", "p9", ("resolved", "p2", "Je. Green")),
        4: ("x (Porter 10 AST)", None, ("resolved", "p4", "Porter")), 5: ("x (Murray 1 AST)", "p9", ("unmatched", None, "Murray")), 6: ("x", "p9", ("none", None, None)), 7: (None, "p9", ("none", None, None)),
        8: ("x (Green 1 AST)", "p2", ("resolved", "p3", "Green")), 9: ("x (J Green 1 AST)", "p9", ("ambiguous", None, "J Green")), 10: ("x (Solo 2 AST)", "p9", ("resolved", "p6", "Solo")), 11: ("x (Porter Jr. 2 AST)", "p9", ("resolved", "p4", "Porter Jr.")),
    }
    made = spark.createDataFrame([("g", "A", k, text, who) for k, (text, who, _) in texts.items()], "game string, team string, shot int, text string, shooter string")
    got = assists.resolved(made, pool, ["game", "team"], ["shot"], "text", "shooter", "player", "shown", "full").collect()
    assert {r["shot"]: (r["match"], r["assist_player"], r["assist_name"]) for r in got} == {k: v[2] for k, v in texts.items()}
    assert all(r["assisted"] == (r["match"] != "none") for r in got)
    assert assists.resolved(made.limit(0), pool, ["game", "team"], ["shot"], "text", "shooter", "player", "shown", "full").count() == 0


def test_zones_of_shooters_and_passers(spark):
    rows = [("p1", "p2", True, "ra"), ("p1", None, False, "ra"), ("p2", "p1", True, "heave"), (None, "p2", True, "ra"), ("p1", None, True, None)]
    shots = spark.createDataFrame([("r", *r) for r in rows], "kind string, shooter string, passer string, assisted boolean, zone string")
    got = {r["player"]: r.asDict() for r in assists.by_zone(shots, ["kind"], "shooter", "passer", "assisted", "zone").collect()}
    want = lambda **of: {f"{z}_{x}": of.get(f"{z}_{x}", 0) for z in ZONES for x in ("fgm_ast", "ast")}
    assert got == {"p1": {"player": "p1", "kind": "r", **want(ra_fgm_ast=1, heave_ast=1)}, "p2": {"player": "p2", "kind": "r", **want(ra_ast=2, heave_fgm_ast=1)}}


def test_schedule(spark):
    game = lambda id_, own, **more: {"gameId": id_, "gameDateEst": own, "homeTeam": {"teamTricode": "AAA", "teamCity": "A", "teamName": "Bs", "score": 3}, **more}
    days = [{"gameDate": "2026-10-21", "games": [game("0022600001", "2026-10-22T00:00:00Z", gameStatus=1, gameStatusText=" 7 pm "), game("", None, gameStatus=3), game("0049900009", ""), game("0012600002", "TBD")]}, {"gameDate": "10/22/2026 00:00:00", "games": [game("0022600003", None)]}]
    df = spark.createDataFrame([(json.dumps({"leagueSchedule": {"gameDates": days}}),), ("{}",), ("no json",), (None,)], "p string")
    got = {r["game_id"]: (r["season"], r["season_type"], str(r["game_date"]), r["game_time"], r["home_name"], r["away_name"], r["status"], r["home_score"]) for r in schedule.rows(df, "p").collect()}
    assert got == {
        "0022600001": ("2026-27", "regular", "2026-10-22", "7 pm", "A Bs", " ", "scheduled", 3), "": ("2026-27", "other", "2026-10-21", "", "A Bs", " ", "final", 3),
        "0049900009": ("2099-00", "playoff", "2026-10-21", "", "A Bs", " ", "?", 3),
    }


def test_copies_and_swaps(spark, tmp_path):
    a, b = f"file://{tmp_path}/a", f"file://{tmp_path}/b"
    spark.range(5).write.parquet(f"{a}/parent.parquet")
    child = spark.range(20).select(F.col("id").alias("n"), F.when(F.col("id") > 1, F.col("id") % 5).alias("of"))
    child.write.parquet(f"{a}/child.parquet")
    parents, key = {"child": {"of": "parent"}, "parent": {}}, {"parent": "id"}
    assert lake.copied(spark, a, b, parents, key) == {"parent": 5, "child": 20}
    # A table made from itself, and the one before is kept.
    assert lake.swapped(spark.read.parquet(f"{b}/child.parquet").where("n < 7"), f"{b}/child.parquet") == 7
    assert lake.restored(spark, f"{b}/child.parquet").count() == 7 and spark.read.parquet(f"{b}/child.parquet.old").count() == 20
    (tmp_path / "b" / "child.parquet").rename(tmp_path / "b" / "gone")
    assert lake.restored(spark, f"{b}/child.parquet").count() == 20
    child.withColumn("of", F.lit(9).cast("long")).write.mode("overwrite").parquet(f"{a}/child.parquet")
    with pytest.raises(ValueError, match="lacks"):
        lake.copied(spark, a, b, parents, key)
    assert spark.read.parquet(f"{b}/child.parquet").where("of = 9").count() == 0


def test_reports(spark, tmp_path):
    df = spark.range(100).select("id", (F.col("id") % 10 / 10).alias("sure"))
    lake.report_csv(df, f"file://{tmp_path}/r", "sure", ["id"])
    lines = [x for f in sorted((tmp_path / "r").glob("part-*")) for x in f.read_text().splitlines() if not x.startswith("id")]
    assert [int(x.split(",")[0]) for x in lines] == sorted(range(100), key=lambda k: (k % 10, k))
    df.write.partitionBy("sure").parquet(f"file://{tmp_path}/p")
    assert [r["id"] for r in lake.combined(spark, f"file://{tmp_path}/p", ["id"]).collect()] == list(range(100))
