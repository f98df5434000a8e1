"""Lake, merges, names, identity and streams on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fieldglass.functions import shots
from fieldglass.functions import text as T
from fieldglass.operators import identity, merge, windows
from fieldglass.sources import lake
from fieldglass.streaming import tables


def test_products_archive_and_slices(spark, tmp_path):
    df = spark.createDataFrame([("2022-23", 1, "a"), ("2023-24", 1, "b"), ("2023-24", 2, "c")], "season string, id int, v string")
    at = f"file://{tmp_path}/archive"
    hot = lake.archived(spark, df, at, "season", ["2022-23"])
    assert hot.count() == 2 and lake.hot_and_cold(spark.read.parquet(at), hot.withColumn("more", F.lit(1))).count() == 3
    lake.replace_partitions(df.where("season = '2022-23'").withColumn("v", F.lit("new")), at, ["season"])
    assert [r["v"] for r in spark.read.parquet(at).collect()] == ["new"]
    assert lake.write_product(df, f"file://{tmp_path}/p", ["season"], ["id"]) and not lake.write_product(df.where("id > 9"), f"file://{tmp_path}/q")
    got = lake.with_source(spark.read.parquet(f"file://{tmp_path}/p"), r"season=([^/]+)/", "of").collect()
    assert all(r["of"] == r["season"] for r in got)
    assert lake.optional(None, spark, "a int").count() == 0
    assert lake.optional_columns(df, {"id": "int", "x": "double"}).columns == ["season", "id", "v", "x"]


def test_payloads(spark, tmp_path):
    df = spark.createDataFrame([(["id", "v"], [["1", "x"], ["2", "y"]])], "h array<string>, r array<array<string>>")
    assert [r["values"]["v"] for r in lake.result_rows(df, "h", "r").collect()] == ["x", "y"]
    (tmp_path / "a.csv").write_text("1,,x\n2,b,\n")
    got = lake.text_csv(spark, f"file://{tmp_path}/a.csv", ["a", "b", "c"]).collect()
    assert [tuple(r) for r in got] == [("1", None, "x"), ("2", "b", None)]
    (tmp_path / "a.json").write_text('{"a": 1}\n{"a": 2}\n')
    assert lake.json_lines(spark, f"file://{tmp_path}/a.json", "a long").count() == 2


def test_merges(spark):
    t = lambda *rows: spark.createDataFrame(list(rows), "k int, a string, b string")
    old, new = t((1, "x", None), (2, "y", "q")), t((2, None, "r"), (3, "z", "s"), (3, "w", "s"))
    rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert rows(merge.insert_ignore(old, new, ["k"], [F.col("a")])) == [(1, "x", None), (2, "y", "q"), (3, "w", "s")]
    assert rows(merge.upsert(old, new, ["k"], [F.col("a").desc()])) == [(1, "x", None), (2, None, "r"), (3, "z", "s")]
    assert rows(merge.upsert_filling(old, new.where("a IS NULL OR a = 'z'"), ["k"], ["a"], ["b"])) == [(1, "x", None), (2, "y", "q"), (3, "z", "s")]
    assert rows(merge.replace_slices(old, new, ["k"])) == [(1, "x", None), (2, None, "r"), (3, "w", "s"), (3, "z", "s")]


def test_spells(spark):
    rows = [("a", 1), ("a", 2), ("a", 4), ("b", 2), ("b", 4), ("b", 5)]
    days = spark.createDataFrame([("l", *r) for r in rows], "league string, who string, day int")
    got = windows.spells(days, ["league", "who"], ["league"], "day").collect()
    assert sorted(tuple(r)[1:] for r in got) == [("a", 1, 4, 5, 3), ("b", 2, 5, None, 3)]
    days = spark.createDataFrame([("l", "a", 1), ("l", "b", 2), ("l", "a", 3)], "league string, who string, day int")
    assert sorted(tuple(r)[1:] for r in windows.spells(days, ["league", "who"], ["league"], "day").collect()) == [("a", 1, 1, 2, 1), ("a", 3, 3, None, 1), ("b", 2, 2, 3, 1)]


def test_names(spark):
    df = spark.createDataFrame([("Đoković, Nikola Jr.",), ("José  O'Neal-Peña III",), ("Øst",), (None,)], "n string")
    got = df.select(T.name_key(F.col("n")), T.name_base(F.col("n")), T.name_bare(F.col("n")), T.suffix_rank(F.col("n"))).collect()
    assert tuple(got[0])[:2] == ("nikola jr dokovic", "nikola jr dokovic") and tuple(got[1])[:2] == ("jose oneal-pena iii", "jose oneal-pena")
    assert got[1][2] == "jose onealpena iii" and got[1][3] == 3 and got[2][0] == "ost" and got[3][0] is None
    broken = spark.createDataFrame([("JosÃ©",), ("José",), ("日本",), ("plain",)], "n string")
    assert [r[0] for r in broken.select(T.repair_mojibake(F.col("n"))).collect()] == ["José", "José", "日本", "plain"]
    clocks = spark.createDataFrame([("PT11M35.00S", "12:05", "6-8"), ("x", "y", None)], "a string, b string, c string")
    assert [tuple(r) for r in clocks.select(T.iso_clock_seconds(F.col("a")), T.clock_seconds(F.col("b")), T.height_inches(F.col("c"))).collect()] == [(695.0, 725, 80), (None, None, None)]


PAIR = "name string, birthdate date, draft int, school string, height int, c_name string, c_birthdate date, c_draft int, c_school string, c_height int, confirmed boolean"


def test_identity(spark):
    d = dt.date(1990, 5, 1)
    row = lambda a, b, x, y, ok=True: (a, x, None, None, None, b, y, None, None, None, ok)
    pairs = [row("Ann Lee", "Ann Lee", d, d), row("Ann Lee", "Ann Lee", d, d, False), row("Ann Lee Jr.", "Ann Lee III", d, d), row("Ann Lee Jr.", "Ann Lee II", d, d), row("Ann Lee", "Ann Lee Jr.", d, d), row("Ann Lee", "Ann Lee", d, dt.date(1960, 1, 2)), row("Ann Lee", "Ann Lee", d, dt.date(1990, 5, 2))]
    got = identity.score(spark.createDataFrame([(*p,) for p in pairs], PAIR)).collect()
    assert [r["decision"] for r in got] == ["auto_link", "propose", "block", "auto_link", "review", "review", "auto_link"]
    chain = spark.createDataFrame([(k, k + 1) for k in range(1, 12)], "merged int, survivor int")
    assert {r["survivor"] for r in identity.survivors(chain).collect()} == {12}
    with pytest.raises(ValueError):
        identity.survivors(spark.createDataFrame([(1, 2), (2, 1)], "merged int, survivor int"))


def test_zones(spark):
    shots_ = [(0, 30, 2), (70, 140, 2), (0, 145, 2), (150, 10, 2), (-150, 10, 2), (0, 180, 2), (-225, 50, 3), (225, 50, 3), (0, 310, 3), (140, 200, 3), (-140, 200, 3), (0, 260, 3), (None, 3, 2)]
    df = spark.createDataFrame(shots_, "x double, y double, v int") if False else spark.createDataFrame([(None if a is None else float(a), float(b), v) for a, b, v in shots_], "x double, y double, v int")
    got = [r[0] for r in df.select(shots.shot_zone(F.col("x"), F.col("y"), F.col("v"))).collect()]
    assert got[:6] == ["ra", "paint", "long_mid_c", "long_mid_r", "long_mid_l", "long_mid_c"] and got[6:9] == ["c3_l", "c3_r", "heave"] and got[11:] == ["atb_top", None]


def test_streams_end_as_batches_do(spark, tmp_path):
    rows = [(k, k % 3, "ab"[k // 4 % 2], k) for k in range(40)]
    schema = "id long, key long, v string, version long"
    for part in range(4):
        spark.createDataFrame(rows[part * 10 : part * 10 + 10], schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    source = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/in")
    tables.merge_into(source(), f"file://{tmp_path}/table", ["key"], "version", f"file://{tmp_path}/ck").awaitTermination()
    want = sorted(max((r for r in rows if r[1] == k), key=lambda r: r[3]) for k in range(3))
    assert sorted(tuple(r) for r in tables.current(spark, f"file://{tmp_path}/table", ["key"], "version").collect()) == want
    # Written whole by every second batch, the same table, also as it was after each batch.
    tables.merge_into(source(), f"file://{tmp_path}/t2", ["key"], "version", f"file://{tmp_path}/ck3", compact=2).awaitTermination()
    assert sorted(x.name for x in (tmp_path / "t2" / "whole").iterdir()) == ["batch=000000001", "batch=000000003"]
    for at in (None, 3, 2, 1, 0):
        one, two = (sorted(tuple(r) for r in tables.current(spark, f"file://{tmp_path}/{t}", ["key"], "version", at).collect()) for t in ("table", "t2"))
        assert one == two and (at is not None or one == want)
    assert tables.current(spark, f"file://{tmp_path}/nothing", ["key"], "version") is None

    q = tables.folded_runs(source(), "key", "id", "v").writeStream.format("memory").queryName("runs").outputMode("append").option("checkpointLocation", f"file://{tmp_path}/ck2").trigger(availableNow=True).start()
    q.awaitTermination()
    runs = sorted((r["key"], r["run"], r["value"], r["n"]) for r in spark.table("runs").collect())
    want = []
    for key in range(3):
        own, run = [r for r in rows if r[1] == key], 0
        at = 0
        for k in range(1, len(own)):
            if own[k][2] != own[k - 1][2]:
                want.append((key, run, own[at][2], k - at))
                run, at = run + 1, k
    assert runs == sorted(want)
