import json
import os

import pytest
from pyspark.sql import functions as F

from fieldglass.sources import landed


@pytest.fixture
def stream(spark, tmp_path):
    spark.dataSource.register(landed.LandedGames)
    os.makedirs(f"{tmp_path}/in")
    at = {"out": 0}

    def run(stop_after=None, fail_at=None, most=2):
        """Rows that are given out; the stream is stopped by an error in a batch, or when so many are done."""
        rows = spark.readStream.format("landed_games").option("path", f"file://{tmp_path}/in").option("log", f"file://{tmp_path}/log").option("most", most).option("parts", 3).load()
        done = []

        def write(batch, number):
            if fail_at == number or stop_after is not None and len(done) == stop_after:
                raise OSError("stopped")
            batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={number}")
            done.append(number)

        q = rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(processingTime="0 seconds").start()
        try:
            for _ in range(20):
                q.processAllAvailable()
                if not q.isActive:
                    break
        except Exception as error:
            assert "stopped" in str(error)
        q.stop()
        if not os.path.exists(f"{tmp_path}/out"):
            return []
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").select("file", "game_id", "payload").collect())

    def land(*names):
        for n in names:
            with open(f"{tmp_path}/in/{n}.json", "w") as f:
                f.write(json.dumps({"game": n}))

    def want(*names):
        return sorted((f"{n}.json", n, json.dumps({"game": n})) for n in names)

    return run, land, want, tmp_path


def test_nothing_is_read_twice_or_lost_over_restarts(stream):
    run, land, want, _ = stream
    land("m1", "m2", "m3", "m4", "m5")
    assert len(run(stop_after=1)) == 2
    land("a1", "z9")  # names before and after those that were read
    assert len(run(stop_after=1)) == 4
    land("a0")
    assert run() == want("m1", "m2", "m3", "m4", "m5", "a1", "z9", "a0")
    assert run() == want("m1", "m2", "m3", "m4", "m5", "a1", "z9", "a0")


def test_a_batch_that_failed_reads_the_same_files_again(stream):
    run, land, want, at = stream
    land("b1", "b2", "b3")
    assert run(fail_at=0) == []
    first = json.load(open(f"{at}/log/file-000000001"))
    land("a1")
    assert run() == want("a1", "b1", "b2", "b3")
    assert first == ["b1.json", "b2.json"]


def test_the_log_stays_short(stream):
    run, land, want, at = stream
    for k in range(6):
        land(f"g{k}")
        run(most=1)
    assert run() == want(*(f"g{k}" for k in range(6)))
    names = [n for n in os.listdir(f"{at}/log") if n[0] != "."]
    assert len(names) <= 3 and landed._Log(f"file://{at}/log").taken() == (6, {f"g{k}.json" for k in range(6)})


def test_gathering_that_was_cut_off_is_taken_up(tmp_path):
    log = landed._Log(f"file://{tmp_path}/log")
    for n in (1, 2, 3):
        log.add(n, [f"f{n}"])
    log.folder.write("upto-000000002", json.dumps(["f1", "f2"]).encode())  # entries 1 and 2 weren't deleted
    assert log.taken() == (3, {"f1", "f2", "f3"})
    log.gather(2)
    assert sorted(log.folder.names()) == ["file-000000003", "upto-000000002"]


def test_games_that_are_due(spark):
    schedule = spark.createDataFrame([("a", "2022"), ("b", "2022"), ("c", "2023"), ("d", "2023"), ("e", "2023")], "game_id string, season string")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "game_id string")
    # d is of the live season: that it was missing before says nothing.
    assert sorted(r[0] for r in landed.due(schedule, ids("c"), ids("a", "d"), "2023").collect()) == ["b", "d", "e"]
    after = landed.found_missing(schedule, ids("b", "d", "e", "c"), ids("c"), ids("a", "d"), "2023")
    assert sorted(r[0] for r in after.collect()) == ["a", "b"]
    assert landed.found_missing(schedule, ids("b"), ids("b"), ids(), "2023").count() == 0
    assert landed.due(schedule, ids(), ids(), "2024").select(F.count("*")).first()[0] == 5
