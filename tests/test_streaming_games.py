"""Streams of games against the batch: late events, restarts between batches, ends of games."""

import datetime as dt
import random

import pytest
from pyspark.sql import Row
from fieldglass.operators import games as G
from fieldglass.streaming import games as S

EVENT = "game_id string, action_id long, period int, secs double, kind string, sub_kind string, team string, value int, result string, text string, at_time timestamp"
START = dt.datetime(2024, 1, 1)
KINDS = ["Made Shot", "Made Shot", "Missed Shot", "Rebound", "Turnover", "Free Throw", "Foul", "Timeout", None]


def played(seed, n_games=6, n=40):
    """Events of games that overlap in time."""
    rng = random.Random(seed)
    for g in range(n_games):
        at = START + dt.timedelta(minutes=20 * g)
        for k in range(n):
            at += dt.timedelta(seconds=rng.choice([0, 5, 30]))
            kind = rng.choice(KINDS)
            yield (f"g{g}", k, k * 4 // n + 1, 700.0 - k, kind, rng.choice(["Bad Pass", "1 of 1", "1 of 2", "2 of 2"]), rng.choice(["A", "B", None]), rng.choice([2, 3]), None, rng.choice(["MISS", "x"]), at)


END = ("end", 0, 1, 0.0, "period", None, None, 2, None, None, START + dt.timedelta(days=2))


@pytest.fixture
def state_store(spark):
    S.with_state_store(spark)
    yield
    spark.conf.unset(S.STORE)


def landed(spark, rows, folder, number, schema=EVENT):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{number:03d}")


def run(spark, stream, at):
    """The stream run until nothing is left; rows are kept by batch."""

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{at}/out/batch={number}")

    q = stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{at}/checkpoint")
    q.trigger(availableNow=True).start().awaitTermination()


def rows(df):
    return sorted(map(tuple, df.select(*(x.split()[0] for x in G.POSSESSION.split(", "))).collect()), key=repr)


def stream_of(spark, folder, schema=EVENT):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def test_possessions_of_a_stream_are_those_of_the_batch(spark, tmp_path, state_store):
    """Rows are shuffled within ten minutes, so they are late but not too late; the stream is ended and begun again twice."""
    rng = random.Random(2)
    events = sorted(played(1), key=lambda e: e[-1] + dt.timedelta(minutes=rng.uniform(0, 9)))
    parts = [events[a : a + 40] for a in range(0, len(events), 40)]
    want = rows(G.possessions(spark.createDataFrame(events, EVENT)))
    for part in (parts[:2], parts[2:4], [*parts[4:], [END]]):
        for p in part:
            landed(spark, p, f"{tmp_path}/in", events.index(p[0]) if p != [END] else 999)
        run(spark, S.possessions(stream_of(spark, f"{tmp_path}/in"), "at_time", "10 minutes", 3600), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").where("game_id <> 'end'")
    assert rows(got) == want
    assert got.select("batch").distinct().count() > 2  # some before the end


def test_a_batch_that_is_run_again_gives_the_same(spark, tmp_path, state_store):
    events = sorted(played(5), key=lambda e: e[-1])
    for k in range(0, len(events), 60):
        landed(spark, events[k : k + 60], f"{tmp_path}/in", k)
    landed(spark, [END], f"{tmp_path}/in", 999)
    stream = S.possessions(stream_of(spark, f"{tmp_path}/in"), "at_time", "1 minute", 3600)
    failed = []

    def write(batch, number):
        if number == 2 and not failed:
            failed.append(number)
            raise OSError("lost")
        batch.write.mode("overwrite").parquet(f"{tmp_path}/out/batch={number}")

    start = lambda: stream.writeStream.foreachBatch(write).option("checkpointLocation", f"{tmp_path}/checkpoint").trigger(availableNow=True).start()
    with pytest.raises(Exception, match="lost"):
        start().awaitTermination()
    start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").where("game_id <> 'end'")
    assert failed and rows(got) == rows(G.possessions(spark.createDataFrame(events, EVENT)))


def test_an_event_after_the_watermark_is_dropped_and_a_silent_game_is_forgotten(spark, tmp_path, state_store):
    at = lambda minutes: START + dt.timedelta(minutes=minutes)
    shot = lambda game, k, team, when: (game, k, 1, 700.0 - k, "Made Shot", None, team, 2, None, None, when)
    for n, part in enumerate([[shot("a", 1, "A", at(0))], [shot("b", 1, "A", at(60))], [shot("b", 2, "B", at(61))], [shot("a", 2, "B", at(1)), shot("b", 3, "A", at(62))], [END]]):
        landed(spark, part, f"{tmp_path}/in", n)
    run(spark, S.possessions(stream_of(spark, f"{tmp_path}/in"), "at_time", "5 minutes", 600), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").where("game_id <> 'end'").select("game_id", "poss_num", "off_team", "end_reason").collect()
    assert sorted(map(tuple, got)) == [("a", 1, "A", "made_fg"), ("b", 1, "A", "made_fg"), ("b", 2, "B", "made_fg"), ("b", 3, "A", "made_fg")]


def test_stints_of_a_stream_are_those_of_the_batch(spark, tmp_path, state_store):
    rng = random.Random(7)
    action = "game_id string, order_number long, period int, seconds_left double, kind string, sub_kind string, person long, points int, possession string, at_time timestamp"
    box = "game_id string, person long, team string, starter boolean, seconds double, team_points int, at_time timestamp"
    plays, lines = [], []
    for g in range(4):
        begin = START + dt.timedelta(minutes=30 * g)
        lines += [(f"g{g}", p, "home" if p < 7 else "away", p % 7 < 5, 700.0, None, begin) for p in range(14)]
        for k in range(30):
            sub = rng.random() < 0.3
            person = rng.randrange(14)
            plays.append((f"g{g}", k, k // 15 + 1, 700.0 - 20 * (k % 15), "substitution" if sub else "2pt", rng.choice(["in", "out"]) if sub else None, person, 2, "home" if person < 7 else "away", begin + dt.timedelta(seconds=20 * k)))
    plays.sort(key=lambda e: e[-1])
    end = END[-1]
    for n, part in enumerate([plays[:50], plays[50:], [("end", 0, 1, 0.0, "2pt", None, 1, 0, None, end)]]):
        landed(spark, part, f"{tmp_path}/plays", n, action)
    for n, part in enumerate([lines, [("end", 1, "home", True, 1.0, None, end)]]):
        landed(spark, part, f"{tmp_path}/box", n, box)
    got = S.stints(stream_of(spark, f"{tmp_path}/plays", action), stream_of(spark, f"{tmp_path}/box", box), "at_time", "10 minutes", 7200)
    run(spark, got, tmp_path)
    names = [x.split()[0] for x in G.STINT.split(", ")]
    key = lambda df: sorted(map(repr, df.where("game_id <> 'end'").select(*names).collect()))
    want = G.stints(spark.createDataFrame(plays, action).drop("at_time"), spark.createDataFrame(lines, box).drop("at_time"))
    assert key(spark.read.parquet(f"{tmp_path}/out")) == key(want) and want.count() > 20


def test_the_query_shares_every_possession_with_the_batch(spark):
    from fieldglass.plans.catalogue import QUERIES

    n, apart = QUERIES["stream_possessions"](spark, "/root/testdata/sf0.001").selectExpr("sum(n)", "sum(apart)").first()
    assert n > 500 and apart == 0


class _Kept:
    """A state that counts how often it is read."""

    def __init__(self, *_):
        self.value, self.reads = None, 0

    def exists(self):
        return self.value is not None

    def get(self):
        self.reads += 1
        return self.value

    def update(self, value):
        self.value = value

    def appendList(self, values):
        self.value = (self.value or []) + values


class _Handle:
    getListState = getValueState = _Kept

    def registerTimer(self, at):
        pass


class _Watermark:
    def getCurrentWatermarkInMs(self):
        return -1


def test_rows_that_wait_are_few_entries_and_are_not_read_before_the_watermark():
    waits = S._Possessions(1000)
    waits.init(_Handle())
    rows = [Row(**(dict.fromkeys(waits.names) | {"at": k, "action_id": k})) for k in range(5000)]
    assert not list(waits.handleInputRows(("g",), iter(rows), _Watermark()))
    assert len(waits.waiting.value) == 3 and waits.waiting.reads == 0
