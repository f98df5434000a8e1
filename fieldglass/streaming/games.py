"""Possessions and stints of games as their events stream in: what is given out is what a batch makes of the same events.

Events may come late and out of order by as much as the watermark allows.  A game's events wait, as list state, until the
watermark has passed them; then they are folded in order, and the fold so far is value state.  Possessions are given out as
soon as they are certain: a basket waits for the next event that could be its free throw.  A timer of event time closes a
game after a silence and drops its state, so that what is kept is what the games under way need.  Stints need the whole game
(its box, and who acts next), so their rows wait until it is closed.

State is held by RocksDB; ``with_state_store`` sets that up.  Events later than the watermark are dropped, as by Spark's own
operators; those of a game that was closed before begin another one.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from fieldglass.operators import games

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "action_id long, period int, secs double, kind string, sub_kind string, team string, value int, result string, text string"


def with_state_store(spark: SparkSession) -> None:
    """States of several columns and timers take RocksDB, for streams that are started from now on."""
    spark.conf.set(STORE, ROCKSDB)


#: Rows of a game that are one entry of its list state, as each entry goes to the store and back by itself.
AN_ENTRY = 2000
#: The time that the watermark doesn't pass.
NEVER = 2**63 - 1


def _entries(rows: list[tuple]) -> list[tuple]:
    return [(pickle.dumps(rows[k : k + AN_ENTRY]),) for k in range(0, len(rows), AN_ENTRY)]


class _Waiting(StatefulProcessor):
    """Rows of a game that wait for the watermark, and timers for them and for the game's end.

    wait: names and types of what is kept of a row beside its time."""

    wait: str

    def __init__(self, silence_ms: int) -> None:
        self.silence = silence_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "rows binary")
        # The latest time of all rows and the first of those that wait.
        self.last = handle.getValueState("last", "at long, first long")

    def packed(self, row: Row) -> tuple:
        return tuple(row[c] for c in self.names)

    @property
    def names(self) -> list[str]:
        return ["at", *(x.split()[0] for x in self.wait.split(", "))]

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [self.packed(r) for r in rows]
        last, first = self.last.get() if self.last.exists() else (new[0][0], NEVER)
        last, first = max(last, *(x[0] for x in new)), min(first, *(x[0] for x in new))
        self.last.update((last, first))
        self.waiting.appendList(_entries(new))
        # One for what waits, one for the end; those of earlier batches find nothing to do.
        self.handle.registerTimer(last)
        self.handle.registerTimer(last + self.silence)
        yield from self.passed(key[0], timerValues.getCurrentWatermarkInMs(), False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists():
            ended = expiredTimerInfo.getExpiryTimeInMs() >= self.last.get()[0] + self.silence
            yield from self.passed(key[0], timerValues.getCurrentWatermarkInMs(), ended)

    def passed(self, game_id: str, watermark: int, ended: bool) -> Iterator[Row]:
        """What follows from the rows that the watermark has passed, or from all."""
        last, first = self.last.get()
        if first > watermark and not ended:
            return
        rows = [x for entry in self.waiting.get() for x in pickle.loads(bytes(entry[0]))]
        ready = [x for x in rows if ended or x[0] <= watermark]
        out, held = self.ready(game_id, ready, ended)
        yield from out
        if ended:
            self.clear()
            return
        later = [x for x in rows if x[0] > watermark]
        # Rows that are held were passed and are read again with those that come to pass next.
        self.last.update((last, min((x[0] for x in later), default=NEVER)))
        if rest := held + later:
            self.waiting.put(_entries(rest))
        else:
            self.waiting.clear()  # an empty list can't be stored

    def ready(self, game_id: str, rows: list[tuple], ended: bool) -> tuple[list[Row], list[tuple]]:
        """(what is given out, the rows that have to wait on)."""
        raise NotImplementedError

    def clear(self) -> None:
        self.waiting.clear()
        self.last.clear()

    def close(self) -> None:
        pass


class _Possessions(_Waiting):
    wait = EVENT

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.fold = handle.getValueState("fold", "game binary")

    def ready(self, game_id: str, rows: list[tuple], ended: bool) -> tuple[list[Row], list[tuple]]:
        game = games.Game(game_id)
        if self.fold.exists():
            game.__dict__.update(pickle.loads(bytes(self.fold.get()[0])))
        event = Row(*self.names)
        rows = sorted(rows, key=lambda r: r[1])
        done = game.fold([event(*r) for r in rows], ended)
        out, game.rows = game.rows, []
        self.fold.update((pickle.dumps(game.__dict__),))
        return [Row(**r) for r in out], rows[done:]

    def clear(self) -> None:
        super().clear()
        self.fold.clear()


class _Stints(_Waiting):
    """A game's actions and its box, which wait until it ends."""

    wait = "row binary"

    def packed(self, row: Row) -> tuple:
        of = row.asDict(recursive=True)
        return row["at"], pickle.dumps((of["order_number"], of["late"], of["action"], of["box"]))

    def ready(self, game_id: str, rows: list[tuple], ended: bool) -> tuple[list[Row], list[tuple]]:
        if not ended:
            return [], rows
        first = lambda x: (x is not None, x or 0)
        all_ = sorted((pickle.loads(bytes(r[1])) for r in rows), key=lambda r: (first(r[0]), first(r[1])))
        return [Row(**x) for x in games.walked(game_id, [r[2] for r in all_ if r[2]], [r[3] for r in all_ if r[3]])], []


def _applied(rows: DataFrame, time: str, late: str, silence: int, processor: type[_Waiting], schema: str) -> DataFrame:
    own = rows.withWatermark(time, late).withColumn("at", F.unix_millis(F.col(time).cast("timestamp")))
    out = T.StructType.fromDDL(schema)
    made = own.groupBy("game_id").transformWithState(processor(silence * 1000), out, "append", "eventTime")
    return made.select(*out.names)


def possessions(events: DataFrame, time: str, late: str, silence: int) -> DataFrame:
    """``operators.games.possessions`` of a stream of events, whose rows may be as late as late says; a game ends when
    nothing has come for silence seconds."""
    return _applied(events.select("game_id", time, *(x.split()[0] for x in EVENT.split(", "))), time, late, silence, _Possessions, games.POSSESSION)


def stints(actions: DataFrame, box: DataFrame, time: str, late: str, silence: int) -> DataFrame:
    """``operators.games.stints`` of a stream of actions and one of box lines, each with its time, given out when a game ends."""
    return _applied(games.stint_rows(actions, box, time), time, late, silence, _Stints, games.stint_schema(actions))
