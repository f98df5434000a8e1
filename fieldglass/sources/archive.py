"""Seasons moved between a hot table and an archive and back, with a journal beside the archive.

Before anything moves, the journal says what is to be done; whoever finds one takes the work up, or undoes it if nothing but
a copy was made (``resume``).  Every step can be run again.  A reader (``both``) sees each row once at any moment: of the
journal's seasons, the archive's rows count only when the hot table has none.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldglass.sources.lake import restored, swapped

ARCHIVE, RESTORE = "archive", "restore"
#: A copy is being made; it is whole and may be moved; all that is left is to take the rows out of where they were.
COPYING, COPIED, MOVED = "copying", "copied", "moved"


class Archive:
    """hot: folder of a Parquet table; cold: folder of the archive, partitioned by the column season.

    after is told of each thing that was done, for tests that end the work there."""

    def __init__(self, spark: SparkSession, hot: str, cold: str, season: str, after: Callable[[str], None] = lambda what: None) -> None:
        self.spark, self.hot, self.cold, self.season, self.after = spark, hot, cold, season, after
        self.hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self.fs = self.hadoop.Path(cold).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # -------------------------------------------------------------- the journal

    @property
    def journal(self) -> str:
        return f"{self.cold}.journal"

    def _path(self, at: str):
        return self.hadoop.Path(at)

    def _note(self, entry: dict | None) -> None:
        """The journal replaced by one rename, or taken away."""
        at, new = self._path(self.journal), self._path(f"{self.journal}.new")
        if entry is not None:
            out = self.fs.create(new, True)
            out.write(bytearray(json.dumps(entry).encode()))
            out.close()
        self.fs.delete(at, False)
        if entry is not None and not self.fs.rename(new, at):
            raise OSError(f"{new} can't be renamed to {at}")
        self.after(f"journal {entry and entry['step']}")

    def noted(self) -> dict | None:
        """What is under way.  A journal that was cut off while it was replaced is the new one."""
        for at in (self.journal, f"{self.journal}.new"):
            if self.fs.exists(self._path(at)):
                stream = self.fs.open(self._path(at))
                try:
                    text = bytes(stream.readAllBytes()).decode()
                finally:
                    stream.close()
                try:
                    return json.loads(text)
                except ValueError:
                    continue  # cut off while it was written: nothing had followed from it
        return None

    # -------------------------------------------------------------- reading

    def hot_rows(self) -> DataFrame:
        return restored(self.spark, self.hot)

    def cold_rows(self) -> DataFrame:
        """The archive's rows, with the hot table's columns."""
        schema = self.hot_rows().schema
        if not self.fs.exists(self._path(self.cold)):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.cold).select(*schema.names)

    def both(self) -> DataFrame:
        hot, cold, entry = self.hot_rows(), self.cold_rows(), self.noted()
        if entry:
            present = self._present(hot, entry["seasons"])
            cold = cold.where(~F.col(self.season).isin(present) | F.col(self.season).isNull()) if present else cold
        return hot.unionByName(cold)

    def _present(self, df: DataFrame, seasons: list) -> list:
        return [r[0] for r in df.where(F.col(self.season).isin(seasons)).select(self.season).distinct().collect()]

    def _counts(self, df: DataFrame, seasons: list) -> dict:
        return {str(r[0]): r[1] for r in df.where(F.col(self.season).isin(seasons)).groupBy(self.season).count().collect()}

    # -------------------------------------------------------------- moving

    def archive(self, seasons: list) -> None:
        """Seasons from the hot table to the archive, where they replace what it had of them."""
        self._begin(ARCHIVE, seasons)
        staging = f"{self.cold}.staging"
        hot = self.hot_rows()
        hot.where(F.col(self.season).isin(seasons)).write.mode("overwrite").partitionBy(self.season).option("compression", "zstd").parquet(staging)
        self.after("staged")
        given, kept = self._counts(hot, seasons), self._counts(self.spark.read.parquet(staging), seasons) if self._has_rows(staging) else {}
        if given != kept:
            raise ValueError(f"{staging} has {kept}, not {given}")
        self._note({"kind": ARCHIVE, "seasons": seasons, "step": COPIED})
        self._archived(seasons)

    def _archived(self, seasons: list) -> None:
        staging = self._path(f"{self.cold}.staging")
        self.fs.mkdirs(self._path(self.cold))
        for found in self.fs.listStatus(staging) if self.fs.exists(staging) else []:
            name = found.getPath().getName()
            if name.startswith(f"{self.season}="):
                to = self._path(f"{self.cold}/{name}")
                self.fs.delete(to, True)
                if not self.fs.rename(found.getPath(), to):
                    raise OSError(f"{name} can't be moved to {self.cold}")
                self.after("moved one")
        self._note({"kind": ARCHIVE, "seasons": seasons, "step": MOVED})
        self._pruned(seasons)

    def _pruned(self, seasons: list) -> None:
        hot = self.hot_rows()
        swapped(hot.where(~F.col(self.season).isin(seasons) | F.col(self.season).isNull()), self.hot)
        self.after("pruned")
        self._end()

    def restore(self, seasons: list) -> None:
        """Seasons from the archive back to the hot table, which must have no rows of them."""
        if present := self._present(self.hot_rows(), seasons):
            raise ValueError(f"the hot table has rows of {present}")
        self._begin(RESTORE, seasons)
        self._restored(seasons)

    def _restored(self, seasons: list) -> None:
        hot = self.hot_rows()
        if not self._present(hot, seasons):  # a swap is done or not
            swapped(hot.unionByName(self.cold_rows().where(F.col(self.season).isin(seasons))), self.hot)
            self.after("put back")
        self._note({"kind": RESTORE, "seasons": seasons, "step": MOVED})
        self._withdrawn(seasons)

    def _withdrawn(self, seasons: list) -> None:
        for s in seasons:
            self.fs.delete(self._path(f"{self.cold}/{self.season}={s}"), True)
            self.after("withdrew one")
        self._end()

    def _has_rows(self, at: str) -> bool:
        return any(f.getPath().getName().startswith(f"{self.season}=") for f in self.fs.listStatus(self._path(at)))

    def _begin(self, kind: str, seasons: list) -> None:
        if self.noted():
            raise ValueError("work is under way, or was cut off: resume it first")
        self._note({"kind": kind, "seasons": seasons, "step": COPYING})

    def _end(self) -> None:
        self.fs.delete(self._path(f"{self.cold}.staging"), True)
        self.fs.delete(self._path(f"{self.journal}.new"), False)
        self._note(None)

    def resume(self) -> str | None:
        """Takes up what was cut off, or undoes it: what was done, or None if nothing was under way."""
        entry = self.noted()
        if not entry:
            self.fs.delete(self._path(f"{self.journal}.new"), False)
            return None
        seasons, step = entry["seasons"], entry["step"]
        if entry["kind"] == RESTORE:
            (self._withdrawn if step == MOVED else self._restored)(seasons)
            return "restored"
        if step == COPYING:
            self._end()
            return "undone"
        (self._pruned if step == MOVED else self._archived)(seasons)
        return "archived"
