"""Games as files that land in a folder, read as a stream that can stop anywhere and go on; and which games are still due.

The stream's offsets are its own: before a batch is read, the files that make it up are written down as the next entry of a
log beside the stream, and the offset is the number of that entry.  A batch that is run again reads the same files whatever
has landed since, a file counts once whichever batch it was in, and files may land in any order of names.  Entries that are
committed are gathered into one, so the log stays short.

Registered as ``landed_games``::

    spark.dataSource.register(landed.LandedGames)
    spark.readStream.format("landed_games").option("path", folder).option("log", folder).load()
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition


class _Folder:
    """Files of a folder that all executors see."""

    def __init__(self, uri: str) -> None:
        from pyarrow import fs

        self.fs, self.path = fs.FileSystem.from_uri(uri)

    def names(self) -> list[str]:
        from pyarrow import fs

        found = self.fs.get_file_info(fs.FileSelector(self.path, allow_not_found=True))
        return sorted(f.base_name for f in found if f.is_file and not f.base_name.startswith((".", "_")))

    def read(self, name: str) -> bytes:
        with self.fs.open_input_stream(f"{self.path}/{name}") as f:
            return f.read()

    def write(self, name: str, data: bytes) -> None:
        """All of a file, or none of it: written beside and renamed."""
        self.fs.create_dir(self.path, recursive=True)
        with self.fs.open_output_stream(f"{self.path}/.{name}") as f:
            f.write(data)
        self.fs.move(f"{self.path}/.{name}", f"{self.path}/{name}")

    def delete(self, name: str) -> None:
        self.fs.delete_file(f"{self.path}/{name}")


class _Log:
    """Numbered lists of files; ``upto-n`` has those of the entries up to n together."""

    def __init__(self, uri: str) -> None:
        self.folder = _Folder(uri)

    def entries(self) -> tuple[int, dict[int, str]]:
        """(the last gathered number, names of the entries after it by number)."""
        names = self.folder.names()
        upto = max((int(n[5:]) for n in names if n.startswith("upto-")), default=0)
        return upto, {int(n[5:]): n for n in names if n.startswith("file-") and int(n[5:]) > upto}

    def files(self, number: int) -> list[str]:
        return json.loads(self.folder.read(f"file-{number:09d}"))

    def taken(self) -> tuple[int, set[str]]:
        """(the last number, all files so far)."""
        upto, later = self.entries()
        out = set(json.loads(self.folder.read(f"upto-{upto:09d}"))) if upto else set()
        return max(later, default=upto), out.union(*(self.files(n) for n in later))

    def add(self, number: int, files: list[str]) -> None:
        self.folder.write(f"file-{number:09d}", json.dumps(files).encode())

    def gather(self, through: int) -> None:
        """Entries up to a number, which are done with, as one; each step leaves a log that reads the same."""
        upto, later = self.entries()
        done = [n for n in later if n <= through]
        if done:
            have = json.loads(self.folder.read(f"upto-{upto:09d}")) if upto else []
            self.folder.write(f"upto-{max(done):09d}", json.dumps(sorted({*have, *(f for n in done for f in self.files(n))})).encode())
        for name in self.folder.names():
            number = int(name[5:])
            if number < max(done, default=upto) or number == max(done, default=upto) and name.startswith("file-"):
                self.folder.delete(name)


class _Files(InputPartition):
    def __init__(self, files: list[str]) -> None:
        self.files = files


class _Reader(DataSourceStreamReader):
    def __init__(self, path: str, log: str, most: int, parts: int) -> None:
        self.path, self.at, self.most, self.parts = path, log, most, parts

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        log = _Log(self.at)
        last, taken = log.taken()
        new = [n for n in _Folder(self.path).names() if n not in taken][: self.most]
        if new:
            log.add(last + 1, new)
        return {"entry": last + bool(new)}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        log = _Log(self.at)
        files = [f for n in range(start["entry"] + 1, end["entry"] + 1) for f in log.files(n)]
        return [_Files(files[k :: self.parts]) for k in range(min(self.parts, len(files)))]

    def read(self, partition: _Files) -> Iterator[tuple]:
        folder = _Folder(self.path)
        for name in partition.files:
            yield name, name.rpartition(".")[0] or name, folder.read(name).decode()

    def commit(self, end: dict) -> None:
        # The batch before the committed one may still be asked for after a restart.
        _Log(self.at).gather(end["entry"] - 1)


class LandedGames(DataSource):
    """(file, game_id, payload) of the files in path, each once.  Options: path and log (folders that all executors share),
    most (files of a batch, 1000), parts (tasks of a batch, 8)."""

    @classmethod
    def name(cls) -> str:
        return "landed_games"

    def schema(self) -> str:
        return "file string, game_id string, payload string"

    def streamReader(self, schema) -> _Reader:
        o = self.options
        return _Reader(o["path"], o["log"], int(o.get("most", 1000)), int(o.get("parts", 8)))


def due(schedule: DataFrame, have: DataFrame, missing: DataFrame, live: str) -> DataFrame:
    """Games (game_id, season, played) of schedule that are still to be fetched: neither had nor known as missing.  What is
    missing isn't known of the live season, whose games may only not have been played yet."""
    known = missing.join(schedule.where(F.col("season") != live), "game_id", "left_semi")
    return schedule.join(have, "game_id", "left_anti").join(known, "game_id", "left_anti")


def found_missing(schedule: DataFrame, asked: DataFrame, have: DataFrame, missing: DataFrame, live: str) -> DataFrame:
    """(game_id) of the games that are missing after a run that asked for some: those that were before, and those that were
    asked for in vain, but none of the live season, nor any that is there by now."""
    vain = missing.select("game_id").union(asked.select("game_id")).distinct().join(have, "game_id", "left_anti")
    return vain.join(schedule.where(F.col("season") == live), "game_id", "left_anti")
