"""Where intermediate tables go, and small helpers that several operators use."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Bytes of text that a numpy kernel works on at once; temporaries take some tens of bytes per byte.
SLICE_BYTES = 1 << 18


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors see, from spark.checkpoint.dir; a temporary one in local mode only."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="fieldglass-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/fieldglass/{name}-{uuid.uuid4().hex}"


#: Spark drops a write's shuffle files when it ends, rather than when the driver next collects its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _written(df: DataFrame, at: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(at)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(at)


def stored(df: DataFrame, name: str) -> DataFrame:
    """df written once as a table in the shared folder and read from there: later plans neither repeat the work nor
    depend on the executors that did it.  It stays, for results that read it later; see Tables for those that don't."""
    return _written(df, new_path(df.sparkSession, name))


class Tables:
    """Stored tables of a piece of work, deleted when it ends: ``with Tables(spark) as own``.  What leaves the work must
    be stored elsewhere before.  A table stored under an earlier one's name replaces it."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark, self.folder, self.paths = spark, new_path(spark, "work"), {}

    def __enter__(self) -> Tables:
        return self

    def __exit__(self, *error) -> None:
        self._delete(self.folder)

    def _delete(self, at: str) -> None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        at = f"{self.folder}/{name}-{uuid.uuid4().hex}"
        out = _written(df, at)
        self.drop(name)
        self.paths[name] = at
        return out

    def drop(self, *names: str) -> None:
        for name in names:
            if at := self.paths.pop(name, None):
                self._delete(at)


def free(df: DataFrame, name: str) -> str:
    """A name that no column of df has: name, with as many underscores as it takes."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    """The column of that name, whatever signs it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def columns(names: Iterable[str]) -> list[Column]:
    """The columns of these names, each once."""
    return [quoted(n) for n in dict.fromkeys(names)]


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: StructType) -> DataFrame:
    """df.mapInArrow(run, schema) for columns of any names: they travel under plain ones, as Spark looks a name with a dot
    up as a field."""
    given, made = df.columns, schema.names

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batch.rename_columns(given) for batch in batches):
            yield out.select(made).rename_columns([f"_{k}" for k in range(len(made))])

    plain = StructType([StructField(f"_{k}", f.dataType, f.nullable) for k, f in enumerate(schema.fields)])
    return df.toDF(*(f"_{k}" for k in range(len(given)))).mapInArrow(named, plain).toDF(*made)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in runs of rows whose text in column is about limit bytes; a longer text is a run of its own."""
    sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < len(sizes):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(at, to - at)
        at = to


def texts(column: pa.Array) -> list[str]:
    """The texts, null as empty."""
    return [x or "" for x in column.to_pylist()]


def create(uri: str) -> pa.NativeFile:
    """A new file in the shared folder, its folder made if there is none.  Names are unique, so that a task that is run
    again leaves the file of its first run alone; which files count is for the caller's table of them to say."""
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    return system.open_output_stream(path)


def opened(uri: str) -> pa.NativeFile:
    from pyarrow import fs

    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_stream(path, buffer_size=1 << 16)


class IdMap:
    """A map of 2 ** BITS bits, one set for the hash of each id held: 8 MB, whatever the number of ids.

    It tells most ids that aren't held from the others before their rows travel; a join has the last word.  The more ids,
    the fewer it tells apart, which costs time and changes no result."""

    BITS = 26

    def __init__(self, ids: DataFrame) -> None:
        """ids: one column of longs.  The driver gets a row for each word of the map at most."""

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                word, bit = IdMap.place(batch.column(0).drop_null().to_numpy())
                yield pa.RecordBatch.from_arrays([pa.array(word), pa.array(bit.view(np.int64))], ["word", "bits"])

        rows = ids.mapInArrow(place, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
        self.bits = np.zeros(1 << (self.BITS - 6), np.uint64)
        self.bits[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)

    @classmethod
    def place(cls, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        from fieldglass.llm._kernels import mix

        k = mix(ids.view(np.uint64)) & np.uint64((1 << cls.BITS) - 1)
        return (k >> np.uint64(6)).astype(np.int64), np.uint64(1) << (k & np.uint64(63))

    def may_hold(self, ids: np.ndarray) -> np.ndarray:
        word, bit = self.place(ids)
        return self.bits[word] & bit != 0


class _Held:
    """Ids of chunks, one after another in an array."""

    def __init__(self) -> None:
        self.index: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start = np.zeros(1 << 14, np.int64)
        self.length = np.zeros(1 << 14, np.int64)

    def add(self, chunks: list[str], flat: np.ndarray, length: np.ndarray) -> None:
        have, to = len(self.index), self.used + len(flat)
        for name, least in (("flat", to), ("start", have + len(chunks)), ("length", have + len(chunks))):
            old = getattr(self, name)
            if least > len(old):
                setattr(self, name, np.concatenate((old, np.zeros(max(least - len(old), len(old)), old.dtype))))
        self.flat[self.used : to] = flat
        self.start[have : have + len(chunks)] = self.used + np.cumsum(length) - length
        self.length[have : have + len(chunks)] = length
        self.used = to
        self.index.update(zip(chunks, range(have, have + len(chunks)), strict=True))

    def take(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after another, how many each has)."""
        k = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        length = self.length[k]
        ends = np.cumsum(length)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.start[k] - ends + length, length)], length


class ChunkIds:
    """Ids of chunks of text, each encoded once and kept: at most limit chunks, in two generations.  When the younger one
    holds half of them it becomes the older one, and what is met of that again is taken over without being encoded."""

    def __init__(self, encode, limit: int = 400_000) -> None:
        """encode: from a list of chunks to a list of their lists of ids."""
        self.encode, self.limit = encode, limit
        self.young, self.old = _Held(), _Held()

    def __call__(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks one after another, how many each has)."""
        fresh = set(chunks).difference(self.young.index)
        if self.young.index and len(self.young.index) + len(fresh) > self.limit // 2:
            self.young, self.old = _Held(), self.young
            fresh = set(chunks)
        known = sorted(fresh.intersection(self.old.index))
        if known:
            self.young.add(known, *self.old.take(known))
        new = sorted(fresh.difference(known))
        for at in range(0, len(new), 4096):
            got = self.encode(new[at : at + 4096])
            length = np.fromiter(map(len, got), np.int64, len(got))
            self.young.add(new[at : at + 4096], np.fromiter((x for ids in got for x in ids), np.int32, int(length.sum())), length)
        return self.young.take(chunks)
