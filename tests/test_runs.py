"""Runs of a stream whose keys' rows come in several frames, out of order."""

import itertools
import random

from fieldglass.streaming import tables


def runs_of(spark, rows, at):
    """Closed runs that the stream of the rows, a batch each in files of their own, gives out."""
    for number, batch in enumerate(rows):
        spark.createDataFrame(batch, "key long, id long, v string").repartition(7).write.parquet(f"file://{at}/in/{number}")
    folders = [f"file://{at}/in/{n}" for n in range(len(rows))]
    got = []
    for n, folder in enumerate(folders):
        # Batch by batch, as a stream's folders are added one after another.
        spark.read.parquet(folder).write.mode("append").parquet(f"file://{at}/landed")
        stream = spark.readStream.schema("key long, id long, v string").parquet(f"file://{at}/landed")
        q = tables.folded_runs(stream, "key", "id", "v").writeStream.foreachBatch(lambda b, _: got.extend(tuple(r) for r in b.collect()))
        q.option("checkpointLocation", f"file://{at}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return sorted(got)


def want(rows):
    out = []
    for key, own in itertools.groupby(sorted((r for b in rows for r in b), key=lambda r: r[:2]), key=lambda r: r[0]):
        runs = [(v, [r[1] for r in g]) for v, g in itertools.groupby(own, key=lambda r: r[2])]
        out += [(key, k, v, len(i), i[0], i[-1]) for k, (v, i) in enumerate(runs[:-1])]
    return sorted(out)


def test_keys_of_many_rows_are_in_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [[(k, 40_000 * b + i, rng.choice(["a", "b"])) for i in range(15_000) for k in range(2)] for b in range(2)]
    for b in rows:
        rng.shuffle(b)
    assert runs_of(spark, rows, tmp_path) == want(rows)


def test_nulls_are_a_value(spark, tmp_path):
    rows = [[(1, i, v) for i, v in enumerate([None, None, "a", None, "b", "b"])], [(1, 10 + i, v) for i, v in enumerate([None, "b"])]]
    assert runs_of(spark, rows, tmp_path) == want(rows)
