"""Folds over the rows of a key in order: one shuffle, rows stream by in Arrow batches, many keys to a batch."""

from __future__ import annotations

from collections import namedtuple
from collections.abc import Callable, Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows that a task gives out at once.
AT_ONCE = 2000


def folded(df: DataFrame, key: str, order: list[str], fold: Callable[[list], list[dict]], schema: str) -> DataFrame:
    """What fold makes of the rows of each key, a list of tuples with df's column names in the given order (nulls first).

    A task holds one key's rows at a time."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))
    names, at = df.columns, df.columns.index(key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = namedtuple("row", names, rename=True)
        rows = (row(*x) for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made = (x for _, own in groupby(rows, key=lambda r: r[at]) for x in fold(list(own)))
        while some := list(islice(made, AT_ONCE)):
            yield pa.RecordBatch.from_pylist(some, arrow)

    return df.repartition(key).sortWithinPartitions(*(F.asc_nulls_first(c) for c in (key, *order))).mapInArrow(run, schema)
