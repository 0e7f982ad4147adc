"""Occurrences of values in lists, and the rows that have them, counted in arrays.

A list's values would be a row each in SQL, most of them strings that are built, hashed and
compared one by one. Here a task takes some megabytes of lists at a time, numbers their different values
and counts the numbers; only different values leave it, with their counts so far.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# functions that run in tasks are sent by value: executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bytes of lists that are counted together, bytes that go to a task at once, and where that is set.
STEP_BYTES, BATCH_BYTES = 16 << 20, 4 << 20
BATCH_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def count_lists(lists: list[pa.Array]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different values of some lists, how often each is there, and in how many lists."""
    joined = pa.concat_arrays(lists)
    numbered = joined.flatten().dictionary_encode(null_encoding="encode")  # null lists have no values
    codes, different = numbered.indices.to_numpy().astype(np.int64), len(numbered.dictionary)
    sizes = joined.value_lengths().fill_null(0).to_numpy()
    pairs = np.sort(codes * len(sizes) + np.repeat(np.arange(len(sizes)), sizes))
    once = pairs[np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]]
    return (numbered.dictionary, np.bincount(codes, minlength=different),
            np.bincount(once // max(1, len(sizes)), minlength=different))


def counted(batches: Iterable[pa.RecordBatch], name: str, step: int) -> Iterator[pa.RecordBatch]:
    """value, total, rows: of ``step`` bytes of lists after another."""
    lists, held = [], 0

    def done() -> pa.RecordBatch:
        values, total, rows = count_lists(lists)
        return pa.RecordBatch.from_arrays([values, pa.array(total), pa.array(rows)], [name, "total", "rows"])

    for batch in batches:
        lists.append(batch.column(0))
        held += batch.nbytes
        if held >= step:
            yield done()
            lists, held = [], 0
    if lists:
        yield done()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs meanwhile sends lists to tasks by ``BATCH_BYTES``, unless that is set: 10,000 long ones would be a lot."""
    if spark.conf.get(BATCH_KEY, None) is not None:
        yield
        return
    spark.conf.set(BATCH_KEY, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(BATCH_KEY)


def occurrences(df: DataFrame, lists: str, name: str, rows: str = "rows") -> DataFrame:
    """``name``, total, ``rows``: how often each value is in the lists of a column, and in how many rows."""
    (kind,) = (f.dataType.elementType.simpleString() for f in df.schema.fields if f.name == lists)
    step = STEP_BYTES
    parts = df.select(lists).mapInArrow(
        lambda batches: counted(batches, name, step), f"`{name}` {kind}, total long, rows long")
    return parts.groupBy(name).agg(F.sum("total").alias("total"), F.sum("rows").alias(rows))
