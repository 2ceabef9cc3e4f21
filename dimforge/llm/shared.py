"""Helpers used by several operators: written intermediate tables and sorted group streams."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.session import checkpoint_root, shuffles_removed


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back (cuts lineage, survives lost executors).

    Its shuffle files are removed once it is written.
    """
    path = f"{checkpoint_root(df.sparkSession)}/dimforge-llm/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """The named columns cast to the given types, whatever other columns ``df`` has."""
    return df.select(*(F.col(f"`{c}`").cast(t).alias(c) for c, t in columns.items()))


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as one struct ``row``, so that columns added beside it can't clash with any."""
    return df.select(F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("row"))


def batch_of(schema: pa.Schema, *arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, type=f.type) for a, f in zip(arrays, schema, strict=True)],
                                      schema=schema)


def lean(run):
    """The function for ``mapInArrow`` that hands freed memory back to the system when its task ends.

    Spark uses a Python worker for many tasks of many stages; without this it stays as large as the largest was.
    """
    def wrapped(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            import ctypes

            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # a C library without it
            pass
    return wrapped


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
MOST_BYTES = 2 << 20


def map_batches(df: DataFrame, run, schema) -> DataFrame:
    """``mapInArrow`` with ``lean(run)``, some 2 MB of rows at a time, or one row if that is longer.

    Spark bounds a batch by its rows alone, and 10,000 whole texts can be all of a
    partition, held by the JVM and by Python.  The setting is read when the plan
    runs, after this returns, so it is the session's; one that is there is kept.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_BYTES, None) is None:
        conf.set(BATCH_BYTES, str(MOST_BYTES))
    return df.mapInArrow(lean(run), schema)


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows with equal ``keys`` from batches that are sorted by them (keys without nulls)."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        start = 0
        rows = list(zip(*columns, strict=True))
        for i, row in enumerate(rows):
            if row != last:
                if i > start:
                    held.append(batch.slice(start, i - start))
                if held:
                    yield pa.Table.from_batches(held)
                held, start, last = [], i, row
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
