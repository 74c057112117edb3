"""Shared helpers: shared folders, written tables, Arrow batches, text bytes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache, update_wrapper

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.session import ensure_checkpoint_dir


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps start
    from files, so a lost executor costs no recomputation of the steps before."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_written(df: DataFrame) -> None:
    """Delete a table made by ``written`` once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def text_of(column: str) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


#: Rows of an Arrow batch; texts may be long.
BATCH_ROWS = 512


def small_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of ``BATCH_ROWS`` at most, so that neither
    side holds thousands of texts at once; a smaller setting stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, BATCH_ROWS)


_STORES: list[WorkerStore] = []
#: Tasks that a store outlives without being asked for.
IDLE_TASKS = 1


class WorkerStore:
    """``lru_cache`` for what a worker process keeps between tasks.

    Workers are used again by later steps, which would carry the vocabularies and
    word stores of all steps before; ``drop_idle_stores`` lets go of those.
    """

    def __init__(self, make: Callable):
        update_wrapper(self, make)
        self.kept, self.idle = lru_cache(maxsize=4)(make), 0
        _STORES.append(self)

    def __reduce__(self):
        return self.__qualname__  # tasks take the store of their own process

    def __call__(self, *args):
        self.idle = 0
        return self.kept(*args)


def drop_idle_stores() -> None:
    """Call at the start of a task: stores go that no task lately asked for."""
    for store in _STORES:
        store.idle += 1
        if store.idle > IDLE_TASKS + 1:
            store.kept.cache_clear()


def map_batches(df: DataFrame, schema: str, work: Callable[[dict[str, list]], dict[str, object]]) -> DataFrame:
    """``mapInArrow`` for a function from columns to columns.

    A batch comes as a dict of Python lists.  Rows in, rows out need not match.
    """
    names = [f.strip().split()[0] for f in schema.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_idle_stores()
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(lo, BATCH_ROWS)
                out = work({n: part.column(i).to_pylist() for i, n in enumerate(part.schema.names)})
                yield pa.RecordBatch.from_arrays([as_array(out[n]) for n in names], names=names)

    return df.mapInArrow(run, schema)


def as_array(values) -> pa.Array:
    return values if isinstance(values, pa.Array) else pa.array(values)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, with underscores in front until ``df`` has none of them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out
