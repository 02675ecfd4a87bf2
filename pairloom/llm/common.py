"""Helpers shared by the operators: reading texts, and staged tables that are deleted when used up."""

from __future__ import annotations

import ctypes
import functools
import gc

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pairloom.session import scratch_path

# Fixed value: the white space of the word definitions, as inside a character class.
BLANKS = r"\x20\x09-\x0D"
COUNTED_BROADCAST = 2_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def id_and_text(docs: DataFrame) -> DataFrame:
    """``doc_id, text`` alone, with the empty text for null; other columns, whatever their names, stay behind."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def words(text: Column) -> Column:
    """The runs of characters between white space, in order; an empty array without words."""
    return F.filter(F.split(text, f"[{BLANKS}]+"), lambda w: w != "")


def give_back() -> None:
    """Hand memory that is no longer used back to the system: a worker serves task after task."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(run):
    """A function over Arrow batches that gives memory back at the end of its task.

    A worker serves task after task; without this its allocators keep the most that any task has used.
    """
    @functools.wraps(run)
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


class Scratch:
    """Staged tables of one run in the shared folder, each deleted once what was made of it is written.

    What a query returns may still read its last tables, so those stay for the owner of the folder to clear.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root, self.paths = spark, scratch_path(spark, label), {}

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: the lineage is cut and the loss of an executor costs nothing written."""
        path = self.paths[name] = f"{self.root}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def counted_broadcast(df: DataFrame, rows: int, limit: int = COUNTED_BROADCAST) -> DataFrame:
    """Broadcast ``df`` when its counted rows stay within ``limit``; beyond it the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def added_up(rows: DataFrame) -> DataFrame:
    """Sum of the vectors of each key: integer keys first, then a column of packed 64-bit integers of equal length a key.

    Rows stream through a task, which keeps one sum a key; a second call over fewer keys makes a tree of sums.
    """
    *keys, _ = names = rows.columns

    def run(batches):
        sums: dict = {}
        for batch in batches:
            for *key, vector in zip(*(c.to_pylist() for c in batch.columns)):
                values = np.frombuffer(vector, "<i8")
                sums[tuple(key)] = sums[tuple(key)] + values if tuple(key) in sums else values
        if sums:
            columns = [pa.array(list(c), pa.int32()) for c in zip(*sums)] + [pa.array([v.astype("<i8").tobytes() for v in sums.values()])]
            yield pa.RecordBatch.from_arrays(columns, names)

    return rows.repartition(*keys).mapInArrow(run, rows.schema)
