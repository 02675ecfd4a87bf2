"""Incremental materialisation as a stream."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pairloom.operators.materialize import latest_per_key
from pairloom.sources.versions import VersionedTable


def feature_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, glob: str | None = None) -> DataFrame:
    """Parquet files of feature rows as they arrive."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def current_table(table: VersionedTable, keys, ts: str, tie_break=()) -> DataFrame:
    """What the stream has materialised so far: the newest row per key over base and deltas."""
    return table.read_latest(keys, ts, tie_break)


def _query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id a query keeps in its checkpoint: the same after a restart, another one for a new checkpoint."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()["value"])["id"]


def stream_latest(stream: DataFrame, table: VersionedTable, keys, ts: str, tie_break, checkpoint: str,
                  compact_after: int = 16, once: bool = True) -> StreamingQuery:
    """Upsert each micro-batch: its latest rows become a delta, merged when read.

    A late row is compared by event time and loses if older. The batch number is recorded with the data and
    the id of the query's checkpoint, so a replayed batch changes nothing and a new checkpoint starts anew. A batch costs its own size; after ``compact_after`` deltas
    the table is rewritten as one base.
    """

    def upsert(batch: DataFrame, batch_id: int) -> None:
        past, run_id = table.history(), f"stream-{_query_id(batch.sparkSession, checkpoint)}"
        table.write(latest_per_key(batch, keys, ts, tie_break), run_id, kind="delta", batch_id=batch_id, past=past)
        if len(table.parts(past=past)) + 1 > compact_after:
            table.write(current_table(table, keys, ts, tie_break), run_id, kind="base")

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
