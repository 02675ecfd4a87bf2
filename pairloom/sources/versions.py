"""Versioned tables: new data goes to a new folder, then a manifest row makes it current."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.operators.materialize import latest_per_key

BROADCAST_ROWS = 200_000
MANIFEST_SCHEMA = "version int, kind string, folder string, run_id string, batch_id long, upto string"


@dataclass(frozen=True)
class VersionedTable:
    """A Parquet table that can be rewritten from itself, with its history.

    A ``base`` version holds the whole table, a ``delta`` adds rows to the versions before it. The manifest
    row is written after the data, so a job that dies leaves the table as it was. One writer at a time.
    """

    spark: SparkSession
    path: str

    @property
    def _manifest_path(self) -> str:
        return f"{self.path.rstrip('/')}/manifest"

    def history(self) -> list:
        """All manifest rows in version order: one small row per write."""
        try:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(self._manifest_path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return sorted(rows, key=lambda r: r["version"])

    def exists(self) -> bool:
        return bool(self.history())

    def write(self, df: DataFrame, run_id: str, kind: str = "base", batch_id: int | None = None,
              upto: str | None = None, partition_by=(), past: list | None = None) -> int:
        """Store ``df`` as the next version; a ``batch_id`` already in the manifest is not written again.

        ``past`` is the history where the caller has just read it.
        """
        past = self.history() if past is None else past
        if batch_id is not None:
            for row in past:
                if row["batch_id"] == batch_id and row["run_id"] == run_id:
                    return row["version"]
        version = past[-1]["version"] + 1 if past else 1
        folder = f"v{version:06d}-{uuid.uuid4().hex[:8]}"
        writer = df.write.partitionBy(*partition_by) if partition_by else df.write
        writer.parquet(f"{self.path.rstrip('/')}/data/{folder}")
        entry = {"version": version, "kind": kind, "folder": folder, "run_id": run_id, "batch_id": batch_id,
                 "upto": upto}
        row = self.spark.range(1, numPartitions=1).select(*[F.lit(value).alias(name) for name, value in entry.items()])
        row.write.mode("append").json(self._manifest_path)
        return version

    def parts(self, version: int | None = None, past: list | None = None) -> list:
        """The manifest rows that make up a version: the newest base up to it and the deltas after that."""
        past = self.history() if past is None else past
        rows = [r for r in past if version is None or r["version"] <= version]
        bases = [i for i, r in enumerate(rows) if r["kind"] == "base"]
        return rows[bases[-1]:] if bases else rows

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the base and its deltas; the reader merges deltas when the table has keys."""
        return self.read_parts(self.parts(version))

    def read_latest(self, keys, ts: str, tie_break=(), version: int | None = None) -> DataFrame:
        """The newest row per key over the base and its deltas.

        The base has one row per key. While the deltas are few rows, only the base rows they touch are
        compared with them and the rest of the base is read in place; otherwise all rows are grouped.
        """
        parts = self.parts(version)
        if len(parts) == 1 and parts[0]["kind"] == "base":
            return self.read_parts(parts)
        if not parts or parts[0]["kind"] != "base":
            return latest_per_key(self.read_parts(parts), keys, ts, tie_break)
        base, deltas = self.read_parts(parts[:1]), self.read_parts(parts[1:])
        if deltas.count() > BROADCAST_ROWS:
            return latest_per_key(base.unionByName(deltas), keys, ts, tie_break)
        keys = [keys] if isinstance(keys, str) else list(keys)
        touched = F.broadcast(deltas.select(*keys))  # at most BROADCAST_ROWS keys, as just counted
        rest = base.join(touched, keys, "left_anti").select(*base.columns)
        met = base.join(touched, keys, "left_semi").select(*base.columns)
        return rest.unionByName(latest_per_key(met.unionByName(deltas), keys, ts, tie_break))

    def read_parts(self, rows: list) -> DataFrame:
        if not rows:
            raise ValueError(f"no version of {self.path} yet")
        return self.spark.read.parquet(*[f"{self.path.rstrip('/')}/data/{r['folder']}" for r in rows])


def last_upto(past: list) -> str | None:
    """The end of the newest time window in a history."""
    return max((r["upto"] for r in past if r["upto"]), default=None)
