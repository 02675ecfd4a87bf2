"""A latest-per-key table in buckets of keys: a merge rewrites the buckets it touches, a point read opens those it asks for."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pairloom.operators.materialize import latest_per_key
from pairloom.session import stage

BUCKETS = 64
BUCKET = "_bucket"
MANIFEST_SCHEMA = "version int, kind string, folder string, run_id string, upto string, schema string, buckets array<int>"


@dataclass(frozen=True)
class KeyedTable:
    """One row per key, hashed into ``buckets`` folders, each of which has a version of its own.

    A version's manifest row names the buckets that its folder holds; the current rows of a bucket are those of the newest version
    that names it, so a table is read from as many folders as its buckets were last written by. The manifest row is written after
    the data: a job that dies leaves the table as it was. One writer at a time; the number of buckets is fixed by the first write.
    """

    spark: SparkSession
    path: str
    keys: tuple
    ts: str
    tie_break: tuple = ()
    buckets: int = BUCKETS

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int").alias(BUCKET)

    @property
    def _manifest_path(self) -> str:
        return f"{self.path.rstrip('/')}/buckets"

    def history(self) -> list:
        """All manifest rows in version order."""
        try:
            rows = self.spark.read.schema(MANIFEST_SCHEMA).json(self._manifest_path).collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        rows = sorted(rows, key=lambda r: r["version"])
        if len(rows[0]["buckets"]) != self.buckets:
            raise ValueError(f"{self.path} has {len(rows[0]['buckets'])} buckets, not {self.buckets}")
        return rows

    def placement(self, version: int | None = None, past: list | None = None) -> dict:
        """The manifest row of the newest version that holds each bucket."""
        past = self.history() if past is None else past
        return {b: r for r in past if version is None or r["version"] <= version for b in r["buckets"]}

    def _store(self, df: DataFrame, kind: str, run_id: str, upto: str | None, held: list, past: list) -> int:
        version = past[-1]["version"] + 1 if past else 1
        folder, rows = f"k{version:06d}-{uuid.uuid4().hex[:8]}", df.select("*", self._bucket())
        # A bucket is one task and one file.
        rows.repartition(len(held), BUCKET).write.partitionBy(BUCKET).parquet(f"{self.path.rstrip('/')}/keyed/{folder}")
        entry = {"version": version, "kind": kind, "folder": folder, "run_id": run_id, "upto": upto, "schema": df.schema.json()}
        row = self.spark.range(1, numPartitions=1).select(*[F.lit(v).cast("string" if n != "version" else "int").alias(n) for n, v in entry.items()],
                                                          F.array(*[F.lit(b) for b in sorted(held)]).alias("buckets"))
        row.write.mode("append").json(self._manifest_path)
        return version

    def write(self, latest: DataFrame, run_id: str, upto: str | None = None) -> int:
        """A new version of all buckets; ``latest`` has one row per key."""
        return self._store(latest, "base", run_id, upto, list(range(self.buckets)), self.history())

    def merge(self, newer: DataFrame, run_id: str, upto: str | None = None) -> int:
        """Upsert rows, one per key: buckets without any of them are neither read nor written. The newer time wins, whichever side has it."""
        past = self.history()
        if not past:
            return self.write(newer, run_id, upto)
        newer = stage(newer.select("*", self._bucket()), "upsert")
        # At most one number per bucket reaches the driver.
        touched = sorted(r[BUCKET] for r in newer.select(BUCKET).distinct().collect())
        if not touched:
            return self._note(run_id, upto, past)
        met = self.read(touched, past=past).unionByName(newer.drop(BUCKET))
        return self._store(latest_per_key(met, self.keys, self.ts, self.tie_break), "merge", run_id, upto, touched, past)

    def _note(self, run_id: str, upto: str | None, past: list) -> int:
        """A manifest row for a time window that had no rows."""
        last = past[-1]
        if upto is None:
            return last["version"]
        entry = {"version": last["version"] + 1, "kind": "merge", "folder": last["folder"], "run_id": run_id, "upto": upto, "schema": last["schema"]}
        self.spark.range(1, numPartitions=1).select(*[F.lit(v).alias(n) for n, v in entry.items()], F.array().cast("array<int>").alias("buckets")).write.mode("append").json(self._manifest_path)
        return entry["version"]

    def read(self, buckets: list | None = None, version: int | None = None, past: list | None = None) -> DataFrame:
        """The rows of the given buckets, or of all: each folder is opened for its own buckets only."""
        placed = self.placement(version, past)
        if not placed:
            raise ValueError(f"no version of {self.path} yet")
        by_folder: dict = {}
        for b, row in placed.items():
            if buckets is None or b in buckets:
                by_folder.setdefault(row["folder"], []).append(b)
        schema = T.StructType.fromJson(json.loads(max(placed.values(), key=lambda r: r["version"])["schema"]))
        stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        out = None
        for folder, held in sorted(by_folder.items()):
            part = self.spark.read.schema(stored).parquet(f"{self.path.rstrip('/')}/keyed/{folder}")
            # The folder's partition column: other buckets are pruned before any file is listed for reading.
            part = part.where(F.col(BUCKET).isin(sorted(held))).drop(BUCKET)
            out = part if out is None else out.unionByName(part)
        return self.spark.createDataFrame([], schema) if out is None else out

    def read_for(self, requests: DataFrame) -> DataFrame:
        """The rows of the buckets that the keys of ``requests`` fall into."""
        known = requests.where(F.greatest(*[F.col(k).isNull().cast("int") for k in self.keys], F.lit(0)) == 0)
        return self.read(sorted(r[BUCKET] for r in known.select(self._bucket()).distinct().collect()))
