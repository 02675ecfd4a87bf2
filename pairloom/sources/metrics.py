"""Metrics and run records as append-only tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

METRICS_SCHEMA = "run_id string, tag string, step int, value double"
RUNS_SCHEMA = ("run_id string, base_model string, loss_function string, epochs int, batch_size int, "
               "learning_rate double, world_size int, hard_negative_update_freq int, epochs_completed int, "
               "hard_negative_updates int, output_path string, timestamp timestamp_ntz, warmup_steps int, steps long")


def scalars(row: DataFrame, run_id: str, step: int, prefix: str) -> DataFrame:
    """The numeric columns of a one-row report as ``run_id, tag, step, value`` rows, NULLs left out."""
    names = [f.name for f in row.schema if f.dataType.typeName() in ("double", "float", "long", "integer")]
    entries = F.array(*[F.struct(F.lit(f"{prefix}/{n}").alias("tag"), F.col(n).cast("double").alias("value"))
                        for n in names])
    return row.select(F.inline(entries)).where(F.col("value").isNotNull()).select(
        F.lit(run_id).alias("run_id"), "tag", F.lit(step).alias("step"), "value")


def label_counts(pairs: DataFrame, run_id: str, step: int) -> DataFrame:
    counts = pairs.groupBy("label").agg(F.count("*").alias("n"))
    return counts.select(F.lit(run_id).alias("run_id"), F.concat(F.lit("Dataset/"), "label", F.lit("_count")).alias("tag"),
                         F.lit(step).alias("step"), F.col("n").cast("double").alias("value"))


def values(spark: SparkSession, run_id: str, step: int, tagged: dict) -> DataFrame:
    rows = [(run_id, tag, step, float(value)) for tag, value in tagged.items()]
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def append_metrics(metrics: DataFrame, path: str) -> None:
    metrics.write.mode("append").parquet(path)


def append_run(spark: SparkSession, path: str, record: dict, now: dt.datetime) -> None:
    """One row per run: configuration, what was completed, where the result lies."""
    names = [part.strip().split(" ")[0] for part in RUNS_SCHEMA.split(",")]
    row = tuple(now if n == "timestamp" else record.get(n) for n in names)
    spark.createDataFrame([row], RUNS_SCHEMA).write.mode("append").parquet(path)
