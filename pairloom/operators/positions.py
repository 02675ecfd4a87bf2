"""Dense row positions 0..n-1 without a single-task window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.session import stage

LOCAL_BITS = 33  # monotonically_increasing_id keeps the row number within the partition in the low 33 bits


def dense_position(df: DataFrame, order_by, name: str = "pos", partitions: int | None = None) -> DataFrame:
    """``row_number() over (order by keys) - 1`` for a unique key, as a column ``name``.

    Range-partitions and sorts by the key, stages that once so that the cut points are pinned, then adds
    the running row count of the partitions before. Only the offsets (one row per partition) are broadcast.
    """
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    numbered = ranged.sortWithinPartitions(*keys).select(
        *df.columns,
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND((1 << LOCAL_BITS) - 1).alias("_local"),
    )
    pinned = stage(numbered, "positions")
    sizes = pinned.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        pinned.join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + F.col("_local")).alias(name))
    )


def hash_position(df: DataFrame, key: Column, name: str = "pos", ties=(), within=(), digits: int = 4) -> DataFrame:
    """Position in the order of a hex hash ``key`` (then of ``ties``), counted within ``within`` if given.

    The leading digits of the hash are the bucket, a pure function of the row: uniform by construction,
    equal on every recomputation, so nothing needs to be pinned. The bucket counts, at most
    ``16 ** digits`` per value of ``within``, are prefix-summed and broadcast.
    """
    within = list(within)
    hashed = df.withColumn("_h", key).withColumn("_bucket", F.substring("_h", 1, digits))
    counts = hashed.groupBy(*within, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*within).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*within, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    local = F.row_number().over(Window.partitionBy(*within, "_bucket").orderBy("_h", *ties)) - 1
    return (
        hashed.withColumn("_local", local)
        .join(F.broadcast(offsets) if not within else offsets, [*within, "_bucket"])
        .select(*df.columns, (F.col("_offset") + F.col("_local")).cast("bigint").alias(name))
    )
