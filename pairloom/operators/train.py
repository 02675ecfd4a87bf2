"""A linear adapter over frozen vectors, trained with the contrastive loss.

Two ways: ``train_adapter`` takes one step an epoch over all pairs; ``train_sharded`` takes a step per batch in each of
``world_size`` shards, whose weights are averaged after every epoch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from pairloom.functions.vectors import as_matrix, row_lengths
from pairloom.operators.encode import VECTOR, as_lists
from pairloom.operators.evaluate import MARGIN
from pairloom.operators.pairs import POSITIVE
from pairloom.operators.splits import shard_positions

ADD_GROUPS = 512
ADAPTER_SCHEMA = "i int, weights array<double>"


def identity_adapter(dim: int) -> np.ndarray:
    return np.eye(dim)


def apply_adapter(weights: np.ndarray, vector: Column) -> Column:
    """The vector mapped by the adapter; ``weights`` is dim x dim, so small enough to travel with the task."""

    @F.arrow_udf(VECTOR)
    def mapped(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            given = batch.is_valid()
            out = np.zeros((len(batch), len(weights)), dtype=np.float32)
            if len(batch) > batch.null_count:
                out[given.to_numpy(zero_copy_only=False)] = as_matrix(batch.filter(given)) @ weights.T
            yield as_lists(out, len(batch), len(weights), pc.invert(given))

    return mapped(vector)


def _partial(q: np.ndarray, d: np.ndarray, y: np.ndarray, weights: np.ndarray, margin: float):
    """Gradient sum, loss sum and row count of one batch."""
    u, v = q @ weights.T, d @ weights.T
    un, vn = row_lengths(u), row_lengths(v)
    ok = (un > 0) & (vn > 0)
    q, d, y, u, v, un, vn = q[ok], d[ok], y[ok], u[ok], v[ok], un[ok, None], vn[ok, None]
    cos = ((u * v).sum(axis=1, keepdims=True)) / (un * vn)
    dist, y = 1 - cos, y[:, None]
    slack = np.maximum(0.0, margin - dist)
    loss = 0.5 * (y * dist ** 2 + (1 - y) * slack ** 2)
    pull = (1 - y) * slack - y * dist
    du = pull * (v / (un * vn) - cos * u / un ** 2)
    dv = pull * (u / (un * vn) - cos * v / vn ** 2)
    return du.T @ q + dv.T @ d, float(loss.sum()), int(len(y))


def gradient(pairs: DataFrame, weights: np.ndarray, margin: float = MARGIN, query_vec: str = "query_vec",
             doc_vec: str = "doc_vec") -> tuple[np.ndarray, float]:
    """Mean gradient and mean loss over all pairs.

    Each partition sums its own rows. The sums are added row by row of the matrix, first within ``ADD_GROUPS`` sets
    of partitions and then over these, so no group grows with all partitions and the driver receives one matrix.
    """
    dim = len(weights)
    narrow = pairs.where(F.col(query_vec).isNotNull() & F.col(doc_vec).isNotNull()).select(
        F.col(query_vec).alias("q"), F.col(doc_vec).alias("d"),
        F.when(F.col("label") == POSITIVE, 1.0).otherwise(0.0).alias("y"))
    partial_type = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("g", T.ArrayType(T.DoubleType())),
                                 T.StructField("loss", T.DoubleType()), T.StructField("n", T.LongType())])

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss, n = np.zeros((dim, dim)), 0.0, 0
        for batch in batches:
            if batch.num_rows:
                y = batch.column(2).to_numpy(zero_copy_only=False)
                g, l, m = _partial(as_matrix(batch.column(0)), as_matrix(batch.column(1)), y, weights, margin)
                total, loss, n = total + g, loss + l, n + m
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(dim, dtype=np.int32)), as_lists(total, dim, dim), pa.array(np.full(dim, loss)),
                 pa.array(np.full(dim, n, dtype=np.int64))], names=["i", "g", "loss", "n"])

    def add(rows: pa.Table) -> pa.Table:
        g = as_matrix(rows["g"]).sum(axis=0)
        return pa.table([pa.array([rows["i"][0].as_py()], pa.int32()), as_lists(g, 1, dim),
                         pa.array([sum(rows["loss"].to_pylist())]), pa.array([sum(rows["n"].to_pylist())])],
                        names=["i", "g", "loss", "n"])

    parts = narrow.mapInArrow(partials, partial_type).withColumn("part", F.spark_partition_id() % ADD_GROUPS)
    summed = parts.groupBy("i", "part").applyInArrow(add, partial_type).groupBy("i").applyInArrow(add, partial_type).collect()
    if not summed:
        raise ValueError("no pairs with vectors to train on")
    matrix = np.zeros((dim, dim))
    for row in summed:
        matrix[row["i"]] = row["g"]
    n = summed[0]["n"]
    return matrix / n, summed[0]["loss"] / n


@dataclass(frozen=True)
class AdaptedEncoder:
    """A base encoder whose vectors pass through a trained adapter; used wherever an encoder is."""

    base: object
    weights: np.ndarray

    @property
    def dim(self) -> int:
        return len(self.weights)

    def __call__(self, text: Column) -> Column:
        return apply_adapter(self.weights, self.base(text))


def learning_rate(step: int, base: float, warmup: int) -> float:
    """Linear warm-up over the first ``warmup`` steps."""
    return base * min(1.0, (step + 1) / warmup) if warmup else base


def train_adapter(pairs: DataFrame, dim: int, epochs: int, rate: float, warmup: int = 0, margin: float = MARGIN,
                  weights: np.ndarray | None = None) -> tuple[np.ndarray, list]:
    """Full-batch gradient descent; returns the adapter and the mean loss before each step."""
    weights = identity_adapter(dim) if weights is None else weights
    losses = []
    for epoch in range(epochs):
        grad, loss = gradient(pairs, weights, margin)
        losses.append(loss)
        weights = weights - learning_rate(epoch, rate, warmup) * grad
    return weights, losses


@dataclass(frozen=True)
class EpochReport:
    """What one sharded epoch gave: the mean loss before each step, its rows, and the steps of the longest shard."""

    loss: float
    rows: int
    steps: int


def _trained(rows: np.ndarray, weights: np.ndarray, rate: float, margin: float, dim: int):
    """One step over a batch of rows ``y, q, d``; the weights after it, the loss before it, and the rows that count."""
    g, loss, n = _partial(rows[:, 1:1 + dim], rows[:, 1 + dim:], rows[:, 0], weights, margin)
    return (weights - rate * g / n if n else weights), loss, n


def sharded_epoch(pairs: DataFrame, weights: np.ndarray, epoch: int, rate: float, world_size: int, batch_size: int, first_step: int = 0,
                  warmup: int = 0, margin: float = MARGIN, seed=42, id_col: str = "training_sample_id", query_vec: str = "query_vec",
                  doc_vec: str = "doc_vec") -> tuple[np.ndarray, EpochReport]:
    """One epoch of local steps: each shard goes through its batches in order, from the same weights; then the weights are averaged.

    Shards and batches are those of ``splits.shards``. The ids alone are put in order; the vectors move once, to the
    task of their shard, which streams its sorted rows and holds one batch and one matrix. Every shard is a task of its own, so
    ``world_size`` is the parallelism. Step s (counted over epochs, equal in all shards) uses the rate that ``learning_rate`` gives for
    it. Rows with a missing or zero vector take part in no step; a shard without rows has no say in the average.
    """
    dim = len(weights)
    placed = shard_positions(pairs, world_size, batch_size, epoch, seed, id_col)
    narrow = pairs.select(id_col, F.when(F.col("label") == POSITIVE, 1.0).otherwise(0.0).alias("y"), F.col(query_vec).alias("q"), F.col(doc_vec).alias("d"))
    dealt = narrow.join(placed, id_col).select("shard", "batch", "_pos", "y", "q", "d").repartitionById(world_size, F.col("shard").cast("int"))
    out_type = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("w", T.ArrayType(T.DoubleType())), T.StructField("loss", T.DoubleType()),
                             T.StructField("n", T.LongType()), T.StructField("steps", T.LongType()), T.StructField("shards", T.LongType())])

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, loss, n, at, held = weights.copy(), 0.0, 0, None, []

        def step():
            nonlocal mine, loss, n
            if held:
                mine, l, m = _trained(np.concatenate(held), mine, learning_rate(first_step + at, rate, warmup), margin, dim)
                loss, n = loss + l, n + m
                held.clear()

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            usable = pc.and_(batch.column(2).is_valid(), batch.column(3).is_valid())
            for number in np.unique(numbers):
                if number != at:
                    step()
                    at = int(number)
                rows = batch.filter(pc.and_(usable, pa.array(numbers == number)))
                if rows.num_rows:
                    y = rows.column(1).to_numpy()[:, None]
                    held.append(np.concatenate([y, as_matrix(rows.column(2)), as_matrix(rows.column(3))], axis=1))
        step()
        if at is not None:
            same = lambda value, kind: pa.array(np.full(dim, value, dtype=kind))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), as_lists(mine, dim, dim), same(loss, np.float64), same(n, np.int64),
                                              same(at + 1, np.int64), same(1, np.int64)], names=out_type.names)

    def add(rows: pa.Table) -> pa.Table:
        total = as_matrix(rows["w"]).sum(axis=0)
        return pa.table([rows["i"][:1], as_lists(total, 1, dim), *(pa.array([f(rows[c]).as_py()]) for c, f in (("loss", pc.sum), ("n", pc.sum), ("steps", pc.max), ("shards", pc.sum)))],
                        names=out_type.names)

    ordered = dealt.sortWithinPartitions("batch", "_pos").select("batch", "y", "q", "d")
    parts = ordered.mapInArrow(local, out_type).withColumn("part", F.spark_partition_id() % ADD_GROUPS)
    rows = parts.groupBy("i", "part").applyInArrow(add, out_type).groupBy("i").applyInArrow(add, out_type).collect()
    if not rows or not rows[0]["n"]:
        raise ValueError("no pairs with vectors to train on")
    mean = np.zeros((dim, dim))
    for row in rows:
        mean[row["i"]] = np.array(row["w"]) / row["shards"]
    return mean, EpochReport(rows[0]["loss"] / rows[0]["n"], rows[0]["n"], rows[0]["steps"])


def train_sharded(pairs: DataFrame, dim: int, epochs: int, rate: float, world_size: int, batch_size: int, warmup: int = 0, margin: float = MARGIN,
                  seed=42, id_col: str = "training_sample_id", weights: np.ndarray | None = None) -> tuple[np.ndarray, list[EpochReport]]:
    """``epochs`` sharded epochs over stored pairs; the rate warms up over the first ``warmup`` steps."""
    weights, reports, first = identity_adapter(dim) if weights is None else weights, [], 0
    for epoch in range(epochs):
        weights, report = sharded_epoch(pairs, weights, epoch, rate, world_size, batch_size, first, warmup, margin, seed, id_col)
        reports.append(report)
        first += report.steps
    return weights, reports


def adapter_table(spark: SparkSession, weights: np.ndarray) -> DataFrame:
    return spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(weights)], ADAPTER_SCHEMA)


def load_adapter(df: DataFrame) -> np.ndarray:
    return np.array([r["weights"] for r in df.orderBy("i").collect()])
