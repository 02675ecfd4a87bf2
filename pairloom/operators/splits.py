"""Reproducible holdout, train/eval split, and shards with batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pairloom.functions.hashing import draw, shuffle_key
from pairloom.operators.pairs import LABELS
from pairloom.operators.positions import hash_position
from pairloom.operators.selection import first_rows, nth_hash, up_to
from pairloom.session import counted_broadcast, stage

# Fixed values of the holdout and split.
PER_LABEL = 20
FALLBACK_ROWS, FALLBACK_SHARE = 60, 0.1
TRAIN_SHARE = 0.8


def per_label_sample(df: DataFrame, n: int = PER_LABEL, seed=42, id_col: str = "training_sample_id",
                     labels=LABELS) -> DataFrame:
    """Up to n rows per label in hash order; each task keeps n per label before the shuffle."""
    rank = Window.partitionBy("label").orderBy(shuffle_key(seed, F.col(id_col)), id_col)
    known = df.where(F.col("label").isin(*labels))
    return known.withColumn("_rank", F.row_number().over(rank)).where(F.col("_rank") <= n).drop("_rank")


def uniform_holdout(df: DataFrame, seed=42, id_col: str = "training_sample_id", n_rows: int | None = None) -> DataFrame:
    """The holdout where no row has a known label: a tenth of the rows, at most 60."""
    n_rows = df.count() if n_rows is None else n_rows
    size = min(FALLBACK_ROWS, int(FALLBACK_SHARE * n_rows))
    return first_rows(df, size, shuffle_key(seed, F.col(id_col)), id_col)


def holdout(df: DataFrame, per_label: int = PER_LABEL, seed=42, id_col: str = "training_sample_id",
            labels=LABELS) -> DataFrame:
    """The fixed test set: a sample per label, or the uniform one when no row has a known label."""
    if df.where(F.col("label").isin(*labels)).isEmpty():
        return uniform_holdout(df, seed, id_col)
    return per_label_sample(df, per_label, seed, id_col, labels)


def without(df: DataFrame, removed: DataFrame, id_col: str = "training_sample_id") -> DataFrame:
    """``df`` without the rows of ``removed``, by key."""
    return df.join(removed.select(id_col), id_col, "left_anti")


def train_eval_split(df: DataFrame, seed=42, id_col: str = "training_sample_id", share: float = TRAIN_SHARE,
                     exact: bool = True) -> DataFrame:
    """A column ``split = train | eval``.

    Exact: the first ``int(share * n)`` rows in hash order are for training; the key of the last of them is found from
    counts of hash digits, and the split is a comparison with it. Otherwise each row decides by
    its own hash, with no shuffle, and the sizes are right on average.
    """
    if not exact:
        part = F.when(draw(seed, "split", F.col(id_col)) < int(share * 2 ** 32), "train").otherwise("eval")
        return df.withColumn("split", part)
    key = shuffle_key(seed, "split", F.col(id_col))
    n_train = 0

    def wanted(total: int) -> int:
        nonlocal n_train
        n_train = int(share * total)
        return n_train

    last, reached = nth_hash(df, wanted, key, id_col)
    if reached > n_train:
        # Several rows of one id lie across the cut, so their number alone decides.
        placed = hash_position(df, key, "_pos", ties=[id_col])
        return placed.withColumn("split", F.when(F.col("_pos") < n_train, "train").otherwise("eval")).drop("_pos")
    return df.withColumn("split", F.when(up_to([key, id_col], last), "train").otherwise("eval") if last else F.lit("eval"))


def holdout_split(df: DataFrame, per_label: int = PER_LABEL, seed=42, id_col: str = "training_sample_id",
                  share: float = TRAIN_SHARE) -> DataFrame:
    """All rows with ``split = test | train | eval``. The test rows, few by construction, are stored first."""
    test = stage(holdout(df, per_label, seed, id_col), "holdout")
    rest = without(df, counted_broadcast(test.select(id_col)), id_col)
    return train_eval_split(rest, seed, id_col, share).unionByName(test.withColumn("split", F.lit("test")))


def split_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def shards(df: DataFrame, world_size: int, batch_size: int, epoch: int = 0, seed=42,
           id_col: str = "training_sample_id") -> DataFrame:
    """Columns ``epoch, shard, batch``: a new order each epoch, dealt to the shards one row at a time."""
    order: Column = shuffle_key(seed, epoch, F.col(id_col))
    placed = hash_position(df, order, "_pos", ties=[id_col])
    in_shard = F.floor(F.col("_pos") / world_size)
    return (
        placed.withColumn("epoch", F.lit(epoch).cast("bigint"))
        .withColumn("shard", F.pmod("_pos", F.lit(world_size)).cast("bigint"))
        .withColumn("batch", F.floor(in_shard / batch_size).cast("bigint"))
        .drop("_pos")
    )


def shard_positions(df: DataFrame, world_size: int, batch_size: int, epoch: int = 0, seed=42, id_col: str = "training_sample_id") -> DataFrame:
    """``id, _pos, shard, batch`` as ``shards`` deals them; only ids are moved."""
    placed = hash_position(df.select(id_col), shuffle_key(seed, epoch, F.col(id_col)), "_pos", ties=[id_col])
    return placed.select(id_col, "_pos", F.pmod("_pos", F.lit(world_size)).cast("bigint").alias("shard"),
                         F.floor(F.floor(F.col("_pos") / world_size) / batch_size).cast("bigint").alias("batch"))


def write_shards(sharded: DataFrame, path: str, mode: str = "append") -> None:
    """One folder per epoch and shard, so that a trainer reads only its own rows."""
    sharded.repartition("epoch", "shard", F.pmod("batch", F.lit(64))).sortWithinPartitions("batch").write.mode(
        mode).partitionBy("epoch", "shard").parquet(path)


def in_batch_negatives(df: DataFrame, batch_size: int, seed=42, id_col: str = "pair_id",
                       query_col: str = "query_id", doc_col: str = "document_id") -> DataFrame:
    """For each row of a batch, the documents of the other rows: ``batch, query_id, document_id``.

    Batches are slices of a hash order, so each holds at most ``batch_size`` rows; one shuffle brings a
    batch together, and only ids take part.
    """
    narrow = df.select(id_col, query_col, doc_col)
    placed = hash_position(narrow, shuffle_key(seed, F.col(id_col)), "_pos", ties=[id_col])
    batched = placed.withColumn("batch", F.floor(F.col("_pos") / batch_size).cast("bigint"))
    members = batched.groupBy("batch").agg(F.collect_list(F.struct(id_col, query_col, doc_col)).alias("_rows"))
    asked = members.select("batch", "_rows", F.explode("_rows").alias("_q"))
    met = asked.select("batch", "_q", F.explode("_rows").alias("_d"))
    return met.where(F.col("_q")[id_col] != F.col("_d")[id_col]).select(
        "batch", F.col("_q")[query_col].alias("query_id"), F.col("_d")[doc_col].alias("document_id"))
