"""End-to-end jobs: chunk a corpus, build the training tables, embed a corpus again, train and evaluate."""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.functions.hashing import shuffle_key
from pairloom.functions.text import CHUNK_BUDGET
from pairloom.operators import evaluate, pairs as pair_ops, refresh, splits, train as adapter
from pairloom.operators.chunk import chunk
from pairloom.operators.positions import hash_position
from pairloom.plans.store import FeatureStore
from pairloom.session import counted_broadcast, stage
from pairloom.sources import metrics
from pairloom.sources.tables import chunked_path, read_table, with_file_position, write_table
from pairloom.sources.versions import VersionedTable


def chunk_job(spark: SparkSession, source: str, target: str | None = None, max_chars: int = CHUNK_BUDGET) -> str:
    """Chunk a passage table; the default target has ``_chunked`` before the extension."""
    df = read_table(spark, source, required=["text"])
    return write_table(chunk(df, max_chars=max_chars), target or chunked_path(source))


def build_training_data(spark: SparkSession, source: str, target: str, encoder, run_ts, hard_per_query: int = 2,
                        random_ratio: float = 0.5, seed: int = 42, row_order: str = "id", **search) -> dict:
    """Write the training pairs and the query vectors; returns their paths and sizes.

    ``row_order`` says what row numbers count: passages by ``id``, or rows as they stand in the ``file``, which needs no sort.
    """
    passages = read_table(spark, source, required=["id", "title", "text"])
    if row_order == "file":
        passages = with_file_position(passages)
    elif row_order != "id":
        raise ValueError("row_order must be id or file")
    pairs_path, queries_path = f"{target}/embedding_training_data.parquet", f"{target}/query_embeddings.parquet"
    write_table(pair_ops.complete_training_set(passages, encoder, run_ts, hard_per_query, random_ratio, seed,
                                               **search), pairs_path)
    write_table(pair_ops.query_table(passages, encoder, run_ts), queries_path)
    return {
        "training_data_path": pairs_path, "training_data_size": spark.read.parquet(pairs_path).count(),
        "query_embeddings_path": queries_path, "query_embeddings_size": spark.read.parquet(queries_path).count(),
    }


def reembed_job(spark: SparkSession, source: str, target: str, encoder, run_id: str) -> int:
    """The corpus with the encoder's vectors as a new version of the target table."""
    return VersionedTable(spark, target).write(pair_ops.reembed(read_table(spark, source), encoder), run_id)


def complete_spine(df: DataFrame, run_ts, id_col: str = "training_sample_id", ts: str = "event_timestamp") -> DataFrame:
    """Add the sample id and the event time where the table lacks them."""
    if id_col not in df.columns:
        key = shuffle_key("spine", F.col("query_text"), F.col("document_text"))
        df = hash_position(df, key, id_col, ties=["query_text", "document_text"])
        df = df.withColumn(id_col, F.concat_ws("_", F.lit("sample"), F.col(id_col).cast("string")))
    if ts not in df.columns:
        df = df.withColumn(ts, pair_ops.run_time(run_ts))
    return df


def load_pairs(store: FeatureStore, mode: str = "pit", max_samples: int | None = None, run_ts=None) -> DataFrame:
    """The training pairs: ``direct`` reads the table, ``pit`` joins it back point-in-time by its own keys.

    Rows without query or document text are left out. With ``max_samples``, the first ones by sample id.
    """
    view = store.registry.view("embedding_training_pairs")
    df = complete_spine(store.source(view), run_ts)
    if max_samples:
        df = splits.first_rows(df, max_samples, "training_sample_id")
    if mode == "pit":
        spine = df.select("training_sample_id", "event_timestamp")
        df = store.historical(spine, [f"{view.name}:{c}" for c in view.fields.names])
    elif mode != "direct":
        raise ValueError("mode must be pit or direct")
    return df.dropna(subset=["query_text", "document_text"])


@dataclass(frozen=True)
class TrainConfig:
    epochs: int = 10
    batch_size: int = 8
    learning_rate: float = 1.0
    world_size: int = 2
    warmup: int = 0                # steps over which the rate rises; with full_batch an epoch is one step
    full_batch: bool = False       # one step an epoch over all pairs instead of a step per batch in each shard
    hard_negative_update_freq: int = 5
    margin: float = evaluate.MARGIN
    seed: int = 42
    write_shards: bool = False
    refresh_queries: int = refresh.QUERIES
    refresh_candidates: int = refresh.CANDIDATES
    refresh_rows: int = refresh.NEW_ROWS
    final_rows: int | None = None  # rows of the test set in the final evaluation; None takes all


def _current(pairs: DataFrame, weights: np.ndarray) -> DataFrame:
    return pairs.withColumn("query_now", adapter.apply_adapter(weights, F.col("query_vec"))).withColumn(
        "doc_now", adapter.apply_adapter(weights, F.col("doc_vec")))


def train_job(spark: SparkSession, pairs: DataFrame, encoder, target: str, config: TrainConfig,
              run_ts: dt.datetime) -> dict:
    """Hold out a test set, train the adapter, refresh hard negatives on schedule, evaluate each epoch.

    Texts are encoded once; the adapter then works on the stored vectors. The state between epochs is
    tables under ``target``: versioned pairs, ``metrics``, ``runs``, and the adapter.
    """
    run_id = uuid.uuid4().hex
    encoded = stage(pairs.withColumn("query_vec", encoder(F.col("query_text"))).withColumn(
        "doc_vec", encoder(F.col("document_text"))), "encoded")
    test = stage(splits.holdout(encoded, seed=config.seed), "test")
    write_table(test, f"{target}/test_set")
    table = VersionedTable(spark, f"{target}/pairs")
    table.write(splits.without(encoded, counted_broadcast(test.select("training_sample_id"))), run_id)
    weights, updates, log = adapter.identity_adapter(encoder.dim), 0, f"{target}/metrics"
    losses, steps = [], 0
    for epoch in range(config.epochs):
        current = table.read()
        if refresh.is_refresh_epoch(epoch, config.hard_negative_update_freq):
            refreshed = refresh.refresh_hard_negatives(
                current, run_ts + dt.timedelta(seconds=epoch), config.seed, epoch,
                encode=lambda rows: _current(rows, weights), new_rows=config.refresh_rows, queries=config.refresh_queries, candidates=config.refresh_candidates,
                query_vec="query_now", doc_vec="doc_now", query_carry=["query_vec"], doc_carry=["doc_vec"])
            table.write(refreshed, run_id)
            current = table.read()
            added = current.where(F.col("training_sample_id").endswith(
                F.date_format(pair_ops.run_time(run_ts + dt.timedelta(seconds=epoch)), "_yyyyMMddHHmmss"))).count()
            if added:
                updates += 1
                metrics.append_metrics(metrics.values(spark, run_id, epoch, {
                    "Hard_Negatives/New_Pairs_Added": added, "Hard_Negatives/Total_Updates": updates}), log)
        split = splits.train_eval_split(current, f"{config.seed}:{updates}")
        train_rows = split.where(F.col("split") == "train").drop("split")
        if config.write_shards:
            splits.write_shards(splits.shards(train_rows, config.world_size, config.batch_size, epoch, config.seed),
                                f"{target}/shards")
        if config.full_batch:
            grad, loss = adapter.gradient(train_rows, weights, config.margin)
            weights = weights - adapter.learning_rate(epoch, config.learning_rate, config.warmup) * grad
            steps += 1
        else:
            weights, done = adapter.sharded_epoch(train_rows, weights, epoch, config.learning_rate, config.world_size, config.batch_size, steps,
                                                  config.warmup, config.margin, config.seed)
            loss, steps = done.loss, steps + done.steps
        losses.append(loss)
        scored = evaluate.with_similarity(_current(test, weights), "query_now", "doc_now")
        sizes = {r["split"]: r["n"] for r in splits.split_sizes(split).collect()}
        report = metrics.scalars(evaluate.similarity_gaps(scored), run_id, epoch + 1, "Evaluation").unionByName(
            metrics.label_counts(current, run_id, epoch + 1)).unionByName(
            metrics.values(spark, run_id, epoch + 1, {
                "Training/Loss": loss, "Training/Steps": steps, "Dataset/Total_Size": sum(sizes.values()),
                "Dataset/Train_Size": sizes.get("train", 0), "Dataset/Eval_Size": sizes.get("eval", 0)}))
        metrics.append_metrics(report, log)
    scored = evaluate.with_similarity(_current(test, weights), "query_now", "doc_now")
    final = evaluate.final_metrics(scored, first=config.final_rows)
    metrics.append_metrics(metrics.scalars(final, run_id, config.epochs, "Final_Evaluation").unionByName(
        metrics.values(spark, run_id, config.epochs, {"Training/Total_Hard_Negative_Updates": updates})), log)
    write_table(adapter.adapter_table(spark, weights), f"{target}/adapter")
    metrics.append_run(spark, f"{target}/runs", {
        "run_id": run_id, "base_model": type(encoder).__name__, "loss_function": "ContrastiveLoss",
        "epochs": config.epochs, "batch_size": config.batch_size, "learning_rate": config.learning_rate,
        "world_size": config.world_size, "hard_negative_update_freq": config.hard_negative_update_freq,
        "warmup_steps": config.warmup, "steps": steps, "epochs_completed": config.epochs, "hard_negative_updates": updates, "output_path": target}, run_ts)
    return {"run_id": run_id, "losses": losses, "hard_negative_updates": updates, "weights": weights}
