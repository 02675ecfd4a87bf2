"""The registered queries: each runs an operator over whole tables of a data folder."""

from __future__ import annotations

import datetime as dt
from functools import partial

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from pairloom.functions.vectors import DECIMALS, batched_cosine, dot
from pairloom.operators import evaluate, pairs, quality, splits
from pairloom.operators.chunk import chunk, chunk_profile
from pairloom.operators.encode import HashingEncoder, hashed_counts, with_vector
from pairloom.operators.materialize import latest_per_key
from pairloom.operators.pit import point_in_time
from pairloom.operators.refresh import refresh_hard_negatives
from pairloom.operators.similarity import block_topk, build_index, extend_index, probe_topk, pruned_topk, topk_join
from pairloom.operators.train import AdaptedEncoder, train_adapter, train_sharded
from pairloom.plans import jobs
from pairloom.plans.store import FeatureStore
from pairloom.session import scratch_path, stage
from pairloom.sources import metrics
from pairloom.sources.tables import driver_table, passages_from_documents, spread, with_file_position
from pairloom.sources.versions import VersionedTable
from pairloom.sources.views import Entity, FeatureView, Registry, standard_views
from pairloom.streaming.materialize import current_table, feature_stream, stream_latest

SEED = 42
RUN_TS = "2024-02-01 00:00:00"
DIM = 384
VECTOR_DIM = 64
COUNTS = HashingEncoder(DIM, normalize=False)
TTL = dt.timedelta(days=7)
WORLD, BATCH = 4, 8
CUTS = (dt.datetime(2024, 1, 16), dt.datetime(2024, 1, 31))
WINDOW = dt.timedelta(days=30)
EPOCHS, RATE = 4, 5.0
LOCAL_RATE, WARMUP = 1.0, 10
LISTS = 16
KEY_BUCKETS = 16
LIFETIMES = {"click": 7, "view": 14, "signup": 30}
FIRST = 200
SELF_IN_TEN = (10, 5, 4, 1)
BAND = (0.1, 0.8)
REFRESH_ALL = 200
LOG_DIM = 32
LOG_CONFIG = jobs.TrainConfig(epochs=3, batch_size=64, learning_rate=1.0, world_size=2, warmup=5, hard_negative_update_freq=2)
EVENTS_SCHEMA = T.StructType([
    T.StructField("user_id", T.LongType()), T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])
EVENT_COLUMNS = EVENTS_SCHEMA.names


# ---------------------------------------------------------------- inputs

def passages(spark: SparkSession, folder: str) -> DataFrame:
    return passages_from_documents(spread(driver_table(spark, folder, "documents")))


def passages_by_file(spark: SparkSession, folder: str) -> DataFrame:
    """The passages with their position in file order."""
    return passages_from_documents(spread(with_file_position(driver_table(spark, folder, "documents"))))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spread(driver_table(spark, folder, "documents").select(F.col("doc_id").alias("id"), "text"))


def embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "embeddings")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return driver_table(spark, folder, "events").select(*EVENT_COLUMNS)


def stored_training_set(spark: SparkSession, folder: str) -> DataFrame:
    """The training set as the build step writes it, which is what the later steps read."""
    return stage(_training_set(spark, folder), "training-set")


def vector_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector with one other; positive when the labels agree, else hard from a cosine of 0.1 on."""
    v = embeddings(spark, folder)
    n = v.count()
    a = v.select(F.col("vec_id").alias("a_id"), F.col("embedding").alias("query_vec"), F.col("label").alias("a_label"),
                 F.pmod(F.col("vec_id") * 7 + 1, F.lit(n)).alias("b_id"))
    b = v.select(F.col("vec_id").alias("b_id"), F.col("embedding").alias("doc_vec"), F.col("label").alias("b_label"))
    joined = a.join(b, "b_id").where("a_id <> b_id")
    joined = evaluate.with_similarity(joined)
    label = F.when(F.col("a_label") == F.col("b_label"), "positive").when(
        F.col("similarity") >= 0.1, "hard_negative").otherwise("negative")
    day = F.make_dt_interval(F.pmod("a_id", F.lit(28)).cast("int"))
    return joined.select(
        F.format_string("vp_%d", "a_id").alias("training_sample_id"), label.alias("label"), "similarity",
        F.round("similarity", DECIMALS).alias("similarity_score"),
        F.format_string("q%d", "a_id").alias("query_id"), F.format_string("d%d", "b_id").alias("document_id"),
        F.format_string("query %d", "a_id").alias("query_text"),
        F.format_string("document %d", "b_id").alias("document_text"),
        (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + day).alias("event_timestamp"), "query_vec", "doc_vec")


def dialogue_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """A user turn and the assistant turn after it."""
    turns = driver_table(spark, folder, "conversations")
    asked = turns.where("role = 'user'").select("conv_id", "turn", (F.col("turn") + 1).alias("next"))
    told = turns.where("role = 'assistant'").select("conv_id", F.col("turn").alias("next"))
    key = F.format_string("%d_%d", "conv_id", "turn")
    return asked.join(told, ["conv_id", "next"]).select(
        key.alias("pair_id"), F.concat(F.lit("q_"), key).alias("query_id"),
        F.format_string("d_%d_%d", "conv_id", "next").alias("document_id"))


# ---------------------------------------------------------------- chunking and pairs

def q_chunk_passages(spark, folder):
    return chunk(documents(spark, folder))


def q_chunk_profile(spark, folder):
    return chunk_profile(documents(spark, folder))


def _unpack(df: DataFrame, strings=(), numbers=()) -> DataFrame:
    """Fields of the JSON metadata as columns."""
    out = df
    for name in strings:
        out = out.withColumn(name, F.get_json_object("metadata", f"$.{name}"))
    for name in numbers:
        out = out.withColumn(name, F.get_json_object("metadata", f"$.{name}").cast("bigint"))
    return out.drop("metadata")


def q_passage_coverage(spark, folder):
    """Characters of title and text together, blanks and line ends aside."""
    both = F.concat(F.coalesce("title", F.lit("")), F.coalesce("text", F.lit("")))
    return passages(spark, folder).select("id", F.length(F.translate(both, " \n", "")).cast("bigint").alias("n_chars"))


def q_positive_pairs(spark, folder):
    numbered = pairs.number_passages(passages(spark, folder))
    return _unpack(pairs.positive_pairs(numbered, RUN_TS), ["pair_type"], ["source_row"])


def q_positive_pairs_by_file(spark, folder):
    """Rows numbered as they stand in the file: one narrow job."""
    numbered = pairs.number_passages(passages_by_file(spark, folder))
    return _unpack(pairs.positive_pairs(numbered, RUN_TS), ["pair_type"], ["source_row"])


def q_random_negatives(spark, folder):
    numbered = pairs.number_passages(passages(spark, folder))
    n = pairs.negatives_for(pairs.complete_passages(numbered).count())
    return _unpack(pairs.random_negative_pairs(numbered, RUN_TS, n, SEED), ["pair_type"], ["query_row", "doc_row"])


def q_query_table(spark, folder):
    table = pairs.query_table(passages(spark, folder), COUNTS, RUN_TS)
    squared = F.round(dot("query_embedding", "query_embedding")).cast("bigint")
    dim = F.size("query_embedding").cast("bigint")
    return table.select("query_id", "query_text", "query_type", "event_timestamp", dim.alias("dim"),
                        squared.alias("norm_squared"))


def q_hash_tokens(spark, folder):
    return hashed_counts(passages(spark, folder), "id", "text", DIM)


def q_hard_negatives_vec(spark, folder):
    v = embeddings(spark, folder)
    found = topk_join(v, v, pairs.HARD_PER_QUERY, query_id="vec_id", query_vec="embedding", doc_id="vec_id",
                      doc_vec="embedding", floor=pairs.HARD_FLOOR)
    doc = v.select(F.col("vec_id").alias("doc_id"), F.col("label").alias("doc_label"))
    return found.join(doc, "doc_id").select(
        "query_id", F.col("doc_id").alias("document_id"), "doc_label", "similarity", "rank")


def q_hard_negatives_text(spark, folder):
    numbered = pairs.number_passages(passages(spark, folder))
    return _unpack(pairs.hard_negative_pairs(numbered, COUNTS, RUN_TS), ["pair_type"], ["query_row", "doc_row"])


def _training_set(spark, folder):
    return pairs.complete_training_set(passages(spark, folder), COUNTS, RUN_TS, seed=SEED)


def q_training_set(spark, folder):
    return _training_set(spark, folder).drop("metadata")


def q_training_set_by_file(spark, folder):
    return pairs.complete_training_set(passages_by_file(spark, folder), COUNTS, RUN_TS, seed=SEED).drop("metadata")


def q_label_composition(spark, folder):
    return pairs.label_composition(stored_training_set(spark, folder))


# ---------------------------------------------------------------- jobs that write and read back

def _built(spark, folder) -> str:
    """The folder in which the prepare job has left its tables."""
    root = scratch_path(spark, "built")
    passages(spark, folder).write.parquet(f"{root}/passages.parquet")
    jobs.build_training_data(spark, f"{root}/passages.parquet", root, COUNTS, RUN_TS, seed=SEED)
    return root


def q_pairs_round_trip(spark, folder):
    return spark.read.parquet(f"{_built(spark, folder)}/embedding_training_data.parquet").drop("metadata")


def q_queries_round_trip(spark, folder):
    table = spark.read.parquet(f"{_built(spark, folder)}/query_embeddings.parquet")
    return table.select("query_id", "query_text", "query_type", "event_timestamp", F.size("query_embedding").cast("bigint").alias("dim"))


def q_load_pairs_pit(spark, folder):
    root = _built(spark, folder)
    return jobs.load_pairs(FeatureStore(spark, root, standard_views(root, DIM)), "pit").drop("metadata")


def q_load_pairs_first(spark, folder):
    root = _built(spark, folder)
    first = jobs.load_pairs(FeatureStore(spark, root, standard_views(root, DIM)), "direct", max_samples=FIRST)
    return first.drop("metadata", "pair_key")


def q_spine_completed(spark, folder):
    """Question and answer turns that lack a sample id and a time."""
    turns = driver_table(spark, folder, "conversations")
    told = turns.where("role = 'assistant'").select("conv_id", F.col("turn").alias("next"), F.col("text").alias("document_text"))
    asked = turns.where("role = 'user'").select("conv_id", (F.col("turn") + 1).alias("next"), F.col("text").alias("query_text"))
    return jobs.complete_spine(asked.join(told, ["conv_id", "next"]).select("query_text", "document_text"), RUN_TS)


def q_chunks_written(spark, folder):
    root = scratch_path(spark, "chunked")
    passages(spark, folder).write.parquet(f"{root}/passages.parquet")
    return spark.read.parquet(jobs.chunk_job(spark, f"{root}/passages.parquet")).select("id", "text")


def q_version_history(spark, folder):
    """Versions of the online table after each incremental run, and the rows each one reads."""
    store, e = _event_store(spark), events(spark, folder)
    for end in CUTS:
        store.materialize_incremental("user_events", end, e)
    table = store.online_table("user_events")
    rows = [(r["version"], r["kind"], r["upto"], store.online("user_events", r["version"]).count()) for r in table.history()]
    return spark.createDataFrame(rows, "version int, kind string, upto string, n_rows long")


# ---------------------------------------------------------------- splits

def q_holdout_split(spark, folder):
    whole = splits.holdout_split(stored_training_set(spark, folder), seed=SEED)
    return whole.select("training_sample_id", "label", pairs.label_value().alias("target"), "split")


def q_split_sizes(spark, folder):
    return splits.split_sizes(splits.holdout_split(stored_training_set(spark, folder), seed=SEED))


def q_holdout_fallback(spark, folder):
    rows = driver_table(spark, folder, "documents").select(
        F.col("doc_id").cast("string").alias("training_sample_id"), F.col("lang").alias("label"))
    return splits.holdout_split(rows, seed=SEED).select("training_sample_id", "split")


def q_train_shards(spark, folder):
    ids = stored_training_set(spark, folder).select("training_sample_id")
    dealt = [splits.shards(ids, WORLD, BATCH, e, SEED) for e in (0, 1)]
    return dealt[0].unionByName(dealt[1])


def q_in_batch_negatives(spark, folder):
    return splits.in_batch_negatives(dialogue_pairs(spark, folder), BATCH, SEED)


# ---------------------------------------------------------------- feature views

def _purchases_and_clicks(spark, folder):
    e = events(spark, folder)
    clicks = e.where("event_type = 'click'").select(
        "user_id", F.col("ts").alias("click_ts"), F.col("event_id").alias("click_id"),
        F.col("value").alias("click_value"))
    return e.where("event_type = 'purchase'").select("event_id", "user_id", "ts"), clicks


def q_pit_features(spark, folder, **tuning):
    spine, clicks = _purchases_and_clicks(spark, folder)
    return point_in_time(spine, clicks, "user_id", "ts", "click_ts", ["click_id", "click_value"], TTL, ["click_id"],
                         **tuning)


def q_historical_features(spark, folder):
    """For each purchase, the user's last event up to a second before, by feature name."""
    store = _event_store(spark, f"{folder}/events.parquet")
    spine = events(spark, folder).where("event_type = 'purchase'").select(
        F.col("event_id").alias("purchase_id"), "user_id",
        (F.col("ts") - F.expr("INTERVAL 1 SECOND")).alias("event_timestamp"))
    return store.historical(spine, ["user_events:event_id", "user_events:event_type", "user_events:value"])


def q_historical_many(spark, folder):
    """For each purchase the user's last click, view and signup before it, from three views in one pass."""
    root, registry = scratch_path(spark, "views"), Registry()
    for kind, days in LIFETIMES.items():
        rows = events(spark, folder).where(F.col("event_type") == kind)
        rows.select("user_id", "ts", F.col("event_id").alias(f"{kind}_id"), F.col("value").alias(f"{kind}_value")).write.parquet(f"{root}/{kind}")
        fields = T.StructType([T.StructField(f"{kind}_id", T.LongType()), T.StructField(f"{kind}_value", T.DoubleType())])
        registry.register(FeatureView(f"{kind}s", Entity("user_id", ("user_id",), T.LongType()), fields, dt.timedelta(days=days), f"{root}/{kind}", ts_col="ts", tie_break=(f"{kind}_id",)))
    spine = events(spark, folder).where("event_type = 'purchase'").select("event_id", "user_id", F.col("ts").alias("event_timestamp"))
    return FeatureStore(spark, root, registry).historical(spine, [f"{kind}s:{kind}_{c}" for kind in LIFETIMES for c in ("id", "value")])


def q_latest_per_key(spark, folder):
    return latest_per_key(events(spark, folder), "user_id", "ts", ["event_id"])


def q_latest_without_time(spark, folder):
    return latest_per_key(events(spark, folder), "user_id", None, ["event_id"])


def _event_store(spark, source: str | None = None) -> FeatureStore:
    fields = [f for f in EVENTS_SCHEMA if f.name not in ("user_id", "ts")]
    view = FeatureView("user_events", Entity("user_id", ("user_id",), T.LongType()), T.StructType(fields), WINDOW,
                       source, ts_col="ts", tie_break=("event_id",))
    registry = Registry()
    registry.register(view)
    return FeatureStore(spark, scratch_path(spark, "store"), registry)


def q_incremental_materialize(spark, folder):
    store, e = _event_store(spark), events(spark, folder)
    for end in CUTS:
        store.materialize_incremental("user_events", end, e)
    return store.online("user_events")


def q_online_lookup(spark, folder):
    """The state of every customer as a user, unknown for most."""
    store = _event_store(spark)
    store.materialize("user_events", events(spark, folder))
    requests = driver_table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.online_features(requests, ["user_events:event_id", "user_events:event_type", "user_events:value"])


def _keyed_store(spark) -> FeatureStore:
    store = _event_store(spark)
    return FeatureStore(spark, store.root, store.registry, key_buckets=KEY_BUCKETS)


def q_keyed_materialize(spark, folder):
    """The incremental materialisation into buckets of keys: each run merges into the buckets it touches."""
    store, e = _keyed_store(spark), events(spark, folder)
    for end in CUTS:
        store.materialize_incremental("user_events", end, e)
    return store.online("user_events")


def q_keyed_lookup(spark, folder):
    """Point reads that open only the buckets of the keys asked for."""
    store = _keyed_store(spark)
    store.materialize("user_events", events(spark, folder))
    requests = driver_table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return store.online_features(requests, ["user_events:event_id", "user_events:event_type", "user_events:value"])


def q_stream_materialize(spark, folder):
    """The events in three instalments that arrive out of order, with a restart before each and a compaction."""
    table, incoming = VersionedTable(spark, scratch_path(spark, "streamed")), scratch_path(spark, "incoming")
    state = scratch_path(spark, "stream-state")
    for part in (2, 0, 1):
        events(spark, folder).where(F.col("event_id") % 3 == part).write.mode("append").parquet(incoming)
        stream = feature_stream(spark, incoming, EVENTS_SCHEMA)
        stream_latest(stream, table, "user_id", "ts", ["event_id"], state, compact_after=2).awaitTermination()
    return current_table(table, "user_id", "ts", ["event_id"]).select(*EVENT_COLUMNS)


def q_view_validation(spark, folder):
    """Every seventh passage without its id, every fifth without its time."""
    number = F.col("id").cast("bigint")
    p = passages(spark, folder).withColumn("event_timestamp", F.when(number % 5 != 0, pairs.run_time(RUN_TS)))
    p = p.withColumn("id", F.when(number % 7 != 0, F.col("id")))
    frames = {
        # Vectors of the titles, so passages without one fail the length check.
        "wiki_passages": with_vector(p, COUNTS, "title", "embeddings"),
        "embedding_training_pairs": stored_training_set(spark, folder),
        "query_embeddings": pairs.query_table(passages(spark, folder), COUNTS, RUN_TS),
    }
    return quality.view_report(frames, standard_views("unused", DIM))


def q_source_readiness(spark, folder):
    """The event view's source is there and fits; the passage view's source is not."""
    found = quality.readiness(spark, _event_store(spark, f"{folder}/events.parquet").registry.view("user_events"))
    missing = quality.readiness(spark, standard_views(f"{folder}/missing", DIM).view("wiki_passages"))
    return found.unionByName(missing)


def q_end_to_end(spark, folder):
    p = passages(spark, folder).withColumn("event_timestamp", pairs.run_time(RUN_TS))
    return quality.end_to_end(standard_views("unused", DIM), stored_training_set(spark, folder),
                              pairs.reembed(p, COUNTS), driver_table(spark, folder, "benchmark"), COUNTS)


def q_reembed_corpus(spark, folder):
    fresh = pairs.reembed(chunk(passages(spark, folder)), COUNTS)
    return fresh.select("id", F.size("embeddings").cast("bigint").alias("dim"),
                        F.round(dot("embeddings", "embeddings")).cast("bigint").alias("norm_squared"))


def fixed_adapter() -> np.ndarray:
    """Each component takes on its right neighbour's value, so that whole counts stay whole."""
    return np.eye(DIM) + np.roll(np.eye(DIM), 1, axis=1)


def _lengths(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.where(F.col(vector).isNotNull()).select(
        key, F.size(vector).cast("bigint").alias("dim"), F.round(dot(vector, vector)).cast("bigint").alias("norm_squared"))


def q_reembed_adapted(spark, folder):
    p = passages(spark, folder).where(F.col("text").isNotNull())
    return _lengths(pairs.reembed(p, AdaptedEncoder(COUNTS, fixed_adapter())), "id", "embeddings")


def q_on_demand_lookup(spark, folder):
    """Vectors of the adapted encoder, computed from each request's text when it is read."""
    store = FeatureStore(spark, scratch_path(spark, "store"), standard_views("unused", DIM, AdaptedEncoder(COUNTS, fixed_adapter())))
    asked = driver_table(spark, folder, "benchmark").select("item_id", F.col("text").alias("query_text"))
    return _lengths(store.online_features(asked, ["fine_tuned_query_embeddings:query_embedding"]), "item_id", "query_embedding")


# ---------------------------------------------------------------- search

_SEARCH = {"query_id": "vec_id", "query_vec": "embedding", "exclude_same_id": False}


def _found(df: DataFrame) -> DataFrame:
    return df.select("query_id", F.col("doc_id").alias("id"), F.col("similarity").alias("distance"), "rank")


def q_vector_topk(spark, folder):
    v = embeddings(spark, folder)
    return _found(topk_join(v, v, 5, doc_id="vec_id", doc_vec="embedding", **_SEARCH))


def q_vector_topk_pruned(spark, folder):
    v = embeddings(spark, folder)
    return _found(pruned_topk(v, build_index(v, "vec_id", "embedding", LISTS, SEED), 5, **_SEARCH))


def q_vector_topk_blocks(spark, folder):
    v = embeddings(spark, folder)
    return _found(block_topk(v, build_index(v, "vec_id", "embedding", LISTS, SEED), 5, **_SEARCH)[0])


def q_vector_topk_followed(spark, folder):
    """An index of two thirds of the vectors that then follows the rest, with lists split beyond a size: nothing is trained again."""
    v = embeddings(spark, folder)
    index = build_index(v.where("vec_id % 3 <> 0"), "vec_id", "embedding", LISTS, SEED)
    index = extend_index(index, v.where("vec_id % 3 = 0"), "vec_id", "embedding", max_list=2 * sum(index.sizes.values()) // LISTS)
    return _found(pruned_topk(v, index, 5, **_SEARCH))


def q_vector_topk_ivf(spark, folder):
    """All lists are probed, which is exact; fewer give the approximate form."""
    v = embeddings(spark, folder)
    return _found(probe_topk(v, build_index(v, "vec_id", "embedding", LISTS, SEED), 5, LISTS, **_SEARCH))


def q_rag_answer(spark, folder):
    """Every benchmark text as a question against all chunks."""
    store = FeatureStore(spark, scratch_path(spark, "store"), standard_views("unused", DIM))
    chunks = chunk(passages(spark, folder)).select(
        "id", "text", COUNTS(F.col("text")).alias("embeddings"), pairs.run_time(RUN_TS).alias("event_timestamp"))
    store.materialize("wiki_passages", chunks)
    questions = driver_table(spark, folder, "benchmark").select("item_id", F.col("text").alias("question"))
    return store.answer("wiki_passages", questions, "item_id", "question", COUNTS, 10)


# ---------------------------------------------------------------- refresh, evaluation, training

def q_refresh_negatives(spark, folder):
    return refresh_hard_negatives(stage(vector_pairs(spark, folder), "pairs"), RUN_TS, SEED, 5, band=BAND).select(
        "training_sample_id", "label", "similarity_score", "query_id", "document_id", "event_timestamp")


def q_refresh_all(spark, folder):
    """All positives against all documents of the default band, drawn by priority; nothing is sampled first."""
    pairs_now = stage(vector_pairs(spark, folder), "pairs")
    return refresh_hard_negatives(pairs_now, RUN_TS, SEED, 5, REFRESH_ALL, queries=None, candidates=None).select(
        "training_sample_id", "label", "similarity_score", "query_id", "document_id", "event_timestamp")


def _rounded(df: DataFrame) -> DataFrame:
    doubles = {f.name for f in df.schema if f.dataType.typeName() == "double"}
    return df.select(*[F.round(c, DECIMALS).alias(c) if c in doubles else F.col(c) for c in df.columns])


def q_eval_by_label(spark, folder):
    return _rounded(evaluate.similarity_by_label(vector_pairs(spark, folder)))


def q_eval_gaps(spark, folder):
    return _rounded(evaluate.similarity_gaps(vector_pairs(spark, folder)))


def q_eval_final(spark, folder):
    return _rounded(evaluate.final_metrics(vector_pairs(spark, folder)))


def q_eval_grades(spark, folder):
    """Grades of four sets of positives, in which so many in ten vectors meet themselves and the others another vector."""
    p = stage(vector_pairs(spark, folder).withColumn("_own", F.pmod(F.substring("query_id", 2, 20).cast("bigint"), F.lit(10))), "pairs")
    negatives = p.where("label <> 'positive'").select("label", "similarity")
    out = None
    for share in SELF_IN_TEN:
        own = F.when(F.col("_own") < share, batched_cosine("query_vec", "query_vec")).otherwise(F.col("similarity"))
        rows = p.select(F.lit(pairs.POSITIVE).alias("label"), own.alias("similarity")).unionByName(negatives)
        row = evaluate.final_metrics(rows).select(F.lit(share).cast("bigint").alias("self_in_ten"), "positive_similarity_mean", "negative_similarity_mean",
                                                  "overall_quality_score", "grade")
        out = row if out is None else out.unionByName(row)
    return _rounded(out)


def q_eval_metrics_table(spark, folder):
    report = metrics.scalars(evaluate.final_metrics(vector_pairs(spark, folder)), "run", 1, "Final_Evaluation")
    counts = metrics.label_counts(vector_pairs(spark, folder), "run", 1)
    return _rounded(report.unionByName(counts))


def q_contrastive_loss(spark, folder):
    return _rounded(evaluate.contrastive_loss(vector_pairs(spark, folder)))


def q_adapter_training(spark, folder):
    _, losses = train_adapter(stage(vector_pairs(spark, folder), "pairs"), VECTOR_DIM, EPOCHS, RATE)
    return spark.createDataFrame([(i, round(float(x), DECIMALS)) for i, x in enumerate(losses)], "epoch long, loss double")


def q_adapter_training_sharded(spark, folder):
    """Steps by batch in four shards, weights averaged after each epoch, a rate that warms up by steps."""
    weights, reports = train_sharded(stage(vector_pairs(spark, folder), "pairs"), VECTOR_DIM, EPOCHS, LOCAL_RATE, WORLD, BATCH, WARMUP, seed=SEED)
    trace = round(float(np.trace(weights)), DECIMALS)
    rows = [(i, round(float(r.loss), DECIMALS), r.rows, r.steps, trace) for i, r in enumerate(reports)]
    return spark.createDataFrame(rows, "epoch long, loss double, n_rows long, n_steps long, final_trace double")


def _trained(spark, folder) -> str:
    """The folder of a training run over the stored training set."""
    target = scratch_path(spark, "run")
    jobs.train_job(spark, stored_training_set(spark, folder), HashingEncoder(LOG_DIM), target, LOG_CONFIG, dt.datetime.fromisoformat(RUN_TS))
    return target


def q_training_log(spark, folder):
    """Sizes, labels and steps that a run has written after each epoch; one refresh lies between the second and the third."""
    log = spark.read.parquet(f"{_trained(spark, folder)}/metrics")
    return log.where("tag like 'Dataset/%' or tag = 'Training/Steps'").select("tag", "step", "value")


def q_run_record(spark, folder):
    return spark.read.parquet(f"{_trained(spark, folder)}/runs").select(
        "base_model", "loss_function", "epochs", "batch_size", "learning_rate", "world_size", "hard_negative_update_freq", "epochs_completed", "timestamp",
        "warmup_steps", "steps")


QUERIES = {name[2:]: f for name, f in list(globals().items()) if name.startswith("q_")}
# The same join with keys cut into time slices, as for a key that holds much of the data.
QUERIES["pit_features_sliced"] = partial(q_pit_features, hot_rows=10)
