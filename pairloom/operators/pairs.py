"""Query/document training pairs: positive, random negative, mined hard negative, and the complete set."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.hashing import draw, shuffle_key
from pairloom.operators.positions import dense_position, hash_position
from pairloom.operators.reduction import only_known
from pairloom.operators.similarity import build_index, probe_topk, pruned_topk, topk_join
from pairloom.session import stage

# The closed set of labels and the mining defaults.
POSITIVE, NEGATIVE, HARD_NEGATIVE = "positive", "negative", "hard_negative"
LABELS = (POSITIVE, NEGATIVE, HARD_NEGATIVE)
HARD_FLOOR = 0.3
HARD_PER_QUERY = 2
RANDOM_RATIO = 0.5

PAIR_COLUMNS = ("training_sample_id", "query_text", "document_text", "label", "similarity_score", "query_id",
                "document_id", "metadata", "event_timestamp")


def run_time(run_ts: dt.datetime | str) -> Column:
    """The run's time as a literal without zone, so that a rerun gives the same rows."""
    text = run_ts.isoformat(sep=" ") if isinstance(run_ts, dt.datetime) else run_ts
    return F.lit(text).cast("timestamp_ntz")


def complete_passages(numbered: DataFrame) -> DataFrame:
    """Numbered passages with both a title and a text."""
    return numbered.where(F.col("has_title") & F.col("has_text"))


def _flags(passages: DataFrame) -> DataFrame:
    """Ids, given positions, and whether title and text are there, without reading either again later."""
    given = ["source_row"] if "source_row" in passages.columns else []
    return passages.select("id", *given, F.col("title").isNotNull().alias("has_title"), F.col("text").isNotNull().alias("has_text"))


def _require_unique(rows: DataFrame) -> None:
    twice = rows.groupBy("id").count().where("count > 1").select("id").take(3)
    if twice:
        raise ValueError(f"passage ids are not unique, for example {[r['id'] for r in twice]}")


def passage_rows(passages: DataFrame) -> DataFrame:
    """``id, source_row, has_title, has_text``, stored: the passages as far as keys of pairs are made from them.

    Positions that the passages bring along (``tables.with_file_position``) are kept; otherwise the ids are sorted. Texts are not moved. Ids must
    be unique, since every key of a pair is made from them.
    """
    flags = _flags(passages)
    rows = stage(flags, "rows") if "source_row" in flags.columns else dense_position(flags, "id", "source_row")
    _require_unique(rows)
    return rows


def number_passages(passages: DataFrame) -> DataFrame:
    """Passages with their row position: the one they bring along, which makes this a projection, or else by id.

    By id, only the ids are sorted and the result is stored once. ``has_title`` and ``has_text`` spare later null checks from reading the texts.
    """
    if "source_row" in passages.columns:
        return passages.select("id", "title", "text", "source_row", F.col("title").isNotNull().alias("has_title"), F.col("text").isNotNull().alias("has_text"))
    return stage(passages.select("id", "title", "text").join(passage_rows(passages), "id"), "passages")


def label_value(label: str = "label") -> Column:
    """1.0 for a positive pair, otherwise 0.0."""
    return F.when(F.col(label) == POSITIVE, 1.0).otherwise(0.0)


def positive_pairs(numbered: DataFrame, run_ts) -> DataFrame:
    """Title and text of the same passage, score 1.0. A filter and a projection."""
    return complete_passages(numbered).select(
        F.concat_ws("_", F.lit("pos"), "id", F.col("source_row").cast("string")).alias("training_sample_id"),
        F.col("title").alias("query_text"),
        F.col("text").alias("document_text"),
        F.lit(POSITIVE).alias("label"),
        F.lit(1.0).alias("similarity_score"),
        F.concat_ws("_", F.lit("query"), "id").alias("query_id"),
        F.col("id").alias("document_id"),
        F.to_json(F.struct(F.lit("title_text").alias("pair_type"), "source_row")).alias("metadata"),
        run_time(run_ts).alias("event_timestamp"),
    )


def negatives_for(n_positive: int, ratio: float = RANDOM_RATIO) -> int:
    return int(n_positive * ratio)


def random_draws(spark, n_draws: int, n_rows: int, seed: int) -> DataFrame:
    """``draw_no, query_row, doc_row``: two distinct positions per draw, from md5 of seed and draw number."""
    if n_rows < 2:
        raise ValueError("two different rows cannot be drawn from fewer than two")
    i = F.col("draw_no")
    first = F.pmod(draw(seed, i, "q"), F.lit(n_rows))
    step = F.lit(1) + F.pmod(draw(seed, i, "d"), F.lit(n_rows - 1))
    return (
        spark.range(n_draws).select(F.col("id").alias("draw_no"))
        .withColumn("query_row", first)
        .withColumn("doc_row", F.pmod(F.col("query_row") + step, F.lit(n_rows)))
    )


def _row_keys(numbered: DataFrame) -> DataFrame:
    """The passages without their texts, which no join of keys has to move."""
    return numbered.select("id", "source_row", "has_title", "has_text")


def _with_texts(keys: DataFrame, passages: DataFrame, run_ts, few: bool = False) -> DataFrame:
    """Pairs from ``training_sample_id, _qid, _did, label, similarity_score, metadata``: each side's text is joined once.

    With ``few``, stored keys that leave many passages out, titles and texts are cut down to the keys' ids at the scan, so that no
    other text is exchanged. A text in very many pairs is a skewed join key, which AQE splits.
    """
    titles = passages.where(F.col("title").isNotNull()).select(F.col("id").alias("_qid"), F.col("title").alias("query_text"))
    texts = passages.where(F.col("text").isNotNull()).select(F.col("id").alias("_did"), F.col("text").alias("document_text"))
    if few:
        titles, texts = only_known(titles, "_qid", keys), only_known(texts, "_did", keys)
    others = [c for c in keys.columns if c not in (*PAIR_COLUMNS, "_qid", "_did")]
    return keys.join(titles, "_qid").join(texts, "_did").select(
        "training_sample_id", "query_text", "document_text", "label", "similarity_score",
        F.concat_ws("_", F.lit("query"), "_qid").alias("query_id"), F.col("_did").alias("document_id"), "metadata",
        run_time(run_ts).alias("event_timestamp"), *others)


def _positive_keys(rows: DataFrame) -> DataFrame:
    return complete_passages(rows).select(
        F.concat_ws("_", F.lit("pos"), "id", F.col("source_row").cast("string")).alias("training_sample_id"),
        F.col("id").alias("_qid"), F.col("id").alias("_did"), F.lit(POSITIVE).alias("label"), F.lit(1.0).alias("similarity_score"),
        F.to_json(F.struct(F.lit("title_text").alias("pair_type"), "source_row")).alias("metadata"))


def _random_keys(rows: DataFrame, n_draws: int | None, seed: int) -> DataFrame:
    n_rows = rows.count()
    draws = random_draws(rows.sparkSession, n_rows // 2 if n_draws is None else n_draws, n_rows, seed)
    queries = rows.where("has_title").select(F.col("source_row").alias("query_row"), F.col("id").alias("_qid"))
    docs = rows.where("has_text").select(F.col("source_row").alias("doc_row"), F.col("id").alias("_did"))
    return draws.join(queries, "query_row").join(docs, "doc_row").select(
        F.concat_ws("_", F.lit("neg"), "_qid", "_did", F.col("draw_no").cast("string")).alias("training_sample_id"),
        "_qid", "_did", F.lit(NEGATIVE).alias("label"), F.lit(0.0).alias("similarity_score"),
        F.to_json(F.struct(F.lit("random_negative").alias("pair_type"), "query_row", "doc_row")).alias("metadata"))


def random_negative_pairs(numbered: DataFrame, run_ts, n_draws: int | None = None, seed: int = 42) -> DataFrame:
    """Title of one random passage with the text of another, score 0.0.

    A draw whose title or text is null is dropped, not repeated. Default: half as many draws as rows. The
    draws meet the row numbers first; then each side's text is joined.
    """
    return _with_texts(stage(_random_keys(_row_keys(numbered), n_draws, seed), "random-keys"), numbered, run_ts, few=True)


def hard_negative_matches(passages: DataFrame, encoder, k: int = HARD_PER_QUERY, floor: float = HARD_FLOOR,
                          exclude: str = "id", index_lists: int | None = None, nprobe: int | None = 8,
                          seed: int = 42) -> DataFrame:
    """``query_id, doc_id, similarity, rank``: for each title the k most similar texts at or above the floor.

    Each text is encoded once and the vectors are staged; texts take no part in the join. ``exclude`` says
    what a query may not meet: its own row (``id``), passages of the same ``title``, of the same ``parent``
    (the id before its chunk number) or with the same ``text``. With ``index_lists`` the search goes through
    centroid lists: the ``nprobe`` nearest, which is approximate, or with ``nprobe=None`` all that can hold a
    result, which is exact.
    """
    groups = {"id": None, "title": F.col("title"), "parent": F.regexp_replace("id", r"_\d+$", ""),
              "text": F.md5(F.col("text").cast("binary"))}
    if exclude not in groups:
        raise ValueError(f"exclude must be one of {sorted(groups)}")
    group = groups[exclude]
    valid = passages.where(F.col("title").isNotNull() & F.col("text").isNotNull())
    vectors = stage(valid.select(
        "id", encoder(F.col("title")).alias("query_vec"), encoder(F.col("text")).alias("doc_vec"),
        *([group.alias("grp")] if group is not None else [])), "vectors")
    grp = "grp" if group is not None else None
    if index_lists:
        index = build_index(vectors, "id", "doc_vec", index_lists, seed, grp, keep_copies=k + 1)
        common = {"query_id": "id", "query_vec": "query_vec", "floor": floor, "query_group": grp}
        if nprobe is None:
            return pruned_topk(vectors, index, k, **common)
        return probe_topk(vectors, index, k, nprobe, **common)
    return topk_join(vectors, vectors, k, query_id="id", query_vec="query_vec", doc_id="id", doc_vec="doc_vec",
                     floor=floor, query_group=grp, doc_group=grp)


def _hard_keys(rows: DataFrame, passages: DataFrame, encoder, k: int, floor: float, **search) -> DataFrame:
    matches = stage(hard_negative_matches(passages, encoder, k, floor, **search), "matches")
    rows = dense_position(complete_passages(rows).select("id", "source_row"), "source_row", "_row")
    joined = matches.join(rows.select(F.col("id").alias("query_id"), F.col("_row").alias("query_row")), "query_id").join(
        rows.select(F.col("id").alias("doc_id"), F.col("_row").alias("doc_row")), "doc_id")
    metadata = F.struct(F.lit(HARD_NEGATIVE).alias("pair_type"), F.col("similarity").alias("base_similarity"), "query_row", "doc_row")
    return joined.select(
        F.concat_ws("_", F.lit("hard_neg"), "query_id", "doc_id", F.col("rank").cast("string")).alias("training_sample_id"),
        F.col("query_id").alias("_qid"), F.col("doc_id").alias("_did"), F.lit(HARD_NEGATIVE).alias("label"),
        F.col("similarity").alias("similarity_score"), F.to_json(metadata).alias("metadata"))


def hard_negative_pairs(numbered: DataFrame, encoder, run_ts, k: int = HARD_PER_QUERY, floor: float = HARD_FLOOR,
                        **search) -> DataFrame:
    """Mined hard negatives as pairs. Titles and texts are fetched by id after the top-k.

    Row numbers in the metadata count the complete passages in the order of their positions.
    """
    keys = stage(_hard_keys(_row_keys(numbered), numbered, encoder, k, floor, **search), "hard-keys")
    return _with_texts(keys, numbered, run_ts, few=True)


def complete_training_set(passages: DataFrame, encoder, run_ts, hard_per_query: int = HARD_PER_QUERY,
                          random_ratio: float = RANDOM_RATIO, seed: int = 42, **search) -> DataFrame:
    """All three kinds of pairs in a seeded random order, keyed ``sample_0``, ``sample_1``, ...

    The key each pair had before stays as ``pair_key``; it decides the order.
    """
    rows = passage_rows(passages)
    n_positive = complete_passages(rows).count()
    every = _positive_keys(rows).unionByName(_random_keys(rows, negatives_for(n_positive, random_ratio), seed)).unionByName(
        _hard_keys(rows, passages, encoder, hard_per_query, HARD_FLOOR, **search))
    # The keys of all pairs are stored and placed; only then does each side's text join them, once.
    keys = stage(every.withColumn("pair_key", F.col("training_sample_id")), "pair-keys")
    placed = hash_position(keys, shuffle_key(seed, F.col("pair_key")), "_pos", ties=["pair_key"])
    sample_id = F.concat_ws("_", F.lit("sample"), F.col("_pos").cast("string"))
    return _with_texts(placed.withColumn("training_sample_id", sample_id).drop("_pos"), passages, run_ts).select(*PAIR_COLUMNS, "pair_key")


def label_composition(pairs: DataFrame) -> DataFrame:
    """Rows per label, and the total as label ``total``."""
    return pairs.rollup("label").agg(F.count("*").alias("n"), F.grouping("label").alias("_all")).select(
        F.when(F.col("_all") == 1, "total").otherwise(F.col("label")).alias("label"), "n")


def query_table(passages: DataFrame, encoder, run_ts) -> DataFrame:
    """One row per distinct title (that of the smallest id) with its vector."""
    first = passages.dropna(subset=["title"]).groupBy("title").agg(F.min("id").alias("id"))
    return first.select(
        F.concat_ws("_", F.lit("query"), "id").alias("query_id"),
        F.col("title").alias("query_text"),
        encoder(F.col("title")).alias("query_embedding"),
        F.lit("title").alias("query_type"),
        run_time(run_ts).alias("event_timestamp"),
    )


def reembed(passages: DataFrame, encoder, text_col: str = "text", vector_col: str = "embeddings") -> DataFrame:
    """The corpus with fresh vectors; fails when a vector has not the encoder's length."""
    fresh = encoder(F.col(text_col))
    message = F.concat(F.lit(f"vector length is not {encoder.dim}: "), F.size(vector_col).cast("string"))
    others = [c for c in passages.columns if c != vector_col]
    with_vec = passages.select(*others, fresh.alias(vector_col))
    checked = F.when(F.size(vector_col) == encoder.dim, F.col(vector_col)).otherwise(F.raise_error(message))
    return with_vec.withColumn(vector_col, checked)
