"""Splitting passages into size-bounded chunks, and the length profile around it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from pairloom.functions.text import CHUNK_BUDGET, LONG_TEXT, pack_words
from pairloom.sources.tables import require_columns


def chunk(df: DataFrame, id_col: str = "id", text_col: str = "text", max_chars: int = CHUNK_BUDGET) -> DataFrame:
    """One row per chunk; other columns are copied, ids get ``_1``, ``_2``, ... when a text is split.

    A projection and a generator: no shuffle, no Python worker.
    """
    require_columns(df, [text_col])
    others = [c for c in df.columns if c not in (id_col, text_col)]
    packed = df.select(id_col, *others, pack_words(F.col(text_col), max_chars).alias("_chunks"))
    # The outer form, since the plain one infers a filter that would pack every text again.
    counted = packed.select(id_col, *others, F.size("_chunks").alias("_n"), "_chunks")
    rows = counted.select(id_col, *others, "_n", F.posexplode_outer("_chunks").alias("_k", text_col))
    plain = F.col(id_col).cast("string")
    numbered = F.concat_ws("_", plain, (F.col("_k") + 1).cast("string"))
    chunk_id = F.when(F.col("_n") > 1, numbered).otherwise(plain).alias(id_col)
    return rows.select(*[chunk_id if c == id_col else F.col(c) for c in df.columns])


def length_profile(df: DataFrame, text_col: str = "text", limit: int = LONG_TEXT) -> DataFrame:
    """One row: row count, longest text, and how many texts are longer than ``limit``."""
    require_columns(df, [text_col])
    size = F.length(text_col)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.max(size).cast("bigint").alias("max_length"),
        F.count_if(size > limit).alias("n_over"),
    )


def chunk_profile(df: DataFrame, id_col: str = "id", text_col: str = "text", max_chars: int = CHUNK_BUDGET,
                  limit: int = LONG_TEXT) -> DataFrame:
    """The length profile before and after chunking, as two rows ``stage = before | after``.

    Before, texts over ``limit`` are counted; after, chunks over the budget (words longer than it).
    """
    before = length_profile(df, text_col, limit).withColumn("stage", F.lit("before"))
    after = length_profile(chunk(df.select(id_col, text_col), id_col, text_col, max_chars), text_col, max_chars)
    return before.unionByName(after.withColumn("stage", F.lit("after"))).select(
        "stage", "n_rows", "max_length", "n_over")
