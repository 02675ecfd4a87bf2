"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import alignment, decontaminate, jaccard, language, neighbours, packing, pii, quality, runs, secrets, sentencepiece, substring, urls
from pairloom.llm.common import table
from pairloom.llm.oracle import ORACLE  # noqa: F401

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.json"
# The rules of the url query.
URL_RULES = (
    urls.HostRule("allow", "com/"), urls.HostRule("block", "example.com/en/"), urls.HostRule("allow", "www.example.com/en/"),
    urls.HostRule("block", "net/es/"), urls.HostRule("block", "net/fr/"),
)


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece.encode_documents(table(spark, folder, "documents"), public_tokenizers.path(PIECES))


def op2_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return language.predict(docs, language.model(docs))


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(table(spark, folder, "documents"))


def op4_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find(table(spark, folder, "documents"))


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op8_urls(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(table(spark, folder, "pages"), URL_RULES)


def op9_substring(spark: SparkSession, folder: str) -> DataFrame:
    return substring.without_repeats(table(spark, folder, "documents"))


def op10_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def planted(doc_id: int, n: int) -> np.ndarray | None:
    """Fixed rule of the run query: a tenth of the documents repeat a stretch of theirs to the end."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def op11_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.periodic_runs(table(spark, folder, "documents"), rewrite=planted)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string"))), "\n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "runs", "collapsed", longest.alias("longest")
    ).select(
        "doc_id", "n_runs", (-F.col("longest.col2")).alias("start"), F.col("longest.length").alias("length"), (-F.col("longest.col3")).alias("period"),
        F.expr("1000 * longest.length div -longest.col3").alias("exponent_milli"),
        F.sha2(F.when(F.col("n_runs") == 0, "").otherwise(F.concat(listed, F.lit("\n"))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), public_tokenizers.path(BYTES))


def op13_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"), public_tokenizers.path(BYTES), public_tokenizers.path(PIECES))


QUERIES = {f.__name__: f for f in (op1_sentencepiece, op2_language, op3_ngram_jaccard, op4_pii, op5_quality, op6_neighbours, op7_secrets, op8_urls, op9_substring, op10_decontaminate, op11_runs, op12_packing, op13_alignment)}
