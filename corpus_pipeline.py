"""A cleaning pipeline over raw documents: five stages, each written as Parquet and read again by the next.

1. ``language``: documents whose language cannot be told go (no letters, or the best language is
   near chance: below ``NEAR_CHANCE`` / number of languages). Documents in several languages stay; with one or two
   learned languages a score tells nothing of the kind, and only texts without letters go.
2. ``near_duplicates``: of each group of near duplicates the document with the smallest id stays: near are
   shingles of five words with a similarity of 0.8 or more.
3. ``decontaminate``: documents that hold a passage of the benchmark go; short items of 5 to 14 words may differ in a fifth of them too.
4. ``pii``: personal data in texts is masked; ``n_chars`` follows the text.
5. ``tokens``: what is left is encoded, and a digest shows that it decodes again.

Each stage works on whatever its predecessor kept and returns the columns of ``documents``, the last one its digest
columns. An empty table stays empty; null texts are dropped by the first stage. Extra columns go along unchanged, whatever their names, up to the
last stage. Repeated rows of an id share its fate: all stay or all go. Of a group the smallest id stays, so there are no ties. Texts of any
length are read whole, one at a time in a task.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.llm import decontaminate, jaccard, language, pii, sentencepiece
from pairloom.llm.common import table
from pairloom.llm.queries import PIECES
from pairloom.session import scratch_path, ship_package

NEAR_CHANCE = 1.1
# Near duplicates of this stage: shingles of so many words, alike in so many of 100.
NEAR_WIDTH, NEAR_LEAST = 5, 80


def least_score(languages: int) -> float:
    return NEAR_CHANCE / languages if languages > 2 else 0.0


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    net = language.model(docs)
    return docs.filter(language.told(net, least_score(len(net.labels) if net else 0))(F.col("text")))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = jaccard.groups(docs, NEAR_LEAST, NEAR_WIDTH).filter("doc_id <> component_id").select("doc_id")
    return docs.join(copies, "doc_id", "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"), short_share=decontaminate.SHARE).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = docs.withColumn("text", pii.mask_column(docs, F.col("text")))
    return masked.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sentencepiece.encode_documents(docs, public_tokenizers.path(PIECES))


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontaminate", without_benchmark),
    ("pii", without_personal_data),
    ("tokens", encoded),
]
# Languages come from a trained network, so there is no SQL for these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs, root = table(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{root}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
