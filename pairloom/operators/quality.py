"""Readiness and end-to-end checks, as tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from pairloom.sources.views import FeatureView, Registry


def readiness(spark: SparkSession, view: FeatureView) -> DataFrame:
    """One row ``view, path_found, schema_ok, n_rows, ready`` for the source of a view."""
    try:
        df = spark.read.parquet(view.source)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return spark.createDataFrame([(view.name, False, False, 0, False)],
                                     "view string, path_found boolean, schema_ok boolean, n_rows long, ready boolean")
    schema_ok = not any(view.problems(df.schema).values())
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(view.name).alias("view"), F.lit(True).alias("path_found"), F.lit(schema_ok).alias("schema_ok"),
        "n_rows", (F.lit(schema_ok) & (F.col("n_rows") > 0)).alias("ready"))


def view_report(frames: dict, registry: Registry) -> DataFrame:
    """All checks of all views: ``view, check_name, failed``."""
    reports = [registry.view(name).check(df) for name, df in frames.items()]
    out = reports[0]
    for report in reports[1:]:
        out = out.unionByName(report)
    return out


def end_to_end(registry: Registry, pairs: DataFrame, passages: DataFrame, questions: DataFrame, encoder,
               text_col: str = "text", vector_col: str = "embeddings") -> DataFrame:
    """The four checks of a finished pipeline, ``check_name, passed``.

    Views are registered and their schemas match; the encoder gives every question a vector; the pairs hold
    complete rows of known labels; all stored vectors have the encoder's length.
    """
    from pairloom.operators.pairs import LABELS, POSITIVE

    wanted = {"embedding_training_pairs": pairs, "wiki_passages": passages}
    registered = all(n in registry.views and not any(registry.view(n).problems(df.schema).values())
                     for n, df in wanted.items())
    inference = questions.select(encoder(F.col(text_col)).alias("_v")).agg(
        (F.count("*") > 0) & (F.count_if(F.size("_v") != encoder.dim) == 0))
    good = F.col("query_text").isNotNull() & F.col("document_text").isNotNull() & F.col("label").isin(*LABELS)
    data = pairs.agg((F.count_if(F.col("label") == POSITIVE) > 0) & (F.count_if(~good) == 0))
    size = F.coalesce(F.size(vector_col), F.lit(-1))
    dims = passages.agg((F.count("*") > 0) & (F.count_if(size != encoder.dim) == 0))
    spark = pairs.sparkSession
    first = spark.range(1).select(F.lit("views_registered").alias("check_name"), F.lit(registered).alias("passed"))
    for name, row in (("encoder_inference", inference), ("training_data", data), ("vector_dimensions", dims)):
        first = first.unionByName(row.toDF("passed").select(F.lit(name).alias("check_name"), "passed"))
    return first
