"""Similarity metrics of labelled pairs, quality score, contrastive loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.functions.vectors import batched_cosine
from pairloom.operators.pairs import HARD_NEGATIVE, NEGATIVE, POSITIVE, label_value
from pairloom.operators.splits import first_rows

# Full separation, the grade limits, and the loss margin.
FULL_SEPARATION = 0.6
GRADES = ((0.8, "excellent"), (0.6, "good"), (0.4, "moderate"))
LOWEST_GRADE = "poor"
MARGIN = 0.5


def with_similarity(pairs: DataFrame, a: str = "query_vec", b: str = "doc_vec", name: str = "similarity") -> DataFrame:
    """Cosine of the two vectors of a row; no matrix, since only matching rows count."""
    return pairs.withColumn(name, batched_cosine(a, b))


def similarity_by_label(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("label").agg(F.count("*").alias("n"), F.avg("similarity").alias("mean_similarity"))


def _mean_of(label: str) -> Column:
    return F.avg(F.when(F.col("label") == label, F.col("similarity")))


def similarity_gaps(pairs: DataFrame) -> DataFrame:
    """One row of means per label and gaps; a gap is NULL when a side has no rows."""
    means = pairs.agg(
        _mean_of(POSITIVE).alias("positive_similarity"),
        _mean_of(HARD_NEGATIVE).alias("hard_negative_similarity"),
        _mean_of(NEGATIVE).alias("negative_similarity"),
    )
    return means.withColumn(
        "pos_hard_gap", F.col("positive_similarity") - F.col("hard_negative_similarity")
    ).withColumn("pos_neg_gap", F.col("positive_similarity") - F.col("negative_similarity"))


def quality_score(positive_mean: Column, negative_mean: Column) -> Column:
    """Mean of the clipped positive similarity and the clipped, scaled separation; 0 when a side is missing."""
    separation = positive_mean - negative_mean
    closeness = F.when(positive_mean > 0, F.least(positive_mean, F.lit(1.0))).otherwise(0.0)
    spread = F.when(separation > 0, F.least(separation / FULL_SEPARATION, F.lit(1.0))).otherwise(0.0)
    return F.when(separation.isNull(), 0.0).otherwise((closeness + spread) / 2)


def grade(score: Column) -> Column:
    ladder = F
    for limit, name in GRADES:
        ladder = ladder.when(score >= limit, name)
    return ladder.otherwise(LOWEST_GRADE)


def final_metrics(pairs: DataFrame, first: int | None = None, order=("training_sample_id",)) -> DataFrame:
    """One row: mean and population deviation of both sides, separation, quality score, grade.

    ``first`` keeps that many rows of each side in ``order``, as a report on a test set may want.
    """
    if first is not None:
        is_positive = F.col("label") == POSITIVE
        pairs = first_rows(pairs.where(is_positive), first, *order).unionByName(
            first_rows(pairs.where(~is_positive), first, *order))
    is_positive = F.col("label") == POSITIVE
    pos, neg = F.when(is_positive, F.col("similarity")), F.when(~is_positive, F.col("similarity"))
    stats = pairs.agg(
        F.avg(pos).alias("positive_similarity_mean"), F.stddev_pop(pos).alias("positive_similarity_std"),
        F.avg(neg).alias("negative_similarity_mean"), F.stddev_pop(neg).alias("negative_similarity_std"),
    )
    p, n = F.col("positive_similarity_mean"), F.col("negative_similarity_mean")
    scored = stats.withColumn("similarity_separation", p - n).withColumn("overall_quality_score", quality_score(p, n))
    return scored.withColumn("grade", grade(F.col("overall_quality_score")))


def contrastive_loss(pairs: DataFrame, margin: float = MARGIN) -> DataFrame:
    """Mean contrastive loss (Hadsell, Chopra, LeCun 2006) over distance ``1 - cosine``."""
    y, d = label_value(), 1 - F.col("similarity")
    loss = 0.5 * (y * d * d + (1 - y) * F.pow(F.greatest(F.lit(0.0), margin - d), 2))
    return pairs.agg(F.count("similarity").alias("n"), F.avg(loss).alias("loss"))
