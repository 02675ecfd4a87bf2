"""Small tables with the cases every operator has to bear, and plain versions to compare with."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, rows):
    """A documents table from ``(doc_id, text[, lang])``."""
    return spark.createDataFrame([(r[0], r[1], r[2] if len(r) > 2 else None, None, None) for r in rows], COLUMNS)


def clashing(df):
    """Extra columns named like the results of the operators."""
    out = df
    for name in ("id", "rep", "n", "words", "sig", "score", "rank", "blob", "spans", "start", "found", "hash", "leader"):
        from pyspark.sql import functions as F
        out = out.withColumn(name, F.lit("x"))
    return out


def prose(seed: int, n: int, vocabulary: int = 400) -> list[str]:
    draw = random.Random(seed)
    known = ["".join(draw.choice("abcdefghij") for _ in range(draw.randint(1, 8))) for _ in range(vocabulary)]
    return [draw.choice(known) for _ in range(n)]


def by_id(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}
