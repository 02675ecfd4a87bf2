import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators.chunk import chunk, chunk_profile, length_profile
from pairloom.sources.tables import chunked_path


def by_hand(text, budget):
    """Word by word packing, as a check on the regular expression."""
    if not text or len(text) <= budget or not text.split():
        return [text]
    done, line = [], ""
    for word in text.split():
        longer = f"{line} {word}" if line else word
        if line and len(longer) > budget:
            done.append(line)
            line = word
        else:
            line = longer
    return [*done, line]


EDGES = [
    None, "", "x" * 380, "x" * 381, " " * 381, "w" * 400, "short " * 30 + "w" * 400 + " tail" * 30,
    "two  spaces  kept", "tab\tno-break line sep " * 30, "\x1c\x1d\x1e\x1f\x85" * 100 + "word",
    "zero​width " * 60, "astral \U0001d518\U0001f600 letters " * 40, ("a" * 379 + " ") * 3, ("a" * 380 + " ") * 3,
    ("a" * 381 + " ") * 3, " lead and trail " * 40, "a b " * 200,
]


def rows_of(spark, texts, budget=380):
    df = spark.createDataFrame([(str(i), t, i * 10) for i, t in enumerate(texts)], "id string, text string, extra int")
    return chunk(df, max_chars=budget)


def expected_rows(texts, budget=380):
    out = []
    for i, t in enumerate(texts):
        pieces = by_hand(t, budget)
        for k, piece in enumerate(pieces):
            out.append((f"{i}_{k + 1}" if len(pieces) > 1 else str(i), piece, i * 10))
    return out


def test_edges(spark):
    got = [tuple(r) for r in rows_of(spark, EDGES).collect()]
    assert sorted(got, key=str) == sorted(expected_rows(EDGES), key=str)


@pytest.mark.parametrize("budget", [1, 7, 20])
def test_random_texts(spark, budget):
    rng = random.Random(budget)
    alphabet = "ab é \t\n　\U0001f600 "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(120))) for _ in range(300)]
    got = [tuple(r) for r in rows_of(spark, texts, budget).collect()]
    assert sorted(got, key=str) == sorted(expected_rows(texts, budget), key=str)


def test_words_survive(spark):
    text = " ".join(f"word{i}" for i in range(2000))
    pieces = [r.text for r in rows_of(spark, [text]).orderBy(F.length("id"), "id").collect()]
    assert " ".join(pieces).split() == text.split()
    assert max(map(len, pieces)) <= 380


def test_missing_text_column(spark):
    with pytest.raises(ValueError, match="text"):
        chunk(spark.createDataFrame([("1",)], "id string"))


def test_profiles(spark):
    df = spark.createDataFrame([("1", "x" * 513), ("2", "y" * 512), ("3", None), ("4", "a " * 300)],
                               "id string, text string")
    assert length_profile(df).first().asDict() == {"n_rows": 4, "max_length": 600, "n_over": 2}
    after = chunk_profile(df).where("stage = 'after'").first()
    assert (after.n_rows, after.max_length, after.n_over) == (5, 513, 2)


def test_plan_has_no_shuffle_and_packs_once(spark):
    df = spark.range(10).select(F.col("id").cast("string").alias("id"), F.lit("some text").alias("text"))
    plan = chunk(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
    assert plan.count("regexp_extract_all") <= 1


def test_default_target():
    assert chunked_path("/data/p.parquet") == "/data/p_chunked.parquet"
