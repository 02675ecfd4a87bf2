import hashlib
import random

import pytest
from pyspark.sql import functions as F

from pairloom.functions.hashing import shuffle_key
from pairloom.operators import selection, splits
from pairloom.session import stage


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def ids(spark):
    return stage(spark.range(10_000).select(F.concat(F.lit("s"), F.col("id").cast("string")).alias("training_sample_id"), F.array(F.lit(1.0)).alias("vec")).repartition(5), "ids")


def in_order(n, seed):
    return sorted((hashlib.md5(f"{seed}:s{i}".encode()).hexdigest(), f"s{i}") for i in range(n))


@pytest.mark.parametrize("leaf", [1, 64, 4096])
@pytest.mark.parametrize("n", [1, 777, 9_999, 10_000, 20_000])
def test_nth_hash(spark, ids, monkeypatch, leaf, n):
    monkeypatch.setattr(selection, "LEAF_ROWS", leaf)
    key, reached = selection.nth_hash(ids, n, shuffle_key(7, F.col("training_sample_id")), "training_sample_id")
    want = in_order(10_000, 7)[min(n, 10_000) - 1]
    assert key == want and reached == min(n, 10_000)


def test_nth_hash_of_nothing(spark, ids):
    key = shuffle_key(7, F.col("training_sample_id"))
    assert selection.nth_hash(ids, 0, key, "training_sample_id") == (None, 0)
    assert selection.nth_hash(ids.limit(0), 5, key, "training_sample_id") == (None, 0)


def test_equal_hashes_are_settled_by_ties(spark, monkeypatch):
    monkeypatch.setattr(selection, "LEAF_ROWS", 10)
    df = spark.range(500).select((F.col("id") % 100).alias("t"))
    key, reached = selection.nth_hash(df, 333, F.md5(F.lit(b"x")), "t")
    assert key[1] == 66 and reached == 335


def test_split_is_exact_and_moves_no_vectors(spark, ids):
    split = splits.train_eval_split(ids, seed=3)
    assert "Exchange" not in plan_of(split.select("training_sample_id", "vec", "split"))
    train = {r[0] for r in split.where("split = 'train'").select("training_sample_id").collect()}
    assert train == {i for _, i in sorted((hashlib.md5(f"3:split:s{i}".encode()).hexdigest(), f"s{i}") for i in range(10_000))[:8_000]}


def test_split_with_repeated_ids_keeps_its_size(spark):
    df = spark.range(50).select(F.lit("one").alias("training_sample_id"))
    sizes = {r.split: r.n for r in splits.split_sizes(splits.train_eval_split(df)).collect()}
    assert sizes == {"train": 40, "eval": 10}
    assert splits.train_eval_split(df.limit(0)).count() == 0 and splits.train_eval_split(df.limit(1)).first().split == "eval"


@pytest.mark.parametrize("kept", [0, 10**6])
def test_first_rows_at_both_sizes(spark, kept):
    rows = [(random.Random(i).choice([None, "a", "b"]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i int").repartition(4)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1]))
    for n in (1, 57, 299, 300, 400):
        assert sorted(map(tuple, selection.first_rows(df, n, "k", "i", kept=kept).collect()), key=str) == sorted(want[:n], key=str)


def test_many_first_rows_meet_in_no_single_task(spark, ids):
    assert "TakeOrdered" not in (plan := plan_of(selection.first_rows(ids, 5_000, "training_sample_id", kept=100))) and "Limit" not in plan
