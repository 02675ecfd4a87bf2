import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators.splits import shards
from pairloom.operators.train import _partial, gradient, learning_rate, sharded_epoch, train_adapter, train_sharded
from pairloom.plans.catalog import vector_pairs
from pairloom.session import stage

DIM = 64


@pytest.fixture(scope="module")
def pairs(spark, data):
    return stage(vector_pairs(spark, data).select("training_sample_id", "label", "query_vec", "doc_vec"), "pairs")


def plain(rows, epochs, rate, world, batch, warmup, seed=42, margin=0.5):
    """The same steps, one after the other."""
    weights, losses, first = np.eye(DIM), [], 0
    for epoch in range(epochs):
        order = sorted(rows, key=lambda r: hashlib.md5(f"{seed}:{epoch}:{r[0]}".encode()).hexdigest())
        ends, loss, n, steps = [], 0.0, 0, 0
        for shard in range(world):
            mine, own = weights.copy(), order[shard::world]
            if not own:
                continue
            for step, at in enumerate(range(0, len(own), batch)):
                part = own[at:at + batch]
                y = np.array([1.0 if r[1] == "positive" else 0.0 for r in part])
                g, l, m = _partial(np.array([r[2] for r in part], float), np.array([r[3] for r in part], float), y, mine, margin)
                mine = mine - learning_rate(first + step, rate, warmup) * g / m
                loss, n, steps = loss + l, n + m, max(steps, step + 1)
            ends.append(mine)
        weights, first = np.mean(ends, axis=0), first + steps
        losses.append(loss / n)
    return weights, losses


@pytest.mark.parametrize("world,batch,warmup", [(1, 8, 0), (3, 16, 20), (4, 1000, 0)])
def test_equals_the_steps_done_one_by_one(spark, pairs, world, batch, warmup):
    rows = [tuple(r) for r in pairs.select("training_sample_id", "label", "query_vec", "doc_vec").collect()]
    weights, reports = train_sharded(pairs.repartition(7), DIM, 2, 1.0, world, batch, warmup)
    want, losses = plain(rows, 2, 1.0, world, batch, warmup)
    assert np.allclose(weights, want, atol=1e-10) and np.allclose([r.loss for r in reports], losses)
    assert reports[0].rows == len(rows) and reports[0].steps == -(-(-(-len(rows) // world)) // batch)


def test_batch_and_world_size_change_the_result(spark, pairs):
    results = [train_sharded(pairs, DIM, 1, 1.0, w, b)[0] for w, b in ((1, 8), (1, 32), (4, 8))]
    assert all(np.abs(a - b).max() > 1e-4 for i, a in enumerate(results) for b in results[:i])


def test_one_shard_and_one_batch_is_a_full_step(spark, pairs):
    weights, reports = train_sharded(pairs, DIM, 2, 2.0, 1, 10**6)
    want, losses = train_adapter(pairs, DIM, 2, 2.0)
    assert np.allclose(weights, want) and np.allclose([r.loss for r in reports], losses)


def test_missing_and_zero_vectors_take_no_part(spark, pairs):
    few = pairs.limit(20)
    more = few.unionByName(few.limit(3).select(F.concat(F.lit("x"), "training_sample_id").alias("training_sample_id"), "label",
                                               F.lit(None).cast("array<float>").alias("query_vec"), "doc_vec")).unionByName(
        few.limit(2).select(F.concat(F.lit("z"), "training_sample_id").alias("training_sample_id"), "label",
                            F.array_repeat(F.lit(0.0).cast("float"), DIM).alias("query_vec"), "doc_vec"))
    more = stage(more, "more")
    _, report = sharded_epoch(more, np.eye(DIM), 0, 1.0, 4, 8)
    assert report.rows == 20
    with pytest.raises(ValueError, match="no pairs"):
        sharded_epoch(more.limit(0), np.eye(DIM), 0, 1.0, 4, 8)


def test_shards_without_rows(spark, pairs):
    weights, report = sharded_epoch(stage(pairs.limit(3), "three"), np.eye(DIM), 0, 1.0, 8, 2)
    assert report.rows == 3 and report.steps == 1 and np.isfinite(weights).all()


def test_loss_falls(spark, pairs):
    _, reports = train_sharded(pairs, DIM, 3, 1.0, 4, 8)
    assert reports[2].loss < reports[0].loss - 1e-3


def test_vectors_move_once_to_their_shard(spark, pairs):
    dealt = shards(pairs.select("training_sample_id"), 4, 8)
    assert {r.shard for r in dealt.select("shard").distinct().collect()} == {0, 1, 2, 3}
    assert gradient(pairs, np.eye(DIM))[1] > 0
