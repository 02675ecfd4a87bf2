import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions.vectors import cosine
from pairloom.operators import evaluate, refresh, splits, train
from pairloom.sources import metrics

LABELLED = "training_sample_id string, label string"


def labelled(spark, counts):
    rows = [(f"{label}{i}", label) for label, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, LABELLED).repartition(3)


def test_holdout_and_split(spark):
    df = labelled(spark, {"positive": 100, "negative": 50, "hard_negative": 5})
    whole = splits.holdout_split(df)
    rows = whole.collect()
    assert len(rows) == len({r.training_sample_id for r in rows}) == 155
    test = [r.label for r in rows if r.split == "test"]
    assert (test.count("positive"), test.count("negative"), test.count("hard_negative")) == (20, 20, 5)
    assert {r.split: r.n for r in splits.split_sizes(whole).collect()} == {"test": 45, "train": 88, "eval": 22}
    again = splits.holdout_split(df.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_holdout_keeps_few_rows_per_task(spark):
    plan = splits.per_label_sample(labelled(spark, {"positive": 10}))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_holdout_without_known_labels(spark):
    assert splits.holdout(labelled(spark, {"x": 95})).count() == 9
    assert splits.holdout(labelled(spark, {"x": 900})).count() == 60


def test_split_by_threshold_is_near(spark):
    parts = splits.train_eval_split(labelled(spark, {"positive": 2000}), exact=False)
    assert abs(parts.where("split = 'train'").count() - 1600) < 100


def test_shards_are_complete_and_disjoint(spark, tmp_path):
    df = labelled(spark, {"positive": 103})
    a, b = (splits.shards(df, 4, 8, epoch).collect() for epoch in (0, 1))
    assert len({r.training_sample_id for r in a}) == 103
    sizes = [sum(r.shard == s for r in a) for s in range(4)]
    assert sorted(sizes) == [25, 26, 26, 26]
    per_batch = {}
    for r in a:
        per_batch[(r.shard, r.batch)] = per_batch.get((r.shard, r.batch), 0) + 1
    assert max(per_batch.values()) == 8 and len(per_batch) == 16
    assert {r.training_sample_id: r.shard for r in a} != {r.training_sample_id: r.shard for r in b}
    splits.write_shards(splits.shards(df, 4, 8, 3), str(tmp_path / "s"))
    assert spark.read.parquet(str(tmp_path / "s" / "epoch=3" / "shard=2")).count() in (25, 26)


def test_in_batch_negatives(spark):
    df = spark.range(20).select(*[F.concat(F.lit(p), F.col("id").cast("string")).alias(n) for p, n in
                                  (("p", "pair_id"), ("q", "query_id"), ("d", "document_id"))])
    rows = splits.in_batch_negatives(df, 8).collect()
    assert len(rows) == 8 * 7 + 8 * 7 + 4 * 3
    assert not any(r.query_id[1:] == r.document_id[1:] for r in rows)


# ---------------------------------------------------------------- evaluation

def scored(spark, values):
    rows = [(str(i), label, s) for i, (label, s) in enumerate(values)]
    return spark.createDataFrame(rows, "training_sample_id string, label string, similarity double")


@pytest.mark.parametrize("values, score, name", [
    ([("positive", 0.9)], 0.0, "poor"),
    ([("negative", 0.9)], 0.0, "poor"),
    ([("positive", 0.2), ("negative", 0.5)], 0.1, "poor"),
    ([("positive", -0.2), ("negative", -0.5)], 0.25, "poor"),
    ([("positive", 0.6), ("hard_negative", 0.0)], 0.8, "excellent"),
    ([("positive", 0.6), ("negative", 0.24)], 0.6, "good"),
    ([("positive", 0.5), ("negative", 0.32)], 0.4, "moderate"),
    ([("positive", 1.0), ("negative", 0.0), ("negative", None)], 1.0, "excellent"),
])
def test_quality_score(spark, values, score, name):
    row = evaluate.final_metrics(scored(spark, values)).first()
    assert row.overall_quality_score == pytest.approx(score) and row.grade == name


def test_deviation_is_that_of_the_population_and_first_rows(spark):
    df = scored(spark, [("positive", 0.1), ("positive", 0.5), ("negative", 0.2), ("hard_negative", 0.4)])
    row = evaluate.final_metrics(df).first()
    assert row.positive_similarity_std == pytest.approx(0.2) and row.negative_similarity_mean == pytest.approx(0.3)
    assert evaluate.final_metrics(df, first=1).first().positive_similarity_mean == pytest.approx(0.1)


def test_gaps_need_both_sides(spark):
    row = evaluate.similarity_gaps(scored(spark, [("positive", 0.8), ("negative", 0.3)])).first()
    assert row.pos_neg_gap == pytest.approx(0.5) and row.pos_hard_gap is None
    report = {r.tag: r.value for r in metrics.scalars(
        evaluate.similarity_gaps(scored(spark, [("positive", 0.8), ("negative", 0.3)])), "r", 1, "Evaluation").collect()}
    assert "Evaluation/pos_hard_gap" not in report and report["Evaluation/positive_similarity"] == 0.8


def test_contrastive_loss(spark):
    df = scored(spark, [("positive", 0.7), ("negative", 0.6), ("negative", 0.1), ("negative", None)])
    row = evaluate.contrastive_loss(df).first()
    assert row.n == 3 and row.loss == pytest.approx((0.5 * 0.3 ** 2 + 0.5 * 0.1 ** 2 + 0) / 3)


# ---------------------------------------------------------------- refresh

PAIRS = ("training_sample_id string, query_id string, document_id string, query_text string, document_text string, "
         "label string, similarity_score double, event_timestamp timestamp_ntz, query_vec array<float>, "
         "doc_vec array<float>")
T0 = dt.datetime(2024, 1, 1)


def angle(c):
    return [c, (1 - c * c) ** 0.5]


def refresh_pairs(spark, cosines, n_hard):
    rows = [("p0", "q0", "d0", "query", "own document", "positive", 1.0, T0, [1.0, 0.0], angle(0.5))]
    rows += [(f"n{i}", f"qn{i}", f"dn{i}", "x", f"doc {i}", "negative", 0.0, T0, [1.0, 0.0], angle(c))
             for i, c in enumerate(cosines)]
    rows += [(f"h{i}", f"qh{i}", f"dh{i}", "x", "far", "hard_negative", 0.5, T0 + dt.timedelta(days=n_hard - i),
              [1.0, 0.0], angle(0.0)) for i in range(n_hard)]
    return spark.createDataFrame(rows, PAIRS)


def test_band_is_open_and_own_document_is_left_out(spark):
    df = refresh_pairs(spark, [0.4, 0.41, 0.79, 0.8], 3)
    found = refresh.refresh_candidates(df, 1, 1).collect()
    assert sorted(r.similarity_score for r in found) == [0.41, 0.79]
    with_own = refresh.refresh_candidates(df, 1, 1, exclude_known=False).collect()
    assert sorted(r.similarity_score for r in with_own) == [0.41, 0.5, 0.79]


def test_size_stays_and_oldest_go(spark):
    df = refresh_pairs(spark, [0.5, 0.6], 4)
    out = refresh.refresh_hard_negatives(df, T0, 1, 1)
    ids = {r.training_sample_id for r in out.collect()}
    assert len(ids) == df.count() and {"h3", "h2"}.isdisjoint(ids) and {"h0", "h1"} <= ids
    new = out.where("training_sample_id like 'dynamic%'").collect()
    assert {r.query_id for r in new} == {"dynamic_q0"} and all(r.label == "hard_negative" for r in new)
    assert not any(r.training_sample_id.startswith("dynamic_hard_2") for r in new)


def test_fewer_old_rows_than_new(spark):
    df = refresh_pairs(spark, [0.5, 0.6, 0.7], 1)
    assert refresh.refresh_hard_negatives(df, T0, 1, 1).count() == df.count()
    assert refresh.refresh_hard_negatives(df, T0, 1, 1, allow_growth=True).count() == df.count() + 2
    assert refresh.refresh_hard_negatives(df, T0, 1, 1, allow_growth=True, new_rows=2).count() == df.count() + 1


def test_schedule():
    assert [e for e in range(10) if refresh.is_refresh_epoch(e, 5)] == [5]


# ---------------------------------------------------------------- adapter

def vec_pairs(spark, n=60, dim=5):
    rng = np.random.default_rng(0)
    rows = []
    for i in range(n):
        q, noise = rng.normal(size=dim), rng.normal(size=dim)
        positive = i % 2 == 0
        d = q + 0.8 * noise if positive else noise
        rows.append((str(i), "positive" if positive else "negative", [float(x) for x in q], [float(x) for x in d]))
    rows.append(("zero", "negative", [0.0] * dim, [1.0] * dim))
    return spark.createDataFrame(rows, "training_sample_id string, label string, query_vec array<float>, doc_vec array<float>")


def test_gradient_matches_differences_and_loss_matches_sql(spark):
    df = vec_pairs(spark).repartition(4)
    rng = np.random.default_rng(1)
    w = np.eye(5) + 0.1 * rng.normal(size=(5, 5))
    grad, loss = train.gradient(df, w)
    for i, j in ((0, 0), (2, 3), (4, 1)):
        step = np.zeros((5, 5))
        step[i, j] = 1e-5
        up, down = train.gradient(df, w + step)[1], train.gradient(df, w - step)[1]
        assert grad[i, j] == pytest.approx((up - down) / 2e-5, abs=1e-6)
    mapped = df.withColumn("q", train.apply_adapter(w, F.col("query_vec"))).withColumn(
        "d", train.apply_adapter(w, F.col("doc_vec"))).withColumn("similarity", cosine("q", "d"))
    assert evaluate.contrastive_loss(mapped).first().loss == pytest.approx(loss, abs=1e-6)


def test_loss_falls_and_adapter_is_stored(spark):
    weights, losses = train.train_adapter(vec_pairs(spark), 5, 4, 1.0, warmup=2)
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]
    assert np.allclose(train.load_adapter(train.adapter_table(spark, weights)), weights)
    assert [train.learning_rate(s, 1.0, 2) for s in range(3)] == [0.5, 1.0, 1.0]


def test_adapter_keeps_null_vectors(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,), ([0.0, 1.0],)], "v array<float>").coalesce(1)
    out = [r[0] for r in df.select(train.apply_adapter(np.array([[2.0, 0.0], [0.0, 1.0]]), F.col("v"))).collect()]
    assert out == [[2.0, 2.0], None, [0.0, 1.0]]
