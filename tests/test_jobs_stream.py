import datetime as dt
import shutil

import pytest
from pyspark.sql import functions as F

from pairloom.__main__ import main
from pairloom.operators.encode import HashingEncoder
from pairloom.operators.materialize import latest_per_key
from pairloom.plans import jobs
from pairloom.operators.train import train_adapter
from pairloom.plans.catalog import EVENTS_SCHEMA, events, passages, vector_pairs
from pairloom.plans.store import FeatureStore
from pairloom.sources.versions import VersionedTable
from pairloom.sources.views import standard_views
from pairloom.streaming.materialize import current_table, feature_stream, stream_latest

RUN = dt.datetime(2024, 2, 1)


def drain(spark, table, folder, state):
    stream = feature_stream(spark, folder, EVENTS_SCHEMA, max_files=1)
    stream_latest(stream, table, "user_id", "ts", ["event_id"], state, compact_after=2).awaitTermination()


def test_stream_equals_batch_with_late_files_restart_and_replay(spark, data, tmp_path):
    e = events(spark, data)
    parts = str(tmp_path / "parts")
    e.withColumn("part", F.pmod("event_id", F.lit(3))).repartition(1, "part").write.partitionBy("part").parquet(parts)
    incoming = tmp_path / "incoming"
    incoming.mkdir()
    table = VersionedTable(spark, str(tmp_path / "table"))
    state = str(tmp_path / "state")
    for part in (2, 0, 1):  # a restart before each file, and rows that come late
        for source in (tmp_path / "parts" / f"part={part}").glob("*.parquet"):
            shutil.copy(source, incoming / f"{part}-{source.name}")
        drain(spark, table, str(incoming), state)
    want = sorted(map(tuple, latest_per_key(e, "user_id", "ts", ["event_id"]).collect()))
    got = current_table(table, "user_id", "ts", ["event_id"]).select(*e.columns)
    assert sorted(map(tuple, got.collect())) == want
    before = len(table.history())
    last = max((r for r in table.history() if r.batch_id is not None), key=lambda r: r.batch_id)
    table.write(latest_per_key(e, "user_id", "ts", ["event_id"]), last.run_id, kind="delta", batch_id=last.batch_id)
    assert len(table.history()) == before
    assert "base" in {r.kind for r in table.history()}


def test_a_second_checkpoint_keeps_all_batches(spark, data, tmp_path):
    e = events(spark, data)
    table = VersionedTable(spark, str(tmp_path / "table"))
    for part in (0, 1):
        e.where(F.col("event_id") % 2 == part).write.parquet(str(tmp_path / f"in{part}"))
        drain(spark, table, str(tmp_path / f"in{part}"), str(tmp_path / f"state{part}"))
    want = sorted(map(tuple, latest_per_key(e, "user_id", "ts", ["event_id"]).collect()))
    assert sorted(map(tuple, current_table(table, "user_id", "ts", ["event_id"]).select(*e.columns).collect())) == want


def test_the_default_rate_moves_the_loss(spark, data):
    pairs = vector_pairs(spark, data)
    _, losses = train_adapter(pairs, 64, 2, jobs.TrainConfig.learning_rate)
    assert losses[1] < losses[0] - 1e-5


@pytest.fixture(scope="module")
def built(spark, data, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("job"))
    passages(spark, data).withColumn("event_timestamp", F.lit("2024-01-01").cast("timestamp_ntz")).write.parquet(
        f"{root}/passages.parquet")
    jobs.chunk_job(spark, f"{root}/passages.parquet")
    sizes = jobs.build_training_data(spark, f"{root}/passages.parquet", root, HashingEncoder(64, normalize=False), RUN)
    return root, sizes


def test_chunk_and_build(spark, built):
    root, sizes = built
    chunked = spark.read.parquet(f"{root}/passages_chunked.parquet")
    assert chunked.count() > spark.read.parquet(f"{root}/passages.parquet").count()
    assert "event_timestamp" in chunked.columns
    assert sizes["training_data_size"] > 174 and sizes["query_embeddings_size"] == 134


def test_load_pairs(spark, built):
    root, sizes = built
    store = FeatureStore(spark, root, standard_views(root, 64))
    direct = jobs.load_pairs(store, "direct")
    assert direct.count() == sizes["training_data_size"]
    pit = jobs.load_pairs(store, "pit")
    same = sorted(pit.columns)
    assert sorted(map(tuple, pit.select(*same).collect())) == sorted(map(tuple, direct.select(*same).collect()))
    assert jobs.load_pairs(store, "pit", max_samples=50).count() == 50
    with pytest.raises(ValueError, match="mode"):
        jobs.load_pairs(store, "guess")


def test_spine_without_id_and_time(spark):
    df = spark.createDataFrame([("q", "d"), ("q2", "d2")], "query_text string, document_text string")
    rows = jobs.complete_spine(df, RUN).collect()
    assert {r.training_sample_id for r in rows} == {"sample_0", "sample_1"}
    assert {r.event_timestamp for r in rows} == {RUN}


def test_train_job(spark, built, tmp_path):
    root, _ = built
    pairs = jobs.load_pairs(FeatureStore(spark, root, standard_views(root, 64)), "direct")
    config = jobs.TrainConfig(epochs=3, learning_rate=1.0, hard_negative_update_freq=2, write_shards=True)
    target = str(tmp_path / "run")
    done = jobs.train_job(spark, pairs, HashingEncoder(64), target, config, RUN)
    # The refresh before the third epoch changes the pairs, so only the first two losses compare.
    assert len(done["losses"]) == 3 and done["losses"][1] < done["losses"][0]
    metrics = spark.read.parquet(f"{target}/metrics")
    tags = {(r.tag, r.step) for r in metrics.collect()}
    for tag in ("Evaluation/positive_similarity", "Dataset/positive_count", "Dataset/Train_Size"):
        assert {(tag, s) for s in (1, 2, 3)} <= tags
    assert ("Final_Evaluation/overall_quality_score", 3) in tags
    run = spark.read.parquet(f"{target}/runs").first()
    assert (run.run_id, run.epochs_completed, run.timestamp) == (done["run_id"], 3, RUN)
    test = spark.read.parquet(f"{target}/test_set")
    versions = VersionedTable(spark, f"{target}/pairs")
    assert versions.read().join(test, "training_sample_id", "left_semi").count() == 0
    assert versions.read().count() == versions.read(1).count() and len(versions.history()) == 2
    assert {r.epoch for r in spark.read.parquet(f"{target}/shards").select("epoch").distinct().collect()} == {0, 1, 2}


def test_reembed_is_versioned(spark, built, tmp_path):
    root, _ = built
    for want in (1, 2):
        assert jobs.reembed_job(spark, f"{root}/passages.parquet", str(tmp_path / "v"), HashingEncoder(16), "r") == want


def test_command_line(spark, built, tmp_path, capsys):
    root, _ = built
    out = str(tmp_path / "c.parquet")
    assert main(["chunk", "-i", f"{root}/passages.parquet", "-o", out, "-m", "100"]) == 0
    assert spark.read.parquet(out).count() > 0 and out in capsys.readouterr().out
    assert main(["materialize", "--data-dir", root, "-o", str(tmp_path / "online"), "--view", "query_embeddings"]) == 0
    run = str(tmp_path / "run")
    assert main(["train", "--data-dir", root, "-o", run, "--mode", "direct", "--max-samples", "100", "--epochs", "1",
                 "--dim", "64", "--run-ts", "2024-02-01 00:00:00"]) == 0
    sizes = {r.tag: r.value for r in spark.read.parquet(f"{run}/metrics").where("tag like 'Dataset/%Size'").collect()}
    held_out = spark.read.parquet(f"{run}/test_set").count()
    assert sizes["Dataset/Total_Size"] == 100 - held_out
    assert sizes["Dataset/Train_Size"] == int(0.8 * (100 - held_out))
    again = str(tmp_path / "again")
    assert main(["reembed", "-i", f"{root}/passages.parquet", "-o", again, "--dim", "64", "--adapter", f"{run}/adapter"]) == 0
    assert VersionedTable(spark, again).read().count() == spark.read.parquet(f"{root}/passages.parquet").count()


def test_searches_on_the_command_line(spark, built, tmp_path, capsys):
    root, _ = built
    store, asked, out = str(tmp_path / "online"), str(tmp_path / "asked.parquet"), str(tmp_path / "out")
    encoder = HashingEncoder(64)
    passages = spark.read.parquet(f"{root}/passages_chunked.parquet").withColumn("embeddings", encoder(F.col("text"))).withColumn(
        "event_timestamp", F.when(F.length("text") % 2 == 0, F.lit("2024-01-01")).otherwise("2024-01-09").cast("timestamp_ntz"))
    views = tmp_path / "views"
    passages.select("id", "text", "embeddings", "event_timestamp").write.parquet(str(views / "passages_chunked.parquet"))
    assert main(["materialize", "--data-dir", str(views), "-o", store, "--view", "wiki_passages", "--dim", "64", "--end", "2024-01-05"]) == 0
    early = FeatureStore(spark, store, standard_views("unused", 64)).online("wiki_passages")
    assert 0 < early.count() < passages.count() and early.where("event_timestamp > '2024-01-05'").isEmpty()
    first = early.where("length(text) > 40").orderBy("id").limit(5)
    first.select(F.col("id").alias("question_id"), F.col("text").alias("question")).write.parquet(asked)
    base = ["--store", store, "-i", asked, "--top-k", "2", "--dim", "64"]
    assert main(["answer", *base, "-o", out + "1"]) == 0
    assert main(["answer", *base, "-o", out + "2", "--index-lists", "4"]) == 0
    plain, listed = ({tuple(r) for r in spark.read.parquet(out + n).select("question_id", "id", "distance", "rank").collect()} for n in "12")
    assert plain == listed and sum(r[3] == 0 and r[2] == 1.0 for r in plain) == 5
    vectors = str(tmp_path / "vectors.parquet")
    spark.read.parquet(asked).select("question_id", encoder(F.col("question")).alias("query_embedding")).write.parquet(vectors)
    assert main(["search", "--store", store, "-i", vectors, "--top-k", "2", "--dim", "64", "-o", out + "3", "--features", "text", "event_timestamp"]) == 0
    by_vector = spark.read.parquet(out + "3")
    assert {tuple(r) for r in by_vector.select("question_id", "id", "distance", "rank").collect()} == plain and "event_timestamp" in by_vector.columns


def test_a_model_named_on_the_command_line(spark, built, tmp_path):
    root, _ = built
    out = str(tmp_path / "again")
    assert main(["reembed", "-i", f"{root}/passages.parquet", "-o", out, "--dim", "3", "--base-model", "test_model:load"]) == 0
    row = VersionedTable(spark, out).read().where("text is not null").first()
    assert [round(x) for x in row.embeddings] == [len(row.text), row.text.count(" "), 1]
    with pytest.raises(ValueError, match="package.module:function"):
        main(["reembed", "-i", f"{root}/passages.parquet", "-o", out, "--base-model", "nothing"])
