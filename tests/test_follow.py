import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_blocks import SCHEMA, clustered
from test_similarity import QUERY_KEYS, brute, result

from pairloom.operators import similarity as sim
from pairloom.plans.store import FeatureStore
from pairloom.session import stage
from pairloom.sources.views import standard_views


def test_new_and_changed_docs_are_found_without_training(spark, monkeypatch):
    old, new = clustered(1, 120, dim=8), clustered(2, 60, dim=8, centres=7)
    # Twenty ids change their vector, forty are new, and one loses its vector.
    new = [(f"v{i + 100}", v, g) for i, (_, v, g) in enumerate(new)]
    index = sim.build_index(stage(spark.createDataFrame(old, SCHEMA), "old"), "id", "v", 6)
    before = index.centroids.copy()
    monkeypatch.setattr(sim, "train_centroids", lambda *a, **k: pytest.fail("trained again"))
    index = sim.extend_index(index, stage(spark.createDataFrame([*new, ("v3", None, None)], SCHEMA), "new"), "id", "v")
    assert np.array_equal(index.centroids, before)
    now = {i: (i, v, g) for i, v, g in old + new if i != "v3"}
    rows = list(now.values())
    table = stage(spark.createDataFrame(rows, SCHEMA), "now")
    assert sum(index.sizes.values()) == len(rows)
    assert result(sim.pruned_topk(table, index, 3, **QUERY_KEYS)) == brute(rows, 3)
    assert result(sim.block_topk(table, index, 3, **QUERY_KEYS)[0]) == brute(rows, 3)


def test_long_lists_are_split(spark):
    rows = clustered(3, 200, dim=8, centres=3) + [(f"same{i}", [1.0] * 8, None) for i in range(60)]
    table = stage(spark.createDataFrame(rows, SCHEMA), "split")
    index = sim.build_index(table.where("id like 'v1%'"), "id", "v", 2)
    index = sim.extend_index(index, table.where("id not like 'v1%'"), "id", "v", max_list=45)
    assert len(index.centroids) > 4 and sum(index.sizes.values()) == len(rows)
    # Sixty equal vectors cannot be split.
    assert all(n <= 45 or n >= 60 for n in index.sizes.values())
    assert result(sim.pruned_topk(table, index, 3, **QUERY_KEYS)) == brute(rows, 3)
    with pytest.raises(ValueError, match="copies"):
        sim.extend_index(sim.build_index(table, "id", "v", 2, keep_copies=3), table, "id", "v")


def test_an_index_follows_incremental_runs(spark, tmp_path):
    store = FeatureStore(spark, str(tmp_path), standard_views("unused", 8))
    rows = clustered(5, 90, dim=8)
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, f"text {i}", v, start + dt.timedelta(hours=k)) for k, (i, v, _) in enumerate(rows)], "id string, text string, embeddings array<float>, event_timestamp timestamp_ntz")
    df = stage(df, "rows")
    store.materialize_incremental("wiki_passages", start + dt.timedelta(hours=20), df)
    index, version = store.vector_index("wiki_passages", 3)
    for hour in (40, 89):
        store.materialize_incremental("wiki_passages", start + dt.timedelta(hours=hour), df, compact_after=2)
    index, version = store.follow("wiki_passages", index, version)
    assert store.follow("wiki_passages", index, version) == (index, version)
    asked = store.online("wiki_passages").select(F.col("id").alias("q"), F.col("embeddings").alias("qv"))
    plain = store.search("wiki_passages", asked, "q", "qv", 4)
    listed = store.search("wiki_passages", asked, "q", "qv", 4, index=index)
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, plain.collect())) and plain.count() == 4 * asked.count()
