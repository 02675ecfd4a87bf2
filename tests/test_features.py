import datetime as dt
import random

import pytest
from pyspark.sql import functions as F, types as T

from pairloom.operators import quality
from pairloom.operators.encode import HashingEncoder
from pairloom.operators.materialize import latest_per_key, online_lookup, time_window
from pairloom.operators.pit import point_in_time
from pairloom.operators.similarity import build_index
from pairloom.plans.store import FeatureStore
from pairloom.sources.versions import VersionedTable, last_upto
from pairloom.sources.views import Entity, FeatureView, Registry, VectorField, standard_views

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 1)
SPINE = "k string, at timestamp_ntz, tag int"
FACTS = "k string, seen timestamp_ntz, v int, w int"


def joined(spark, spine, facts, **options):
    s, f = spark.createDataFrame(spine, SPINE), spark.createDataFrame(facts, FACTS)
    rows = point_in_time(s, f, "k", "at", "seen", ["v"], DAY, ["w"], **options).collect()
    return {r.tag: r.v for r in rows}, len(rows)


def test_bounds(spark):
    us = dt.timedelta(microseconds=1)
    spine = [("same", T0, 1), ("exact", T0 + DAY, 2), ("late", T0 + DAY + us, 3), ("future", T0 - us, 4),
             ("none", T0, 5), ("tie", T0, 6), (None, T0, 7), ("same", T0, 8)]
    facts = [("same", T0, 10, 0), ("exact", T0, 20, 0), ("late", T0, 30, 0), ("future", T0, 40, 0),
             ("tie", T0, 61, 1), ("tie", T0, 62, 2), ("tie", T0, 60, 0), (None, T0, 70, 0)]
    got, n = joined(spark, spine, facts)
    assert n == 8
    assert got == {1: 10, 2: 20, 3: None, 4: None, 5: None, 6: 62, 7: None, 8: 10}


@pytest.mark.parametrize("hot_rows", [3, 50, 10_000])
def test_hot_keys_against_brute_force(spark, hot_rows):
    rng = random.Random(hot_rows)
    key = lambda: "hot" if rng.random() < 0.6 else f"k{rng.randrange(6)}"
    time = lambda: T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 9))
    spine = [(key(), time(), i) for i in range(200)] + [("hot", T0 + 4 * DAY, 200 + i) for i in range(30)]
    spine += [("hot", None, 230), (None, T0, 231)]
    facts = [(key(), time(), i, i) for i in range(200)] + [("hot", T0 + 3 * DAY, 1000 + i, 1000 + i) for i in range(40)]
    want = {}
    for k, at, tag in spine:
        seen = [(t, w, v) for fk, t, v, w in facts if fk == k and at is not None and at - DAY <= t <= at]
        want[tag] = max(seen)[2] if seen else None
    got, n = joined(spark, spine, facts, hot_rows=hot_rows)
    assert n == 232 and got == want


def test_without_ttl_and_with_a_clash(spark):
    s = spark.createDataFrame([("a", T0 + 400 * DAY, 1)], SPINE)
    f = spark.createDataFrame([("a", T0, 5, 0)], FACTS)
    assert point_in_time(s, f, "k", "at", "seen", ["v"]).first().v == 5
    with pytest.raises(ValueError, match="already"):
        point_in_time(s, f.withColumnRenamed("v", "tag"), "k", "at", "seen", ["tag"])


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", T0, 1, 1), ("a", T0 + DAY, 2, 0), ("a", T0 + DAY, 3, 9), ("b", None, 4, 0),
                                ("c", T0, 5, 0)], FACTS)
    assert {r.k: r.v for r in latest_per_key(df, "k", "seen", ["w"]).collect()} == {"a": 3, "c": 5}
    assert {r.k: r.v for r in latest_per_key(df, "k", None, ["v"]).collect()} == {"a": 3, "b": 4, "c": 5}
    assert latest_per_key(df, "k", "seen").columns == df.columns
    with pytest.raises(ValueError):
        latest_per_key(df, "k", None)


def test_window_is_half_open(spark):
    df = spark.createDataFrame([("a", T0, 1, 1), ("a", T0 + DAY, 2, 0), ("a", T0 + 2 * DAY, 3, 9)], FACTS)
    assert [r.v for r in time_window(df, "seen", T0, T0 + DAY).collect()] == [2]
    assert time_window(df, "seen", None, T0 + DAY).count() == 2


def test_lookup_of_unknown_key(spark):
    table = spark.createDataFrame([("a", 1)], "k string, v int")
    asked = spark.createDataFrame([("a",), ("z",), ("a",)], "k string")
    assert sorted(str(r.v) for r in online_lookup(asked, table, "k", ["v"]).collect()) == ["1", "1", "None"]


# ---------------------------------------------------------------- versions, views, store

def test_versions(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert not table.exists() and last_upto(table.history()) is None
    with pytest.raises(ValueError, match="no version"):
        table.read()
    assert table.write(spark.range(3), "r") == 1
    assert table.write(table.read().where("id > 0"), "r") == 2  # reads what it replaces
    assert (table.read().count(), table.read(1).count()) == (2, 3)
    assert table.write(spark.range(5, 6), "r", kind="delta", batch_id=7) == 3
    assert table.write(spark.range(5, 6), "r", kind="delta", batch_id=7) == 3  # a replay
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 5]
    assert [r.run_id for r in table.history()] == ["r"] * 3


@pytest.mark.parametrize("limit", [0, 100])
def test_deltas_over_a_base(spark, tmp_path, monkeypatch, limit):
    from pairloom.sources import versions
    monkeypatch.setattr(versions, "BROADCAST_ROWS", limit)
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.write(spark.createDataFrame([("a", T0, 1, 0), ("b", T0, 2, 0), ("c", T0 + 9 * DAY, 3, 0)], FACTS), "r")
    table.write(spark.createDataFrame([("a", T0 + DAY, 11, 0), ("c", T0, 33, 0)], FACTS), "r", kind="delta")
    table.write(spark.createDataFrame([("d", T0, 4, 0), ("a", T0, 12, 0)], FACTS), "r", kind="delta")
    latest = table.read_latest("k", "seen", ["w"])
    assert {r.k: r.v for r in latest.collect()} == {"a": 11, "b": 2, "c": 3, "d": 4}
    assert latest.count() == 4
    assert {r.k: r.v for r in table.read_latest("k", "seen", version=1).collect()} == {"a": 1, "b": 2, "c": 3}


def make_view(**kw):
    fields = T.StructType([T.StructField("v", T.IntegerType()), T.StructField("w", T.IntegerType())])
    return FeatureView("facts", Entity("k", ("k",)), fields, DAY, ts_col="seen", tie_break=("w",), **kw)


@pytest.fixture()
def store(spark, tmp_path):
    path = str(tmp_path / "facts.parquet")
    spark.createDataFrame([("a", T0, 1, 0), ("a", T0 + DAY, 2, 0), ("b", T0, 3, 0), ("b", T0 + 3 * DAY, 4, 0)],
                          FACTS).write.parquet(path)
    registry = Registry()
    registry.register(make_view(source=path), spark.read.parquet(path))
    return FeatureStore(spark, str(tmp_path / "store"), registry)


def test_historical_by_name(spark, store):
    spine = spark.createDataFrame([("a", T0 + DAY / 2), ("b", T0 + 2 * DAY)], "k string, event_timestamp timestamp_ntz")
    got = {r.k: r.v for r in store.historical(spine, ["facts:v"]).collect()}
    assert got == {"a": 1, "b": None}
    for wrong in ("facts:nothing", "other:v", "v"):
        with pytest.raises(ValueError):
            store.historical(spine, [wrong])


def test_materialize_twice_changes_nothing(store):
    store.materialize("facts")
    first = sorted(map(tuple, store.online("facts").collect()))
    store.materialize("facts")
    assert sorted(map(tuple, store.online("facts").collect())) == first
    assert {r[0]: r[2] for r in first} == {"a": 2, "b": 4}


def test_incremental(spark, store):
    store.materialize_incremental("facts", T0 + DAY)  # from T0 exclusive
    assert {r.k: r.v for r in store.online("facts").collect()} == {"a": 2}
    store.materialize_incremental("facts", T0 + DAY)
    assert len(store.online_table("facts").history()) == 1
    late = spark.createDataFrame([("a", T0 + 2 * DAY, 9, 0), ("b", T0 + 3 * DAY, 4, 0)], FACTS)
    store.materialize_incremental("facts", T0 + 3 * DAY, late, compact_after=1)
    assert {r.k: r.v for r in store.online("facts").collect()} == {"a": 9, "b": 4}
    assert store.online_table("facts").history()[-1].kind == "base"
    requests = spark.createDataFrame([("a",), ("q",)], "k string")
    assert {r.k: r.v for r in store.online_features(requests, ["facts:v"]).collect()} == {"a": 9, "q": None}


def test_offline_view_is_not_served(spark, tmp_path):
    registry = Registry()
    registry.register(make_view(online=False))
    store = FeatureStore(spark, str(tmp_path), registry)
    for call in (lambda: store.materialize("facts"), lambda: store.online("facts"),
                 lambda: store.materialize_incremental("facts", T0)):
        with pytest.raises(ValueError, match="offline"):
            call()


def test_registration_refuses_another_schema(spark):
    with pytest.raises(ValueError, match="wrong_types"):
        Registry().register(make_view(), spark.createDataFrame([("a", T0, "x", 1)], FACTS.replace("v int", "v string")))
    with pytest.raises(ValueError, match="missing_columns"):
        Registry().register(make_view(), spark.createDataFrame([("a", T0)], "k string, seen timestamp_ntz"))


def test_view_checks(spark):
    registry = standard_views("x", 2)
    df = spark.createDataFrame(
        [("1", "t", [1.0, 2.0], T0), (None, "t", [1.0], None), ("3", None, None, T0)],
        "id string, text string, embeddings array<float>, event_timestamp timestamp_ntz")
    got = {r.check_name: r.failed for r in registry.view("wiki_passages").check(df).collect()}
    assert got == {"missing_columns": 0, "wrong_types": 0, "null_keys": 1, "null_times": 1, "wrong_vector_lengths": 2}
    conformed = registry.view("wiki_passages").conform(df.withColumn("text", F.lit(1)))
    assert conformed.schema["text"].dataType == T.StringType()
    ttl = {n: v.ttl.days for n, v in registry.views.items()}
    assert (ttl["wiki_passages"], ttl["query_embeddings"], ttl["embedding_training_pairs"]) == (1, 7, 30)
    assert registry.view("query_embeddings").vector == VectorField("query_embedding", 2, "COSINE")


def test_readiness(spark, store, tmp_path):
    ready = quality.readiness(spark, store.registry.view("facts")).first()
    assert (ready.path_found, ready.schema_ok, ready.n_rows, ready.ready) == (True, True, 4, True)
    lost = quality.readiness(spark, make_view(source=str(tmp_path / "nowhere"))).first()
    assert (lost.path_found, lost.ready) == (False, False)


def test_search_and_on_demand(spark, tmp_path):
    encoder = HashingEncoder(32)
    registry = standard_views("x", 32)
    registry.register_on_demand("fine_tuned_query_embeddings", "query_embedding", "query_text", encoder)
    store = FeatureStore(spark, str(tmp_path), registry)
    passages = spark.createDataFrame([("1", "red green blue", T0), ("2", "one two three", T0)],
                                     "id string, text string, event_timestamp timestamp_ntz")
    store.materialize("wiki_passages", passages.withColumn("embeddings", encoder(F.col("text"))))
    asked = spark.createDataFrame([("two three one",), ("green",)], "query_text string")
    vectors = store.online_features(asked, ["fine_tuned_query_embeddings:query_embedding"])
    assert all(len(r.query_embedding) == 32 for r in vectors.collect())
    found = store.answer("wiki_passages", asked, "query_text", "query_text", encoder, 1).collect()
    assert {r.query_text: r.id for r in found} == {"two three one": "2", "green": "1"}
    assert {r.query_text: r.distance for r in found}["two three one"] == 1.0
    index = build_index(store.online("wiki_passages"), "id", "embeddings", 2)
    for nprobe in (None, 2):
        again = store.answer("wiki_passages", asked, "query_text", "query_text", encoder, 1, index=index,
                             nprobe=nprobe, features=["wiki_passages:text"])
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, found))
