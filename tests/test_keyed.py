import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from pairloom.operators.materialize import latest_per_key
from pairloom.operators.pit import AsOfSource, point_in_time, point_in_time_many
from pairloom.sources.keyed import BUCKET, KeyedTable

T0 = dt.datetime(2024, 1, 1)
DAY = dt.timedelta(days=1)
SCHEMA = "k long, n string, at timestamp_ntz, v int"


def rows(seed, n, keys):
    draw = random.Random(seed)
    return [(draw.randrange(keys), "x", T0 + dt.timedelta(minutes=draw.randrange(10_000)), i + 10_000 * seed) for i in range(n)]


def files(path):
    return {os.path.join(base, f) for base, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), ("k",), "at", ("v",), 8)


def latest(spark, data):
    return latest_per_key(spark.createDataFrame(data, SCHEMA), "k", "at", ["v"])


def contents(df):
    return sorted(map(tuple, df.select("k", "n", "at", "v").collect()))


def test_merges_equal_one_grouping_of_all_rows(spark, table):
    seen = []
    for seed in range(4):
        more = rows(seed, 60, 40)
        seen += more
        assert table.merge(latest(spark, more), f"run{seed}") == seed + 1
        assert contents(table.read()) == contents(latest(spark, seen))
    assert contents(table.read(version=2)) == contents(latest(spark, seen[:120]))


def test_untouched_buckets_are_neither_read_nor_written(spark, table):
    table.write(latest(spark, rows(0, 400, 200)), "base")
    before = files(table.path)
    newer = latest(spark, [(7, "y", T0 + 100 * DAY, 1)])
    bucket = newer.select(table._bucket()).first()[BUCKET]
    met = table.read([bucket])
    assert {f.split(f"{BUCKET}=")[1].split("/")[0] for f in met.inputFiles()} >= {str(bucket)}
    scan = met._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in scan and BUCKET in scan
    table.merge(newer, "one key")
    added = files(table.path) - before
    assert added and all(f"{BUCKET}={bucket}/" in f for f in added)
    assert {b for b, r in table.placement().items() if r["version"] == 2} == {bucket}
    assert table.read().where("k = 7").first().n == "y"


def test_point_reads_open_their_buckets_only(spark, table, tmp_path):
    table.write(latest(spark, rows(0, 400, 200)), "base")
    asked = spark.createDataFrame([(3,), (None,), (3,)], "k long")
    bucket = asked.where("k = 3").select(table._bucket()).first()[BUCKET]
    for f in files(table.path):
        # Any other bucket's file is spoiled, so a read that opened it would fail.
        if f"{BUCKET}={bucket}/" not in f:
            with open(f, "wb") as spoiled:
                spoiled.write(b"spoiled")
    assert table.read_for(asked).where("k = 3").count() == 1


def test_late_and_empty_batches(spark, table):
    table.write(latest(spark, [(1, "a", T0 + DAY, 5)]), "base", "2024-01-02")
    table.merge(latest(spark, [(1, "late", T0, 9)]), "late")
    assert table.read().first().n == "a"
    assert table.merge(latest(spark, []), "nothing") == 2
    assert table.merge(latest(spark, []), "a window without rows", "2024-01-05") == 3
    assert table.history()[-1]["upto"] == "2024-01-05" and table.read().count() == 1
    with pytest.raises(ValueError, match="buckets"):
        KeyedTable(spark, table.path, ("k",), "at", ("v",), 4).read()


def test_first_merge_and_empty_table(spark, table):
    with pytest.raises(ValueError, match="no version"):
        table.read()
    table.merge(latest(spark, []), "first")
    assert table.read().count() == 0 and table.read_for(spark.createDataFrame([(1,)], "k long")).count() == 0


# ---------------------------------------------------------------- several sources in one pass

SPINE, FACTS = "k string, at timestamp_ntz, tag int", "k string, seen timestamp_ntz, v int, w int"


def made(spark, seed, hot=0.6):
    draw = random.Random(seed)
    key = lambda: None if draw.random() < 0.03 else "hot" if draw.random() < hot else f"k{draw.randrange(5)}"
    time = lambda: None if draw.random() < 0.03 else T0 + dt.timedelta(minutes=draw.randrange(60 * 24 * 12))
    spine = spark.createDataFrame([(key(), time(), i) for i in range(200)], SPINE)
    facts = [spark.createDataFrame([(key(), time(), i, i) for i in range(150)], FACTS).withColumnRenamed("v", f"v{n}") for n in range(3)]
    return spine, facts


@pytest.mark.parametrize("bucket", [None, dt.timedelta(hours=5), DAY, 30 * DAY])
def test_one_pass_equals_one_join_after_the_other(spark, bucket):
    spine, facts = made(spark, 3)
    ttls = [DAY, 3 * DAY, None]
    want = spine
    for n, (f, ttl) in enumerate(zip(facts, ttls)):
        want = point_in_time(want, f, "k", "at", "seen", [f"v{n}"], ttl, ["w"])
    sources = [AsOfSource(f, "seen", (f"v{n}",), ttl, ("w",)) for n, (f, ttl) in enumerate(zip(facts, ttls))]
    got = point_in_time_many(spine, sources, "k", "at", bucket)
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_zoned_times_and_ties(spark):
    spine = spark.createDataFrame([("a", T0 + DAY, 1)], "k string, at timestamp, tag int")
    facts = spark.createDataFrame([("a", T0, 1, 1), ("a", T0, 2, 2)], FACTS)
    source = AsOfSource(facts, "seen", ("v",), DAY, ("w",))
    assert point_in_time_many(spine, [source], "k", "at", dt.timedelta(hours=1)).first().v == 2
    with pytest.raises(ValueError, match="already"):
        point_in_time_many(spine, [source, source], "k", "at")


def test_rows_are_exchanged_once_and_nothing_is_staged_first(spark, monkeypatch):
    import pairloom.operators.pit as pit
    monkeypatch.setattr(pit, "stage", lambda *a: pytest.fail("staged"))
    spine, facts = made(spark, 4)
    sources = [AsOfSource(f, "seen", (f"v{n}",), DAY, ("w",)) for n, f in enumerate(facts)]
    out = point_in_time_many(spine, sources, "k", "at")
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange hashpartitioning") == 1
    cut = point_in_time_many(spine, sources, "k", "at", DAY)
    plan = cut._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    # One exchange of the rows; the others hold one row per key and bucket.
    assert 2 <= plan.count("Exchange hashpartitioning") <= 5
