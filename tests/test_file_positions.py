import json

import duckdb
import pytest
from pyspark.sql import functions as F

from pairloom.operators import pairs, reduction
from pairloom.operators.encode import HashingEncoder
from pairloom.plans import jobs
from pairloom.sources.tables import with_file_position

RUN = "2024-02-01 00:00:00"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Five files, several row groups in each, ids in no order."""
    path = str(tmp_path_factory.mktemp("files") / "passages.parquet")
    rows = spark.range(2_000).select(
        F.md5(F.col("id").cast("string").cast("binary")).alias("id"),
        F.when(F.col("id") % 9 != 0, F.concat(F.lit("title "), (F.col("id") % 50).cast("string"))).alias("title"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("some text "), (F.col("id") % 50).cast("string"), F.lit(" more"))).alias("text"))
    rows.repartition(5).write.option("parquet.block.size", "4096").parquet(path)
    return path


def by_duckdb(path):
    """Position by file name and row number in the file."""
    con = duckdb.connect()
    return dict(con.execute(f"""SELECT id, row_number() OVER (ORDER BY filename, file_row_number) - 1
                                FROM read_parquet('{path}/*.parquet', filename = true, file_row_number = true)""").fetchall())


def test_positions_equal_those_of_another_reader(spark, files):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = {r.id: r.source_row for r in with_file_position(spark.read.parquet(files)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == by_duckdb(files)
    some = with_file_position(spark.read.parquet(files)).where("source_row % 3 = 1").select("id", "source_row").collect()
    assert len(some) == 667 and all(got[r.id] == r.source_row for r in some)


def test_positive_pairs_are_one_narrow_job(spark, files):
    numbered = pairs.number_passages(with_file_position(spark.read.parquet(files)))
    out = pairs.positive_pairs(numbered, RUN)
    plan = plan_of(out)
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    # The prefix sums of the files are broadcast; nothing else is exchanged and no passage is sorted.
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    assert all("BroadcastExchange" in e or "SinglePartition" in e for e in exchanges)
    want = by_duckdb(files)
    rows = out.collect()
    assert len(rows) > 1_400 and all(json.loads(r.metadata)["source_row"] == want[r.document_id] for r in rows)


def test_build_in_file_order(spark, files, tmp_path):
    jobs.build_training_data(spark, files, str(tmp_path), HashingEncoder(32, normalize=False), RUN, row_order="file")
    out = spark.read.parquet(f"{tmp_path}/embedding_training_data.parquet")
    want = by_duckdb(files)
    first = out.where("label = 'positive'").collect()
    assert first and all(r.pair_key == f"pos_{r.document_id}_{want[r.document_id]}" for r in first)
    with pytest.raises(ValueError, match="row_order"):
        jobs.build_training_data(spark, files, str(tmp_path), None, RUN, row_order="title")


@pytest.mark.parametrize("bits", [15, 18, 22])
def test_filter_keeps_every_known_key(spark, bits):
    keys = spark.range(0, 50_000, 7).select(F.col("id").cast("string").alias("k"))
    df = spark.range(50_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    kept = {int(r.k) for r in reduction.maybe_known(df, "k", reduction.key_filter(keys, "k", bits), bits).collect()}
    assert set(range(0, 50_000, 7)) <= kept
    if bits == 22:
        assert len(kept) < 50_000 / 7 * 1.1


def test_reduction_at_both_sizes(spark):
    keys = spark.createDataFrame([("5",), ("7",), ("5",), (None,)], "k string").cache()
    df = spark.range(100).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(None, 3)], "k string, v long"))
    assert sorted(tuple(r) for r in reduction.only_known(df, "k", keys).collect()) == [("5", 10), ("7", 14)]
    rough = reduction.only_known(df, "k", keys, exact_rows=0)
    assert rough.columns == ["k", "v"] and {("5", 10), ("7", 14)} <= {tuple(r) for r in rough.collect()}
    assert rough.count() < 20


def test_unmined_texts_are_not_exchanged(spark, files):
    numbered = pairs.number_passages(with_file_position(spark.read.parquet(files)))
    out = pairs.hard_negative_pairs(numbered, HashingEncoder(32, normalize=False), RUN)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")
    # Below each exchange of a title or text stands the semi-join with the mined ids.
    lines = plan.splitlines()
    texts = [i for i, line in enumerate(lines) if "Exchange" in line and "hashpartitioning(_did" in line or "Exchange" in line and "hashpartitioning(_qid" in line]
    assert plan.count("LeftSemi") >= 2 and texts
