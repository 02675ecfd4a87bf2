import json

import pytest
from pyspark.sql import functions as F

from pairloom.functions.hashing import draw, shuffle_key
from pairloom.operators import pairs
from pairloom.operators.encode import HashingEncoder
from pairloom.operators.positions import dense_position, hash_position

RUN = "2024-02-01 00:00:00"
SCHEMA = "id string, title string, text string"


def test_draw_is_the_md5_prefix(spark):
    import hashlib
    want = int(hashlib.md5(b"42:7:q").hexdigest()[:8], 16)
    assert spark.range(1).select(draw(42, F.lit(7), "q")).first()[0] == want


@pytest.mark.parametrize("parts", [1, 7])
def test_dense_position(spark, parts):
    df = spark.range(1000).select(F.col("id").cast("string").alias("k")).repartition(parts)
    got = {r.k: r.pos for r in dense_position(df, "k", partitions=5).collect()}
    assert got == {k: i for i, k in enumerate(sorted(got))}
    assert len(got) == 1000


def test_dense_position_of_nothing(spark):
    assert dense_position(spark.range(0), "id").count() == 0


def test_hash_position_within_groups(spark):
    df = spark.range(500).select("id", (F.col("id") % 3).alias("g"))
    key = shuffle_key(1, F.col("id"))
    rows = hash_position(df, key, within=["g"], digits=2).withColumn("h", key).collect()
    for g in range(3):
        mine = sorted((r.h, r.pos) for r in rows if r.g == g)
        assert [p for _, p in mine] == list(range(len(mine)))
    whole = hash_position(df, key).withColumn("h", key).collect()
    assert [p for _, p in sorted((r.h, r.pos) for r in whole)] == list(range(500))


@pytest.fixture()
def numbered(spark):
    rows = [("a", "alpha beta", "alpha beta gamma"), ("b", None, "text only"), ("c", "title only", None),
            ("d", "alpha beta", "alpha beta delta"), ("e", "other words", "quite different")]
    return pairs.number_passages(spark.createDataFrame(rows, SCHEMA))


def test_positive_pairs(numbered):
    rows = {r.training_sample_id: r for r in pairs.positive_pairs(numbered, RUN).collect()}
    assert sorted(rows) == ["pos_a_0", "pos_d_3", "pos_e_4"]
    row = rows["pos_d_3"]
    assert (row.query_id, row.document_id, row.label, row.similarity_score) == ("query_d", "d", "positive", 1.0)
    assert json.loads(row.metadata) == {"pair_type": "title_text", "source_row": 3}


def test_ids_must_be_unique(spark):
    with pytest.raises(ValueError, match="unique"):
        pairs.number_passages(spark.createDataFrame([("1", "a", "b"), ("1", "c", "d")], SCHEMA))


def test_random_negatives_never_pair_a_row_with_itself(numbered):
    rows = pairs.random_negative_pairs(numbered, RUN, 200, seed=3).collect()
    assert 0 < len(rows) < 200
    for r in rows:
        meta = json.loads(r.metadata)
        assert meta["query_row"] != meta["doc_row"] and r.query_text is not None and r.document_text is not None
        assert r.query_id != f"query_{r.document_id}"
    assert {json.loads(r.metadata)["doc_row"] for r in rows} == {0, 1, 3, 4}


def test_two_rows_are_enough_and_one_is_not(spark):
    two = pairs.number_passages(spark.createDataFrame([("1", "t1", "x1"), ("2", "t2", "x2")], SCHEMA))
    assert pairs.random_negative_pairs(two, RUN, 20).count() == 20
    assert pairs.random_negative_pairs(two, RUN).count() == 1  # by default half as many draws as rows
    with pytest.raises(ValueError, match="two"):
        pairs.random_negative_pairs(two.where("id = '1'"), RUN, 1)


def test_ratio_is_cut_off():
    assert pairs.negatives_for(5, 0.5) == 2 and pairs.negatives_for(619, 0.3) == 185


ENCODER = HashingEncoder(64, normalize=False)


def test_hard_negatives(numbered):
    rows = pairs.hard_negative_pairs(numbered, ENCODER, RUN, k=2).collect()
    assert rows
    for r in rows:
        meta = json.loads(r.metadata)
        assert r.similarity_score >= 0.3 and meta["base_similarity"] == r.similarity_score
        assert r.query_id != f"query_{r.document_id}" and meta["query_row"] != meta["doc_row"]
    # a and d have the same title: each finds the other's text, with rows counted over complete passages
    found = {r.training_sample_id: json.loads(r.metadata) for r in rows}
    assert (found["hard_neg_a_d_0"]["query_row"], found["hard_neg_a_d_0"]["doc_row"]) == (0, 1)


def test_stricter_exclusions(spark, numbered):
    by_title = pairs.hard_negative_matches(numbered, ENCODER, exclude="title").collect()
    assert not any({r.query_id, r.doc_id} == {"a", "d"} for r in by_title)
    chunks = pairs.number_passages(spark.createDataFrame(
        [("7_1", "one two", "one two x"), ("7_2", "one two", "one two y"), ("8", "one two", "one two z")], SCHEMA))
    by_parent = {(r.query_id, r.doc_id) for r in pairs.hard_negative_matches(chunks, ENCODER, exclude="parent").collect()}
    assert by_parent == {("7_1", "8"), ("7_2", "8"), ("8", "7_1"), ("8", "7_2")}
    with pytest.raises(ValueError, match="exclude"):
        pairs.hard_negative_matches(numbered, ENCODER, exclude="nothing")


def test_mining_through_lists_finds_rows_of_the_exact_result(spark, data):
    from pairloom.plans.catalog import passages
    numbered = pairs.number_passages(passages(spark, data))
    exact = {(r.query_id, r.doc_id) for r in pairs.hard_negative_matches(numbered, ENCODER).collect()}
    for nprobe in (5, None):
        found = pairs.hard_negative_matches(numbered, ENCODER, index_lists=5, nprobe=nprobe)
        assert {(r.query_id, r.doc_id) for r in found.collect()} == exact


def test_training_set(spark, numbered):
    passages = numbered.select("id", "title", "text")
    whole = pairs.complete_training_set(passages, ENCODER, RUN, seed=1)
    rows = whole.collect()
    assert sorted(int(r.training_sample_id[7:]) for r in rows) == list(range(len(rows)))
    assert len({r.pair_key for r in rows}) == len(rows)
    assert {r.label for r in rows} <= set(pairs.LABELS)
    again = pairs.complete_training_set(passages.repartition(5), ENCODER, RUN, seed=1).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    other = pairs.complete_training_set(passages, ENCODER, RUN, seed=2).collect()
    assert {r.training_sample_id: r.pair_key for r in rows} != {r.training_sample_id: r.pair_key for r in other}
    counts = {r.label: r.n for r in pairs.label_composition(whole).collect()}
    assert counts["total"] == len(rows) and counts["positive"] == 3


def test_query_table_keeps_the_first_id(spark):
    df = spark.createDataFrame([("9", "t", "a"), ("10", "t", "b"), ("11", None, "c"), ("2", "u", "d")], SCHEMA)
    rows = {r.query_text: r for r in pairs.query_table(df, HashingEncoder(8), RUN).collect()}
    assert {t: r.query_id for t, r in rows.items()} == {"t": "query_10", "u": "query_2"}
    assert rows["t"].query_type == "title" and len(rows["t"].query_embedding) == 8
