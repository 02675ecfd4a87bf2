import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.operators.encode import HashingEncoder, ModelEncoder, hashed_counts, with_vector
from pairloom.operators.pairs import reembed

TEXTS = ["Hello hello world", None, "", "___", "Ünïcode ÉCOLE straße İstanbul ΣΑΣ", "x2 3y ²½Ⅷ 東京_タワー", "a-b.c,d'e",
         "é combining", "tab\tnew\nline", "word " * 5000]


def test_counts_equal_the_sql_form(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "id int, text string")
    words = df.select("id", F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w")).where("w <> ''")
    digest = F.md5(F.col("w").cast("binary"))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 384
    sign = F.when(F.conv(F.substring(digest, 9, 1), 16, 10).cast("int") % 2 == 0, 1).otherwise(-1)
    sql = words.groupBy("id", bucket.alias("bucket")).agg(F.sum(sign).alias("weight")).where("weight <> 0")
    got = {tuple(r) for r in hashed_counts(df, "id", "text").collect()}
    assert got == {tuple(r) for r in sql.collect()}
    assert max(w for _, _, w in got) == 5000 or min(w for _, _, w in got) == -5000


def test_unit_length_and_zero(spark):
    df = spark.createDataFrame([(t,) for t in TEXTS], "text string").repartition(3)
    for row in df.select("text", HashingEncoder(dim=32)(F.col("text")).alias("v")).collect():
        norm = np.linalg.norm(row.v)
        assert len(row.v) == 32
        assert norm == pytest.approx(1.0, abs=1e-6) or (norm == 0 and not (row.text or "").strip("_"))


@pytest.mark.parametrize("name", [None, "lengths"])
def test_model_encoder(spark, name):
    def load():
        return lambda texts: np.array([[len(t), 1.0] for t in texts])

    df = spark.createDataFrame([("abc",), ("",), (None,)], "t string").coalesce(1)
    encoder = ModelEncoder(load, dim=2, batch_size=2, name=name)
    got = [list(r.v) for r in df.select(encoder(F.col("t")).alias("v")).collect()]
    assert got == [[3.0, 1.0], [0.0, 1.0], [0.0, 1.0]]


def test_model_is_loaded_once_per_name():
    from pairloom.operators.encode import _loaded
    loads = []
    for name in ("a", "a", "b", None, None):
        _loaded(name, lambda: loads.append(name) or name)
    assert loads == ["a", "b", None, None]


def test_model_of_the_wrong_length_fails(spark):
    df = spark.createDataFrame([("abc",)], "t string")
    encoder = ModelEncoder(lambda: lambda texts: np.zeros((len(texts), 3)), dim=2)
    with pytest.raises(Exception, match="expected"):
        df.select(encoder(F.col("t"))).collect()


def test_on_demand_vector_of_null_is_null(spark):
    df = spark.createDataFrame([("a",), (None,)], "q string")
    rows = with_vector(df, HashingEncoder(8), "q", "v").collect()
    assert [r.v is None for r in rows] == [False, True]


def test_reembed_replaces_the_vector(spark):
    df = spark.createDataFrame([("1", "some text", [1.0])], "id string, text string, embeddings array<float>")
    row = reembed(df, HashingEncoder(16)).first()
    assert len(row.embeddings) == 16 and row.text == "some text"
