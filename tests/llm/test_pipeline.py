import pytest
from helpers import by_id, clashing, documents
from oracle_check import connect, differences

import __spark_entry__ as driver
import corpus_pipeline
from pairloom.llm.queries import ORACLE
from pairloom.session import scratch_path


@pytest.fixture(scope="module")
def con(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, data, con, name):
    assert differences(driver.queries()[name](spark, data), con, ORACLE[name]) == []


def test_all_are_registered():
    names = set(driver.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}


def test_stages_chain(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, data).write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.count())
        assert docs.columns == columns or name == "tokens"
    assert sizes == sorted(sizes, reverse=True) and sizes[2] < sizes[1] and sizes[3] < sizes[2] and sizes[-1] > 0
    assert docs.select("doc_id").distinct().count() == sizes[-1]


def test_stages_bear_odd_rows(spark, data):
    rows = [(1, None), (2, ""), (3, "1 2 3"), (4, "the word of the day is here"), (5, "the word of the day is here"), (6, "a " * 20_000)]
    for table in (documents(spark, rows), documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, data)
            assert out.count() <= table.count(), name


def test_near_duplicates_by_five_words(spark, data):
    words = [f"w{i}" for i in range(100)]
    # Two words far apart: 86 of 106 shingles of five words; three: 81 of 111, below 0.8.
    two = [{30: "x", 60: "y"}.get(i, w) for i, w in enumerate(words)]
    three = [f"v{i}" if i not in (20, 50, 80) else f"z{i}" for i in range(100)]
    docs = documents(spark, [(1, " ".join(words)), (2, " ".join(two)), (3, " ".join(f"v{i}" for i in range(100))), (4, " ".join(three))])
    stage = dict(corpus_pipeline.STAGES)["near_duplicates"]
    assert sorted(r.doc_id for r in stage(spark, docs, data).collect()) == [1, 3, 4]


def test_short_benchmark_items_bear_a_changed_word(spark, tmp_path):
    spark.createDataFrame([(1, "which of the nine rivers flows through the old grey town")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(1, "say which of the ten rivers flows through the old grey town today"), (2, "a text of its own")])
    stage = dict(corpus_pipeline.STAGES)["decontaminate"]
    assert [r.doc_id for r in stage(spark, docs, str(tmp_path)).collect()] == [2]


def test_documents_in_several_languages_stay(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    by_language = {}
    for r in docs.filter("text is not null and length(text) > 300").orderBy("doc_id").collect():
        by_language.setdefault(r.lang, []).append(r.text[:300])
    assert len(by_language) > 3
    texts = [by_language[k] for k in sorted(by_language)]
    mixed = [(10_000_000 + i, " ".join(t[i % len(t)] for t in (texts[i % len(texts):] + texts)[:3])) for i in range(30)]
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(documents(spark, mixed)), data)
    assert kept.filter("doc_id >= 10000000").count() == 30
    assert [corpus_pipeline.least_score(n) for n in (0, 1, 2)] == [0, 0, 0] and 1 / 5 < corpus_pipeline.least_score(5) < 1 / 4


def test_stages_keep_columns_named_like_results(spark, data):
    """Extra columns of any name come out of every stage as they went in."""
    from pyspark.sql import functions as F
    docs = clashing(spark.read.parquet(f"{data}/documents.parquet"))
    for name in ("held_out", "lang_pred", "component_id", "n_tokens", "_own0"):
        docs = docs.withColumn(name, F.concat(F.lit(name), F.col("doc_id").cast("string")))
    docs = docs.withColumn("score", F.col("doc_id") + 0.5)
    given = by_id(docs.select("doc_id", *[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, data)
        assert out.columns == docs.columns
        kept = by_id(out.select("doc_id", *[c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]))
        assert kept and all(given[k] == v for k, v in kept.items()), name
    assert dict(corpus_pipeline.STAGES)["tokens"](spark, docs, data).count() == docs.count()
