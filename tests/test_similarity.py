import numpy as np
import pytest
from pyspark.sql import functions as F

from pairloom.functions.vectors import batched_cosine, cosine
from pairloom.operators import similarity as sim
from pairloom.session import stage

SCHEMA = "id string, v array<float>, grp string"


def brute(rows, k, floor=None, exclude=True, group=False):
    out = []
    for qid, qv, qg in rows:
        scored = []
        for did, dv, dg in rows:
            if (exclude and did == qid) or (group and qg is not None and qg == dg) or qv is None or dv is None:
                continue
            a, b = np.array(qv, np.float32).astype(float), np.array(dv, np.float32).astype(float)
            scale = np.sqrt((a * a).sum()) * np.sqrt((b * b).sum())
            if scale == 0:
                continue
            s = float(sim._round(np.array([a @ b / scale]))[0])
            if floor is None or s >= floor:
                scored.append((-s, did))
        out += [(qid, did, -s, r) for r, (s, did) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def result(df):
    return sorted((r.query_id, r.doc_id, r.similarity, r["rank"]) for r in df.collect())


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(7)
    base = rng.normal(size=(120, 6)).round(2)
    out = [(str(i), [float(x) for x in v], f"g{i % 9}") for i, v in enumerate(base)]
    out += [(f"copy{i}", out[3][1], None) for i in range(60)]  # a third of all rows are one vector
    out += [("zero", [0.0] * 6, "g0"), ("null", None, "g1")]
    return out


@pytest.fixture(scope="module")
def table(spark, rows):
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(4), "test")


KEYS = {"query_id": "id", "query_vec": "v", "doc_id": "id", "doc_vec": "v"}
QUERY_KEYS = {"query_id": "id", "query_vec": "v"}


@pytest.mark.parametrize("scan, block, collapse", [(0, 17, False), (0, 1000, False), (0, 40, True), (0, 40, None),
                                                   (10_000, None, None)])
def test_exact_equals_brute_force(table, rows, scan, block, collapse, monkeypatch):
    monkeypatch.setattr(sim, "COPIED_PAIRS", 0)
    got = sim.topk_join(table, table, 3, **KEYS, scan_queries=scan, block=block, collapse=collapse)
    assert result(got) == brute(rows, 3)


@pytest.mark.parametrize("scan, collapse", [(0, False), (0, True), (10_000, None)])
def test_floor_and_groups(table, rows, scan, collapse):
    got = sim.topk_join(table, table, 4, **KEYS, floor=0.5, query_group="grp", doc_group="grp", scan_queries=scan,
                        block=40, collapse=collapse)
    assert result(got) == brute(rows, 4, 0.5, True, True)


@pytest.mark.parametrize("collapse", [False, True])
def test_more_wanted_than_there_is(table, rows, collapse):
    got = sim.topk_join(table, table, 500, **KEYS, exclude_same_id=False, scan_queries=0, block=50, collapse=collapse)
    assert result(got) == brute(rows, 500, exclude=False)


def test_copies_are_noticed_and_held_once(table):
    side = sim._side(table, "doc", "id", "v", None)
    assert sim._has_copies(side, "doc_vec") and not sim._has_copies(side.where("doc_id not like 'copy%'"), "doc_vec")
    assert sim._first_copies(side, 4, False).where("doc_id like 'copy%'").count() == 3  # and the original


def test_many_cells_share_tasks(table, rows, monkeypatch):
    monkeypatch.setattr(sim, "MAX_CELL_TASKS", 5)
    got = sim.topk_join(table, table, 3, **KEYS, scan_queries=0, block=30)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "passthrough(direct_shuffle_partition_id(_task" in plan and plan.count("REPARTITION_BY_NUM") == 2
    assert result(got) == brute(rows, 3)


def test_no_docs_and_no_queries(spark, table):
    none = table.limit(0)
    assert result(sim.topk_join(table, none, 2, **KEYS, scan_queries=0)) == []
    assert result(sim.topk_join(none, table, 2, **KEYS, scan_queries=0)) == []
    assert result(sim.topk_join(none, table, 2, **KEYS)) == []


def test_only_the_own_row(spark):
    one = spark.createDataFrame([("a", [1.0, 2.0], None)], SCHEMA)
    assert result(sim.topk_join(one, one, 2, **KEYS)) == []


def test_partitioning_does_not_matter(table):
    a = result(sim.topk_join(table.repartition(1), table.repartition(13), 2, **KEYS, scan_queries=0, block=30))
    assert a == result(sim.topk_join(table, table, 2, **KEYS))


@pytest.fixture(scope="module")
def index(table):
    return sim.build_index(table, "id", "v", 6, group_col="grp")


def test_lists_hold_every_usable_row(index):
    assert sum(index.sizes.values()) == 180  # all but the zero vector and the missing one


@pytest.mark.parametrize("block", [13, 4096])
def test_pruned_equals_brute_force(table, rows, index, block):
    got = sim.pruned_topk(table, index, 3, **QUERY_KEYS, block=block)
    assert result(got) == brute(rows, 3)


@pytest.mark.parametrize("collapse", [False, True])
def test_index_that_holds_few_copies(table, rows, collapse):
    small = sim.build_index(table, "id", "v", 4, group_col="grp", keep_copies=4)
    assert sum(small.sizes.values()) < 130
    got = sim.pruned_topk(table, small, 3, **QUERY_KEYS, query_group="grp", collapse=collapse)
    assert result(got) == brute(rows, 3, None, True, True)
    with pytest.raises(ValueError, match="copies"):
        sim.pruned_topk(table, small, 4, **QUERY_KEYS)


def test_pruned_with_floor_and_groups(table, rows, index):
    got = sim.pruned_topk(table, index, 3, **QUERY_KEYS, floor=0.6, query_group="grp")
    assert result(got) == brute(rows, 3, 0.6, True, True)


def test_probing_all_lists_is_exact(table, rows, index):
    got = sim.probe_topk(table, index, 3, len(index.centroids), **QUERY_KEYS, block=29)
    assert result(got) == brute(rows, 3)


def test_recall_grows_with_probes(spark, data):
    v = spark.read.parquet(f"{data}/embeddings.parquet")
    index = sim.build_index(v, "vec_id", "embedding", 16)
    keys = {"query_id": "vec_id", "query_vec": "embedding"}
    exact = sim.topk_join(v, v, 5, doc_id="vec_id", doc_vec="embedding", **keys)
    wanted = {(r.query_id, r.doc_id) for r in exact.collect()}
    recall = []
    for nprobe in (1, 8):
        got = {(r.query_id, r.doc_id) for r in sim.probe_topk(v, index, 5, nprobe, **keys).collect()}
        recall.append(len(got & wanted) / len(wanted))
    assert recall[0] < recall[1] and recall[1] > 0.6


def test_cosine_expression(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 1.0])],
                               "a array<float>, b array<float>")
    for form in (cosine, batched_cosine):
        assert [r[0] for r in df.select(F.round(form("a", "b"), 6)).collect()] == [0.96, None, None]


def test_docs_are_not_shuffled_for_few_queries(table):
    plan = sim.topk_join(table, table, 3, **KEYS)._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapCoGroups" not in plan and "MapInArrow" in plan


def test_plan_keeps_k_per_query_before_the_shuffle(table):
    plan = sim.topk_join(table, table, 3, **KEYS, scan_queries=0, block=60, collapse=False)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "shufflepartitionidpassthrough" in plan
    assert plan.count("REPARTITION_BY_NUM") == 2  # nothing is shuffled again for the grouping
