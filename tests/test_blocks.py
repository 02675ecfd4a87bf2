import numpy as np
import pytest
from test_similarity import QUERY_KEYS, brute, result, rows, table  # noqa: F401

from pairloom.operators import blocks, similarity as sim
from pairloom.session import stage

SCHEMA = "id string, v array<float>, grp string"


@pytest.mark.parametrize("memory", [1, 6 * 8 * 40])
@pytest.mark.parametrize("tasks", [3])
def test_rectangles_equal_brute_force(table, rows, memory, tasks, monkeypatch):
    """From one query a block to one block, and with many rectangles in a task."""
    monkeypatch.setattr(blocks, "MIN_DOCS", 50)
    monkeypatch.setattr(blocks, "MAX_TASKS", tasks)
    asked = table.where("id in ('3', '7', 'copy4', 'zero', 'null')") if memory == 1 else table
    got = sim.topk_join(asked, table, 3, **QUERY_KEYS, doc_id="id", doc_vec="v", scan_queries=0, memory=memory)
    want = [r for r in brute(rows, 3) if memory > 1 or r[0] in ("3", "7", "copy4")]
    assert result(got) == want


def clustered(seed, n, dim=16, centres=12, spread=0.05):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, dim))
    middle /= np.linalg.norm(middle, axis=1, keepdims=True)
    return [(f"v{i}", [float(x) for x in (middle[i % centres] + rng.normal(size=dim) * spread).astype(np.float32)], f"g{i % 5}") for i in range(n)]


@pytest.fixture(scope="module")
def near(spark):
    data = clustered(1, 1500)
    return data, stage(spark.createDataFrame(data, SCHEMA).repartition(4), "near")


@pytest.mark.parametrize("use_lead", [True, False])
def test_cells_are_skipped_and_rows_unchanged(near, monkeypatch, use_lead):
    monkeypatch.setattr(blocks, "MIN_QUERIES", 100)
    monkeypatch.setattr(blocks, "MIN_DOCS", 700)
    data, df = near
    index = sim.build_index(df, "id", "v", 12)
    out, report = sim.block_topk(df, index, 4, **QUERY_KEYS, memory=16 * 8 * 150, use_lead=use_lead)
    assert result(out) == brute(data, 4)
    assert report.blocks >= 8 and report.skipped > report.cells / 2
    assert report.doc_copies < report.blocks / 2


@pytest.mark.parametrize("floor,group", [(None, True), (0.9, False), (0.999, True)])
def test_floor_and_groups(near, monkeypatch, floor, group):
    monkeypatch.setattr(blocks, "MIN_QUERIES", 100)
    data, df = near
    data, df = data[:400], stage(df.where("cast(substring(id, 2) as int) < 400"), "few")
    index = sim.build_index(df, "id", "v", 6, group_col="grp" if group else None)
    out, _ = sim.block_topk(df, index, 3, **QUERY_KEYS, floor=floor, query_group="grp" if group else None, memory=16 * 8 * 64)
    assert result(out) == brute(data, 3, floor, True, group)


def test_copies_nulls_and_zeros(table, rows):
    index = sim.build_index(table, "id", "v", 5)
    out, report = sim.block_topk(table, index, 3, **QUERY_KEYS)
    assert result(out) == brute(rows, 3) and report.query_copies >= 2
    collapsed, _ = sim.block_topk(table, sim.build_index(table, "id", "v", 5, keep_copies=4), 3, **QUERY_KEYS, collapse=True)
    assert result(collapsed) == brute(rows, 3)


def test_no_docs_and_more_wanted_than_there_is(spark, near):
    data, df = near
    few = stage(df.where("id in ('v1', 'v2', 'v13')"), "three")
    index = sim.build_index(few, "id", "v", 2)
    out, _ = sim.block_topk(few, index, 50, **QUERY_KEYS)
    assert result(out) == brute([r for r in data if r[0] in ("v1", "v2", "v13")], 50)
    assert sim.topk_join(few, few.limit(0), 2, **QUERY_KEYS, doc_id="id", doc_vec="v", scan_queries=0).count() == 0
    assert sim.topk_join(few.limit(0), few, 2, **QUERY_KEYS, doc_id="id", doc_vec="v", scan_queries=0).count() == 0


def test_vectors_are_copied_sixteen_times_less():
    """Against square blocks of 4,096 rows, for a million vectors of 384 components on both sides."""
    n, dim = 1_000_000, 384
    b, parts = blocks._shape(n, n, dim, 64, blocks.QUERY_BYTES)
    square = -(-n // 4096)
    assert b + parts <= 2 * square / 16 * 1.6 and blocks._shape(n, n, dim, 8, 2 * blocks.QUERY_BYTES)[0] * 16 <= square


def test_lists_are_dealt_to_blocks_by_nearness():
    centroids = np.array([[1, 0], [0, 1], [0.99, 0.1], [0.1, 0.99]], float)
    placed = blocks._blocks_of_lists({0: 10, 1: 10, 2: 10, 3: 10}, centroids, 2)
    assert placed[0][0] == placed[2][0] != placed[1][0] == placed[3][0]
    assert blocks._blocks_of_lists({0: 100, 1: 10}, centroids, 4)[0][1] >= 3 and blocks._blocks_of_lists({}, centroids, 3) == {}


def test_the_rotation_keeps_its_bound():
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=(50, 12)), rng.normal(size=(60, 12))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    lead = np.linalg.qr(rng.normal(size=(12, 12)))[0][:, :3]
    rest = lambda m: np.sqrt(np.maximum(0, 1 - ((m @ lead) ** 2).sum(axis=1)))
    assert ((a @ lead) @ (b @ lead).T + rest(a)[:, None] * rest(b)[None, :] + 1e-12 >= a @ b.T).all()


def test_band_join_equals_its_definition(near, monkeypatch):
    """All docs strictly inside the band, those of the smallest exclusive or of two md5 draws for each query."""
    import hashlib
    monkeypatch.setattr(blocks, "MIN_QUERIES", 100)
    monkeypatch.setattr(blocks, "MIN_DOCS", 300)
    data, df = near
    data, df = data[:600], stage(df.where("cast(substring(id, 2) as int) < 600"), "banded")
    m = np.array([v for _, v, _ in data], np.float32).astype(float)
    length = np.linalg.norm(m, axis=1)
    sims = sim._round(m @ m.T / (length[:, None] * length[None, :]))
    draw = [int(hashlib.md5(f"s:{i}".encode()).hexdigest()[:15], 16) for i, _, _ in data]
    want = []
    for a, (qid, _, _) in enumerate(data):
        inside = sorted((draw[a] ^ draw[b], data[b][0], sims[a, b]) for b in range(len(data)) if 0.2 < sims[a, b] < 0.7)
        want += [(qid, d, s, p) for p, d, s in inside[:4]]
    renamed = df.selectExpr("id as query_id", "v as query_vec"), df.selectExpr("id as doc_id", "v as doc_vec")
    got = blocks.band_join(*renamed, 4, (0.2, 0.7), "s", memory=16 * 8 * 150)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 1000
    assert blocks.band_join(renamed[0].limit(0), renamed[1], 4, (0.2, 0.7), "s").count() == 0


def test_a_query_block_holds_its_vectors_once():
    """A block holds its vectors once, as stored (floats), chunk by chunk; a slice becomes doubles where it is used."""
    import pyarrow as pa

    vectors = [[1.0, 0.0, 2.0], [0.0, 3.0, 0.0], [4.0, 5.0, 6.0]]
    kind = pa.list_(pa.float32())
    tables = [pa.record_batch({"query_id": pa.array(ids), "vec": pa.array(vecs, kind), "kth": pa.array([None] * len(ids), pa.float64()),
                               "list": pa.array([0] * len(ids), pa.int32())}) for ids, vecs in ((["a"], vectors[:1]), (["b", "c"], vectors[1:]))]
    rectangle = blocks._top_k(1, None, True, False, None, None)(tables)
    assert "vec" not in rectangle.queries.column_names
    assert rectangle.matrix.dtype == np.float32 and rectangle.matrix.tolist() == vectors
    assert rectangle.lengths.dtype == np.float64 and np.allclose(rectangle.lengths, np.linalg.norm(vectors, axis=1))
