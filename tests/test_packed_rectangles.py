"""Rectangles over packed vectors: a product in floats finds the pairs, doubles decide them; queries move once a block."""

import numpy as np
import pyarrow as pa
import pytest
from test_similarity import QUERY_KEYS, brute, result

from pairloom.functions.vectors import pack_rows, stored_rows
from pairloom.operators import blocks, similarity as sim
from pairloom.session import stage

SCHEMA = "id string, v array<float>, grp string"


@pytest.mark.parametrize("kind", [pa.float32(), pa.float64(), pa.int64()])
def test_packed_vectors_are_exact(kind):
    rows = [[1, -127, 0], [128, -32768, 5], [300, 2, 1], [2 ** 20, 1, 0]] + ([[0.5, 1e-30, 3.0]] if pa.types.is_floating(kind) else [])
    packed = pack_rows(pa.array(rows, pa.list_(kind)))
    exact = np.array(rows, np.float32 if kind == pa.float32() else np.float64)
    assert stored_rows(packed).astype(np.float64).tolist() == exact.astype(np.float64).tolist()
    assert [len(b.as_py()) for b in packed][0] == 4 and stored_rows(packed[:1]).dtype == np.int8
    assert stored_rows(packed[2:3]).dtype == np.int16 and len(pack_rows(pa.array([], pa.list_(kind)))) == 0


def _rectangle(ids, vectors, **options):
    return blocks._top_k(options.get("k", 2), options.get("floor"), True, False, None, None)([pa.record_batch({
        "query_id": pa.array(ids), "vec": pack_rows(pa.array(vectors, pa.list_(pa.float32()))), "kth": pa.array([None] * len(ids), pa.float64()),
        "list": pa.array([0] * len(ids), pa.int32())})])


def test_a_block_of_counts_takes_a_byte_a_component():
    assert _rectangle(["a", "b"], [[1.0, 0.0, 2.0], [0.0, 3.0, 100.0]]).matrix.dtype == np.int8


@pytest.mark.parametrize("counts", [True, False])
@pytest.mark.parametrize("slices", [(16, 32), (2048, 2048)])
def test_rectangle_equals_doubles_everywhere(monkeypatch, counts, slices):
    """Many copies, similarities that differ in the seventh digit, and sizes that floats cannot square."""
    monkeypatch.setattr(blocks, "QUERY_SLICE", slices[0])
    monkeypatch.setattr(blocks, "DOC_SLICE", slices[1])
    rng = np.random.default_rng(3)
    m = rng.poisson(0.4, size=(300, 24)).astype(np.float32) if counts else rng.normal(size=(300, 24)).astype(np.float32)
    m[200:260] = m[5]
    if not counts:
        m[100:150] = m[7] + rng.normal(size=(50, 24)).astype(np.float32) * 1e-6
        m[260:265] *= np.float32(1e25)
        m[265:270] *= np.float32(1e-25)
    m[299] = 0
    ids = [f"r{i:03d}" for i in range(len(m))]
    rectangle = _rectangle(ids, m.tolist(), k=3, floor=0.2)
    order = rng.permutation(len(m))
    packed = pack_rows(pa.array(m[order].tolist(), pa.list_(pa.float32())))
    docs = pa.record_batch({"doc_id": pa.array([ids[i] for i in order]), "vec": packed})
    for start in range(0, len(m), slices[1]):
        rectangle.meet(docs.slice(start, slices[1]), rectangle.active(0))
    got = sorted((r["query_id"], r["doc_id"], r["similarity"]) for b in rectangle.results() for r in b.to_pylist())
    want = brute([(i, [float(x) for x in v], None) for i, v in zip(ids, m)], 3, 0.2)
    assert got == [(q, d, s) for q, d, s, _ in want]


def _moved(df) -> list:
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in line]


@pytest.fixture(scope="module")
def spread_out(spark):
    rng = np.random.default_rng(5)
    rows = [(f"v{i}", [float(x) for x in rng.normal(size=8).astype(np.float32)], None) for i in range(400)]
    return rows, stage(spark.createDataFrame(rows, SCHEMA).repartition(4), "spread-out")


def test_probing_moves_a_query_once_a_part_not_once_a_list(spread_out, monkeypatch):
    rows, df = spread_out
    index = sim.build_index(df, "id", "v", 8)
    laid = []
    monkeypatch.setattr(blocks, "_rectangles", lambda q, d, *a, f=blocks._rectangles, **b: laid.append((q.count(), d.count())) or f(q, d, *a, **b))
    assert result(sim.probe_topk(df, index, 3, 8, **QUERY_KEYS)) == brute(rows, 3)
    assert laid == [(400, 400)]  # one block and one part: every query and every doc once
    few = result(sim.probe_topk(df, index, 3, 2, **QUERY_KEYS))
    assert 0 < len(set(few) & set(brute(rows, 3))) < 1200


def test_pruning_moves_a_query_once_a_part_and_pass(spread_out, monkeypatch):
    rows, df = spread_out
    index = sim.build_index(df, "id", "v", 8)
    laid = []
    monkeypatch.setattr(blocks, "_rectangles", lambda q, d, *a, f=blocks._rectangles, **b: laid.append((q.count(), d.count())) or f(q, d, *a, **b))
    got = sim.pruned_topk(df, index, 3, **QUERY_KEYS)
    assert result(got) == brute(rows, 3) and not any("FlatMapCoGroups" in line for line in _moved(got))
    assert len(laid) == 2 and all(q == 400 and d <= 400 for q, d in laid)


def test_vectors_move_packed(spread_out):
    _, df = spread_out
    got = sim.topk_join(df, df, 2, **QUERY_KEYS, doc_id="id", doc_vec="v", scan_queries=0, collapse=False)
    assert got._jdf.queryExecution().executedPlan().toString().count("MapInArrow") >= 3  # both sides packed, then compared


def test_cells_for_all_slots_copy_few_rows():
    """One block of all queries would copy each of them to twelve parts."""
    b, parts = blocks._shape(51_282, 51_282, 104, 6, blocks.QUERY_BYTES)
    assert b * parts >= 12 and b + parts <= 8
