import hashlib
import random
import zlib

import numpy as np
import pytest
from helpers import clashing, documents
from hypothesis import given, settings, strategies as st

from pairloom.llm import queries, runs


def plain_runs(words, least=12):
    """All runs by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def found_runs(sequences, least=12):
    known = {}
    codes, sizes, at = [], [], []
    for words in sequences:
        at.append(len(codes))
        codes += [known.setdefault(w, len(known)) for w in words] + [-1 - len(at)]
        sizes.append(len(words))
    rows = runs.runs_of(np.array(codes, np.int64), np.array(sizes, np.int64), least).tolist()
    return [sorted((s - a, e - s, q) for s, e, q in rows if a <= s < a + n) for a, n in zip(at, sizes)]


def repeated(draw, size, alphabet):
    """Nested repeats: the hard cases for periods at several scales."""
    words = [draw.randrange(alphabet) for _ in range(draw.randint(1, 6))]
    while len(words) < size:
        kind = draw.random()
        if kind < 0.5:
            words += words[-draw.randint(1, len(words)):] * draw.randint(1, 4)
        elif kind < 0.8:
            words += [draw.randrange(alphabet) for _ in range(draw.randint(1, 5))]
        else:
            words[draw.randrange(len(words))] = draw.randrange(alphabet)
    return words[:size]


@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_runs_equal_trying_every_period(alphabet):
    draw = random.Random(alphabet)
    for size in (0, 1, 11, 12, 13, 40, 150, 400):
        texts = [repeated(draw, size, alphabet) for _ in range(12)]
        assert found_runs(texts) == [plain_runs(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=90), max_size=4))
def test_runs_of_any_two_letter_text(texts):
    assert found_runs(texts) == [plain_runs(t) for t in texts]


def test_fibonacci_and_balanced_words():
    a, b = [0], [0, 1]
    while len(b) < 900:
        a, b = b, b + a
    balanced = [bin(i).count("1") % 2 for i in range(1 << 11)]
    assert found_runs([b[:900], balanced]) == [plain_runs(b[:900]), plain_runs(balanced)]


def test_periodic_regions_laid_upon_each_other():
    texts = [[0, 1] * 20 + [0] + [0, 1] * 20 + [0], [5] + [0, 1, 2] * 15 + [0, 1, 2, 0] * 1 + [0, 1, 2] * 12 + [7], ([0, 1] * 9 + [0]) * 5, [3] + ([0, 1] * 30 + [0]) * 2 + [4]]
    assert found_runs(texts) == [plain_runs(t) for t in texts] and len(found_runs(texts)[0]) > 8


def test_long_text_of_two_regions_is_quick():
    import time
    words = ([0, 1] * 100_000 + [0]) * 2
    begun = time.perf_counter()
    assert len(found_runs([words])[0]) > 40_000 and time.perf_counter() - begun < 20


def test_hash_collisions_do_not_reach_the_result():
    words = [1, 2, 3, 4, 5, 6, 7] * 4
    broken = np.array([9] + words[:20] + [50] + words[21:] + [8, -1])
    assert runs._verified(broken, 1, 29, 7, 2) == (1, 21)


def test_set_is_consistent_and_dense():
    draw = random.Random(5)
    codes = np.array([draw.randrange(30) for _ in range(3000)] * 2 + [-1])
    for t in (2, 8, 64):
        members = runs.synchronising_set(runs.Fingerprints(codes), t, np.zeros(len(codes), bool))
        assert np.diff(members).max() <= t
        first = members[members < 3000 - 2 * t]
        again = members[(members >= 3000) & (members < 6000 - 2 * t)] - 3000
        assert first.tolist() == again.tolist()


def contract(doc_id, text):
    """The registered query's row, written from its definition."""
    words = text.encode().split() if text else []
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    found = plain_runs(words)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    return (doc_id, len(found), best[0], best[1], best[2], 1000 * best[1] // best[2] if found else None,
            hashlib.sha256("".join(f"{s},{size},{q}\n" for s, size, q in found).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_equals_the_definition(spark, tmp_path):
    draw = random.Random(1)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "a " * 12), (6, "\x0bé\x1cb  é\x1cb\r" * 9), (7, "x y z " * 8), (8, "a b " * 3000)]
    rows += [(100 + i, " ".join(f"w{w}" for w in repeated(draw, draw.randint(1, 300), 12))) for i in range(150)]
    rows += rows[:8]
    clashing(documents(spark, rows)).write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_runs(spark, str(tmp_path))
    assert out.columns == COLUMNS
    assert sorted((tuple(r) for r in out.collect()), key=str) == sorted((contract(*r[:2]) for r in rows), key=str)
    assert sum(zlib.crc32(str(r[0]).encode()) % 10 == 0 for r in rows) > 5


def test_real_outputs_and_odd_tables(spark):
    docs = documents(spark, [(1, "go on " * 8 + "stop"), (None, "a b c " * 5)])
    rows = {r.doc_id: r for r in runs.periodic_runs(docs).collect()}
    assert [tuple(x) for x in rows[1].runs] == [(0, 16, 2)] and rows[1].collapsed == "go on stop" and rows[1].n_words == 17
    assert rows[None].collapsed == "a b c"
    assert runs.periodic_runs(documents(spark, [])).collect() == []


def test_results_do_not_depend_on_slices(spark, data, monkeypatch):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    batch = docs.select("doc_id", "text").na.fill("").toArrow().combine_chunks().to_batches()[0]
    whole = runs._judge(batch, 12, queries.planted)
    monkeypatch.setattr(runs, "SLICE_BYTES", 20_000)
    parts = [runs._judge(p, 12, queries.planted) for p in runs._slices(batch)]
    import pyarrow as pa
    assert len(parts) > 5 and pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches([whole]).to_pylist()


def test_whole_table_equals_the_definition(spark, data):
    want = {}
    for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect():
        if not r.text or len(r.text) < 6000:
            want[r.doc_id] = contract(r.doc_id, r.text)
    got = {r.doc_id: tuple(r) for r in queries.op11_runs(spark, data).collect()}
    assert len(want) > 150 and {k: got[k] for k in want} == want
