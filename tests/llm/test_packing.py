import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import clashing, documents, prose
from tokenizers import Tokenizer

from pairloom.llm import packing, queries

PATH = public_tokenizers.path(queries.BYTES)
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def ids_of(rows):
    lib = Tokenizer.from_file(PATH)
    return [(i, lib.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in rows]


def check(df, rows, window=packing.WINDOW):
    """Every id in one piece, gapless sequences that need no padding; returns the number of sequences."""
    assert df.columns == COLUMNS
    pieces = df.collect()
    assert all(v is not None for r in pieces for v in tuple(r)[1:])
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in pieces:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    want = defaultdict(list)
    for doc_id, ids in ids_of(rows):
        want[doc_id].append(ids)
    assert set(want) == set(by_doc)
    for doc_id, copies in want.items():
        ids, n = copies[0], len(copies)
        assert all(c == ids for c in copies)
        covered = Counter()
        for r in by_doc[doc_id]:
            assert r.doc_tokens == len(ids) and zlib.crc32(np.array(ids[r.start:r.start + r.length], "<u4").tobytes()) == r.ids_crc32
            covered.update(range(r.start, r.start + r.length))
        assert covered == Counter({i: n for i in range(len(ids))})
    return len(sequences)


def odd_rows():
    rows = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (4, "word " * 2047), (5, "word " * 2048), (6, "x" * 5000), (7, "much " * 30_000), (None, "no id"), (8, "naïve 漢字 🤷")]
    rows += [(100 + i, " ".join(prose(i % 7, 40 + 23 * (i % 50)))) for i in range(150)] + [(1000 + i, "the same text for many ids") for i in range(400)]
    return rows + rows[:9]


@pytest.mark.parametrize("shard_rows", [packing.SHARD_ROWS, 40, 1])
def test_every_id_once_and_no_padding(spark, shard_rows):
    rows = odd_rows()
    docs = clashing(documents(spark, rows)).withColumnRenamed("rank", "row").withColumnRenamed("hash", "rest").repartition(4)
    check(packing.pack(docs, PATH, shard_rows=shard_rows), rows)


def test_small_window(spark):
    rows = odd_rows()[:60]
    check(packing.pack(documents(spark, rows), PATH, window=64), rows, 64)
    with pytest.raises(ValueError):
        packing.pack(documents(spark, rows), PATH, window=100)


def test_query_over_a_whole_table(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    sequences = check(queries.op12_packing(spark, data), rows)
    tokens = sum(len(ids) for _, ids in ids_of(rows))
    assert sequences <= tokens / packing.WINDOW + 12


def test_empty_table(spark):
    assert packing.pack(documents(spark, []), PATH).collect() == []


def naive_scores(rests, seed, statistics_over):
    """BM25 by its formula."""
    n, mean = len(statistics_over), sum(map(len, statistics_over)) / len(statistics_over)
    out = []
    for rest in rests:
        score = 0.0
        for t in set(rests[seed]):
            df, tf = sum(t in r for r in statistics_over), rest.count(t)
            score += math.log(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(rest) / mean))
        out.append(score)
    return out


def small_shard(seed, size):
    draw = np.random.default_rng(seed)
    rests = [draw.integers(2, 40, draw.integers(1, 30)).tolist() + [1] for _ in range(size)]
    rest, term, times, sizes = packing._terms([np.array(r) for r in rests], 1)
    df = np.bincount(term, minlength=50)
    statistics = packing.Statistics(df, size, int(sizes.sum()))
    return [r[:-1] for r in rests], packing.ShardIndex(rest, term, statistics.weights(rest, term, times, sizes), size), np.array([len(r) for r in rests])


def test_scores_equal_the_formula():
    bodies, index, _ = small_shard(1, 25)
    for seed in (0, 7, 24):
        assert np.allclose(index.scores(seed), naive_scores(bodies, seed, bodies))


@pytest.mark.parametrize("seed", range(5))
def test_windows_take_the_best_unused_neighbours(seed):
    """A plain packer that sorts all unused rests for each seed makes the same windows."""
    bodies, index, sizes = small_shard(seed, 60)
    left, begin, want, start = dict(enumerate(sizes.tolist())), dict.fromkeys(range(60), 0), [], None
    while left:
        query = start if start is not None else min(left)
        start, size = None, left.pop(query)
        window, room = [(query, begin[query], size)], 64 - size
        scores = index.scores(query)
        for other in sorted(left, key=lambda r: (-scores[r], r)):
            if left[other] <= room:
                window.append((other, begin[other], left[other]))
                room -= left.pop(other)
        if room and left:
            start = min(left, key=lambda r: (-scores[r], r))
            window.append((start, begin[start], room))
            begin[start] += room
            left[start] -= room
        want.append(window)
    got = packing.fill_windows(sizes, index, 64)
    assert got == want and all(sum(p[2] for p in w) == 64 for w in got[:-1])


def test_neighbours_share_words(spark):
    """Documents on one subject end up in the same sequences."""
    subjects = [[f"{c}{w}" for w in prose(i, 60, 30)] for i, c in enumerate("klmnpqrs")]
    draw = np.random.default_rng(2)
    rows = [(i, " ".join(draw.choice(subjects[i % 8], 120))) for i in range(160)]
    out = packing.pack(documents(spark, rows), PATH).collect()
    sequences = defaultdict(set)
    for r in out:
        sequences[r.sequence_id].add(r.doc_id % 8)
    assert np.mean([len(s) for s in sequences.values()]) < 3


def test_last_window_in_powers():
    assert packing.in_powers([(0, 5, 9), (1, 0, 4)]) == [[(0, 5, 8)], [(0, 13, 1), (1, 0, 3)], [(1, 3, 1)]]


def test_a_frequent_term_is_spread(spark):
    rows = [(i, "equal text for all of them") for i in range(900)]
    out = packing.pack(documents(spark, rows), PATH, shard_rows=100)
    assert out.select((out.sequence_id / 2 / (1 << 20)).cast("long").alias("s")).distinct().count() >= 8
