"""Removal of long word passages that repeat across documents, on a compacted graph of word windows.

Words are the runs between white space, unchanged. The edges of the graph are the windows of ``window`` consecutive
words; a window is named by its anchor, the k-mer of ``SEED`` words with the smallest hash in it, so equal windows
share their anchor. Consecutive windows on one anchor form a block: a path of edges that is compacted at once. An
anchor with a single block is a nonbranching node: wherever it occurs the path goes on alike, and one row settles
all its windows. Only at anchors with several blocks are windows compared one by one, once for each distinct
block, which is read again at the coordinates of its source, the smallest document that has it. A window whose
source is a smaller document than its own is removed, and the words under removed windows go.

Copies of a passage meet in partial aggregates, so a passage in a third of all documents is one row per task; the
rows that go back to its occurrences are left to the skew handling of joins. Nothing is capped or sampled.

Null text has no words. Repeated ids count as one document: windows are only compared between different ids, and
each row is returned. Different texts of one id are told apart by their hash, so that each is read at coordinates of
its own. Empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import Scratch, id_and_text
from pairloom.llm.words import hash_words, mix

WINDOW = 50
SEED = 12
PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64), 77) | np.uint64(1)
_powers: dict = {}


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        steps = np.full(max(size, 1 << 16), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.multiply.accumulate(steps)
    return known[:size]


def _running(codes: np.ndarray) -> np.ndarray:
    """Prefix sums from which :func:`_range_codes` takes the code of any range."""
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * _power(_BASE, len(codes)), dtype=np.uint64)])


def _range_codes(running: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mix((running[stop] - running[start]) * _power(_INVERSE, len(running))[start], 21) + (stop - start).astype(np.uint64)


def _path_blocks(codes: np.ndarray, sizes: np.ndarray, window: int):
    """Blocks of several word sequences laid end to end: (sequence, start in it, windows, anchor, block)."""
    n = len(codes)
    if n < window:
        return None
    seeds = np.zeros(n - SEED + 1, np.uint64)
    for j in range(SEED):
        seeds += codes[j:n - SEED + 1 + j] * _FACTORS[j]
    seeds = mix(seeds, 31)
    low = (seeds & ~_PLACE) | np.arange(len(seeds), dtype=np.uint64)
    width, have = window - SEED + 1, 1
    while 2 * have <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if width > have:
        low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    many = np.maximum(sizes - window + 1, 0)
    owner = np.repeat(np.arange(len(sizes)), many)
    if not len(owner):
        return None
    at = np.arange(len(owner)) - np.repeat(np.cumsum(many) - many, many) + begins[owner]
    place = (low[at] & _PLACE).astype(np.int64)
    fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])])
    first = np.flatnonzero(fresh)
    count = np.diff(np.concatenate([first, [len(owner)]]))
    start = at[first]
    block = _range_codes(_running(codes), start, start + count + window - 1) + mix((place[first] - start).astype(np.uint64), 5)
    return owner[first], start - begins[owner[first]], count, seeds[place[first]], block


def _blocks(docs: DataFrame, window: int) -> DataFrame:
    """``doc_id, text_id, start, n, anchor, block`` for every block of every row."""
    def run(batches):
        for batch in batches:
            held, ids, texts, offsets, total = [], [], [], [], 0

            def flush():
                out = _path_blocks(np.concatenate(held), np.array([len(h) for h in held]), window)
                if out is None:
                    return
                owner, start, count, anchor, block = out
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.array(ids, np.int64)[owner]), pa.array(np.array(texts, np.int64)[owner]), pa.array(start + np.array(offsets, np.int64)[owner]), pa.array(count.astype(np.int32)),
                     pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64))], ["doc_id", "text_id", "start", "n", "anchor", "block"])

            for doc_id, text_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                codes = hash_words(text.as_py().encode().split())
                for offset in range(0, len(codes) - window + 1, PIECE):
                    piece = codes[offset:offset + PIECE + window - 1]
                    held.append(piece)
                    ids.append(doc_id)
                    texts.append(text_id)
                    offsets.append(offset)
                    total += len(piece)
                    if total >= PIECE:
                        yield from flush()
                        held, ids, texts, offsets, total = [], [], [], [], 0
            if held:
                yield from flush()

    return docs.select("doc_id", "text_id", "text").mapInArrow(run, "doc_id long, text_id long, start long, n int, anchor long, block long")


def _windows(docs: DataFrame, sources: DataFrame, window: int) -> DataFrame:
    """``anchor, block, at, code, low`` for each window of the blocks in ``sources``, read at their coordinates."""
    wanted = sources.groupBy(F.col("low").alias("doc_id"), F.col("low_text").alias("text_id")).agg(F.collect_list(F.struct("anchor", "block", "start", "n")).alias("blocks"))

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, text, blocks in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                running = _running(hash_words(text.as_py().encode().split()))
                fields = blocks.values
                anchor, block, start, n = (fields.field(i).to_numpy(zero_copy_only=False) for i in range(4))
                row = np.repeat(np.arange(len(n)), n)
                at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                begin = start[row] + at
                code = _range_codes(running, begin, begin + window)
                out.append((anchor[row], block[row], at.astype(np.int32), code.view(np.int64), np.full(len(row), doc_id, np.int64)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["anchor", "block", "at", "code", "low"])

    return docs.join(wanted, ["doc_id", "text_id"]).select("doc_id", "text", "blocks").mapInArrow(run, "anchor long, block long, at int, code long, low long")


def _told_apart(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``doc_id, text_id, text``: 0 for an id with one text, else the hash of the text."""
    hashed = docs.withColumn("hash", F.xxhash64("text"))
    several = scratch.stage(hashed.groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).filter("low < high").select("doc_id", F.lit(True).alias("several")), "several")
    return hashed.join(several, "doc_id", "left").select("doc_id", F.when(F.col("several"), F.col("hash")).otherwise(F.lit(0)).cast("long").alias("text_id"), "text")


def repeats(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """``doc_id, text_id, start, n, low, lows``: blocks with windows that a smaller document has too.

    Window ``i`` of a block starts at word ``start + i``; its smallest document is ``lows[i]``, or ``low`` where
    ``lows`` is null.
    """
    blocks = scratch.stage(_blocks(docs, window), "blocks")
    distinct = blocks.groupBy("anchor", "block").agg(F.min(F.struct("doc_id", "text_id", "start", "n")).alias("source"), F.max("doc_id").alias("high"))
    distinct = distinct.select("anchor", "block", F.col("source.doc_id").alias("low"), F.col("source.text_id").alias("low_text"), "source.start", "source.n", "high")
    nodes = distinct.groupBy("anchor").agg(F.min("low").alias("node_low"), F.max("high").alias("node_high"), F.count(F.lit(1)).alias("paths"))
    shared = scratch.stage(distinct.join(nodes.filter("node_low < node_high"), "anchor").select("anchor", "block", "low", "low_text", "start", "n", "paths"), "shared")
    windows = scratch.stage(_windows(docs, shared.filter("paths > 1"), window), "windows")
    least = windows.groupBy("anchor", "code").agg(F.min("low").alias("least"))
    # A set, as repeated rows of the source document give each window again.
    settled = windows.join(least, ["anchor", "code"]).groupBy("anchor", "block").agg(
        F.transform(F.array_sort(F.collect_set(F.struct("at", "least"))), lambda x: x["least"]).alias("lows"))
    known = (shared.filter("paths = 1").select("anchor", "block", "low", F.lit(None).cast("array<long>").alias("lows"))
             .unionByName(settled.select("anchor", "block", F.array_min("lows").alias("low"), "lows")))
    return blocks.join(known, ["anchor", "block"]).filter("low < doc_id").select("doc_id", "text_id", "start", "n", "low", "lows")


def without_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` (with ``with_text`` also ``kept``) for every row of ``docs``."""
    scratch = Scratch(docs.sparkSession, "substring")
    docs = _told_apart(id_and_text(docs), scratch)
    found = repeats(docs, scratch, window).groupBy("doc_id", "text_id").agg(F.collect_set(F.struct("start", "n", "lows")).alias("found"))

    def run(batches):
        for batch in batches:
            sizes, removed, digests, kept_texts = [], [], [], []
            for doc_id, text, found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                words = text.as_py().encode().split()
                sizes.append(len(words))
                if found.is_valid and len(words) >= window:
                    edge = np.zeros(len(words) + 1, np.int64)
                    for block in found.as_py():
                        start, n, lows = block["start"], block["n"], block["lows"]
                        if lows is None:
                            edge[start] += 1
                            edge[start + n + window - 1] -= 1
                        else:
                            at = start + np.flatnonzero(np.array(lows) < doc_id)
                            np.add.at(edge, at, 1)
                            np.add.at(edge, at + window, -1)
                    covered = np.cumsum(edge[:-1]) > 0
                    removed.append(int(covered.sum()))
                    words = [w for w, c in zip(words, covered) if not c]
                else:
                    removed.append(0)
                kept = b" ".join(words)
                digests.append(hashlib.sha256(kept).hexdigest())
                kept_texts.append(kept.decode() if with_text else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                columns, names = columns + [pa.array(kept_texts, pa.string())], names + ["kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    joined = docs.join(found, ["doc_id", "text_id"], "left").select("doc_id", "text", "found")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if with_text else ""))
