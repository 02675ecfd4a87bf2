"""Packing of whole documents into sequences of fixed size by lexical retrieval.

A document is its token ids and an end id. Whole windows of a longer document are sequences of their own; its rest,
as every shorter document, is packed with neighbours:

1. A narrow pass encodes the texts and stores the rests.
2. Term statistics (a term is a token id) are counted over all rests, as dense vectors added up in a tree.
3. Each rest goes to a shard by its heaviest BM25 term. Counts of that term over the corpus place its rests in a row of all rests,
   and a shard is a stretch of that row of about ``shard_rows``: rare terms share a shard, a frequent one (or a group of copies)
   is spread over as many as it needs, by a hash of the row.
4. A shard holds a BM25 inverted index of its rests, with the corpus' statistics. The first unused rest is the seed of a window;
   the index scores all unused neighbours, and the window takes them best first as long as they fit. The best one that does not fit is cut: its
   head fills the window, what is left of it seeds the next one. So every window but the last of a shard is full, and that
   one is cut into sequences whose lengths are powers of two, which need no padding.

Memory: a shard holds about ``shard_rows`` rests below one window each. The driver gets two vectors with an entry for each
token id. Null and empty texts consist of the end id; each row is packed by itself, so a repeated row is packed again; equal scores
are taken in row order; null ids and other columns do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from pairloom.llm.common import Scratch, added_up, id_and_text, tidy
from pairloom.llm.tokens import byte_tokens
from pairloom.llm.words import mix

WINDOW = 2048
END = 1
SHARD_ROWS = 512
K1, B = 1.2, 0.75        # the usual constants of BM25
LANES = 16               # partial sums in the first level of the tree
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _stored(docs: DataFrame, path: str, window: int, end: int) -> DataFrame:
    """``row, doc_id, doc_tokens, full, rest``: checksums of the whole windows and the ids behind them, four bytes each where two do not do."""

    @tidy
    def run(batches):
        vocabulary = byte_tokens(path)
        kind = _kind(len(vocabulary.bytes))
        for batch in batches:
            sizes, full, rests = [], [], []
            for text in batch.column(2):
                ids = np.append(vocabulary.encode(text.as_py()), np.uint32(end))
                whole = len(ids) // window * window
                sizes.append(len(ids))
                full.append([checksum(ids[i:i + window]) for i in range(0, whole, window)])
                rests.append(ids[whole:].astype(kind).tobytes())
            columns = [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(full, pa.list_(pa.int64())), pa.array(rests, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "doc_tokens", "full", "rest"])

    texts = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return texts.mapInArrow(run, "row long, doc_id long, doc_tokens long, full array<long>, rest binary")


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 65_536 else "<u4"


def _terms(rests: list[np.ndarray], end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rest, term and frequency of each distinct term of each rest, by rest and term, and the lengths; the end id is no term."""
    bodies = [np.sort(r[:-1] if len(r) and r[-1] == end else r, kind="stable") for r in rests]
    sizes = np.array([len(b) for b in bodies], np.int64)
    ids = np.concatenate(bodies) if bodies else np.zeros(0, np.uint16)
    first = np.ones(len(ids) + 1, bool)
    first[1:-1] = ids[1:] != ids[:-1]
    first[np.cumsum(sizes)] = True
    at = np.flatnonzero(first)
    rest = np.repeat(np.arange(len(bodies)), sizes)[at[:-1]]
    return rest, ids[at[:-1]].astype(np.int64), np.diff(at), sizes


class Statistics:
    """Corpus-wide numbers of BM25."""

    def __init__(self, documents: np.ndarray, rests: int, tokens: int):
        self.weight = np.log(1 + (rests - documents + 0.5) / (documents + 0.5))
        self.mean = max(tokens / rests, 1.0) if rests else 1.0

    def weights(self, rest: np.ndarray, term: np.ndarray, times: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        return self.weight[term] * times * (K1 + 1) / (times + K1 * (1 - B + B * sizes[rest] / self.mean))


def _summed(stored: DataFrame, count, size: int) -> np.ndarray:
    """The sum over all tasks of the vector that ``count(rows, rests)`` adds to."""

    @tidy
    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            count(total, batch.column(0).to_numpy(), batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([total.astype("<i8").tobytes()])], ["part", "sums"])

    leaves = stored.select("row", "rest").filter(F.octet_length("rest") > 0).mapInArrow(run, "part int, sums binary")
    lanes = leaves.select("part", (F.spark_partition_id() % LANES).cast("int").alias("lane"), "sums")
    row = added_up(added_up(lanes).select("part", "sums")).first()
    return np.frombuffer(row.sums, "<i8") if row else np.zeros(size, np.int64)


def _read(column: pa.Array, kind: str) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), kind) for x in column]


def _heaviest(rests: list[np.ndarray], statistics: Statistics, vocabulary: int, end: int) -> np.ndarray:
    """The heaviest term of each rest (the smallest of equal ones); ``vocabulary`` for rests without terms."""
    rest, term, times, sizes = _terms(rests, end)
    out = np.full(len(rests), vocabulary)
    if len(rest):
        weights, begins = statistics.weights(rest, term, times, sizes), np.flatnonzero(np.diff(rest, prepend=-1))
        most = np.flatnonzero(weights == np.repeat(np.maximum.reduceat(weights, begins), np.diff(np.append(begins, len(rest)))))[::-1]
        out[rest[most]] = term[most]
    return out


class ShardIndex:
    """An inverted index: postings of each term, in order of the rests."""

    def __init__(self, rest: np.ndarray, term: np.ndarray, weight: np.ndarray, size: int):
        self.size, self.rest, self.term, self.weight = size, rest, term, weight
        order = np.argsort(term, kind="stable")
        self.posted, self.posted_weight = rest[order], weight[order]
        known, self.begin, counts = np.unique(term[order], return_index=True, return_counts=True)
        self.ends = self.begin + counts
        self.compact = np.searchsorted(known, term)
        self.bounds = np.searchsorted(rest, np.arange(size + 1))

    def scores(self, seed: int) -> np.ndarray:
        """BM25 of every rest for the terms of one."""
        terms = self.compact[self.bounds[seed]:self.bounds[seed + 1]]
        begin, counts = self.begin[terms], self.ends[terms] - self.begin[terms]
        total = int(counts.sum())
        at = np.arange(total) + np.repeat(begin - (np.cumsum(counts) - counts), counts)
        return np.bincount(self.posted[at], self.posted_weight[at], self.size)

    def only(self, kept: np.ndarray) -> ShardIndex:
        """The index without the postings of other rests."""
        own = kept[self.rest]
        return ShardIndex(self.rest[own], self.term[own], self.weight[own], self.size)


def fill_windows(sizes: np.ndarray, index: ShardIndex, window: int) -> list[list[tuple[int, int, int]]]:
    """Windows as lists of ``rest, start, length``: every window but the last is full."""
    left, begins = sizes.copy(), np.zeros(len(sizes), np.int64)
    indexed, windows, seed, first = len(sizes), [], None, 0
    while True:
        if seed is None:
            while first < len(left) and not left[first]:
                first += 1
            if first == len(left):
                return windows
            seed = first
        taken, room, query = [(seed, int(begins[seed]), int(left[seed]))], window - int(left[seed]), seed
        left[seed], seed = 0, None
        unused = np.flatnonzero(left)
        if room and len(unused):
            if 2 * len(unused) < indexed:
                kept = left > 0
                kept[query] = True
                index, indexed = index.only(kept), len(unused)
            order = unused[np.argsort(-index.scores(query)[unused], kind="stable")]
            least = left[order]
            for rest, size in zip(order.tolist(), least.tolist()):
                if size <= room:
                    taken.append((rest, int(begins[rest]), size))
                    left[rest] = 0
                    room -= size
                    if not room:
                        break
            if room and (over := order[left[order] > 0]).size:
                seed = int(over[0])
                taken.append((seed, int(begins[seed]), room))
                begins[seed] += room
                left[seed] -= room
        windows.append(taken)


def in_powers(pieces: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """A window that is not full, cut into sequences whose lengths are powers of two, the longest first."""
    total, out, queue = sum(p[2] for p in pieces), [], list(reversed(pieces))
    while total:
        size, sequence = 1 << (total.bit_length() - 1), []
        total -= size
        while size:
            rest, start, length = queue.pop()
            if length > size:
                queue.append((rest, start + size, length - size))
                length = size
            sequence.append((rest, start, length))
            size -= length
        out.append(sequence)
    return out


def pack(docs: DataFrame, path: str, window: int = WINDOW, end: int = END, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``; ``window`` is a power of two."""
    if window & (window - 1):
        raise ValueError("the window has to be a power of two")
    spark, vocabulary = docs.sparkSession, len(byte_tokens(path).bytes)
    kind = _kind(vocabulary)
    stored = Scratch(spark, "packing").stage(_stored(docs, path, window, end), "rests")

    def documents(total, _, rests):
        rest, term, _, sizes = _terms(_read(rests, kind), end)
        total[:vocabulary] += np.bincount(term, minlength=vocabulary)
        total[vocabulary:] += len(sizes), sizes.sum()

    sums = _summed(stored, documents, vocabulary + 2)
    statistics = Statistics(sums[:vocabulary], int(sums[vocabulary]), int(sums[vocabulary + 1]))
    sent = spark.sparkContext.broadcast(statistics)

    def heaviest(total, _, rests):
        total += np.bincount(_heaviest(_read(rests, kind), sent.value, vocabulary, end), minlength=vocabulary + 1)

    counts = _summed(stored, heaviest, vocabulary + 1)
    places = spark.sparkContext.broadcast((np.cumsum(counts) - counts, counts))

    @tidy
    def deal(batches):
        before, counts = places.value
        for batch in batches:
            term = _heaviest(_read(batch.column(3), kind), sent.value, vocabulary, end)
            part = (mix(batch.column(0).to_numpy().astype(np.uint64), 12) >> np.uint64(11)) / float(1 << 53)
            shard = (before[term] + (part * counts[term]).astype(np.int64)) // shard_rows
            yield pa.RecordBatch.from_arrays([pa.array(shard), *batch.columns], ["shard", "row", "doc_id", "doc_tokens", "rest"])

    def packed(group: pa.Table) -> pa.Table:
        group = group.sort_by("row")
        rests = _read(group.column("rest").combine_chunks(), kind)
        rest, term, times, lengths = _terms(rests, end)
        sizes = np.array([len(r) for r in rests], np.int64)
        index = ShardIndex(rest, term, sent.value.weights(rest, term, times, lengths), len(rests))
        windows = fill_windows(sizes, index, window)
        if windows and sum(p[2] for p in windows[-1]) < window:
            windows[-1:] = in_powers(windows[-1])
        ids, tokens = group.column("doc_id").to_pylist(), group.column("doc_tokens").to_pylist()
        first, out = group.column("shard")[0].as_py() << 20 if len(group) else 0, []
        for number, pieces in enumerate(windows):
            offset = 0
            for r, start, length in pieces:
                out.append((ids[r], tokens[r] - len(rests[r]) + start, length, checksum(rests[r][start:start + length]), tokens[r], 2 * (first + number) + 1, offset))
                offset += length
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, zip(*out))})

    rests = stored.filter(F.octet_length("rest") > 0).select("row", "doc_id", "doc_tokens", "rest")
    dealt = rests.mapInArrow(deal, "shard long, row long, doc_id long, doc_tokens long, rest binary")
    whole = stored.select("doc_id", "doc_tokens", F.posexplode("full").alias("number", "ids_crc32")).select(
        "doc_id", (F.col("number") * F.lit(window).cast("long")).alias("start"), F.lit(window).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (2 * F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return whole.unionByName(dealt.groupBy("shard").applyInArrow(packed, PIECES))
