"""Alignment of two tokenizers over the same texts, and how often token ids of both end together in the corpus.

Tokenizer A (byte-level) reads a space and the text, tokenizer B (pieces) reads the text and puts the space itself.
Byte offsets at which tokens of both end cut a document into groups; the last A token and the last B token of a group are linked.

1. A narrow pass encodes every text with both, digests its groups and stores the ids of both, two bytes each.
2. The distinct linked id pairs of the corpus get numbers from a minimal perfect hash (``perfect_hash``), whose keys verify each look-up.
3. Tasks count links into dense vectors by these numbers, and a tree of sums adds the vectors up.
4. A second pass aligns the stored ids again and looks the counts up.

The hash and the counts travel to the tasks, so pairs are handled ``slice_pairs`` at a time (18 bytes each): the pairs of a
vocabulary of public size usually make one slice; more pairs make more slices, each with a count and a look-up pass of its own,
whose sums are added by row. No step depends on how often a pair, a text or a source occurs.

Null and empty texts, and texts whose joined token bytes differ from the space and the text (those with U+2581), have no tokens:
zeros and an empty string. Each row counts by itself, so a repeated row counts again; other columns and null ids do not matter; an
empty table gives an empty result. Ties share the highest count of a B id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from pairloom.llm import perfect_hash
from pairloom.llm.common import Scratch, added_up, id_and_text, tidy
from pairloom.llm.words import mix
from pairloom.llm.tokens import SPACE, ByteTokens, PieceTokens, byte_tokens, piece_tokens

SLICE_PAIRS = 4_000_000
BLOCK = 65_536           # counts in one row of the tree of sums
LANES = 16               # partial sums of a block in the first level of the tree
KEPT_PAIRS = 1_000_000   # distinct pairs a task remembers to spare the shuffle
PART_BYTES = 1_000_000   # texts encoded at a time; a longer one stands alone
PART_IDS = 1_000_000     # stored ids aligned at a time; a longer document stands alone
_STORED = "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a binary, b binary"


class Aligner:
    """Groups and links of documents laid end to end."""

    def __init__(self, a_bytes: list[bytes], b_bytes: list[bytes]):
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in table], np.int64) for table in (a_bytes, b_bytes))
        self.b_count = len(b_bytes)
        # Decimal ids with what follows them: a comma inside a group, else the end of its side.
        self.a_count = len(a_bytes)
        self.written = [f"{i}{end}" for count, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for end in ends for i in range(count)]

    def links(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the A and of the B tokens that end together; both sides have the same bytes in all."""
        a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
        total = int(a_ends[-1]) + 1 if len(a) else 1
        marked = np.zeros(total, bool)
        marked[b_ends] = True
        a_last = np.flatnonzero(marked[a_ends])
        marked[:] = False
        marked[a_ends] = True
        return a_last, np.flatnonzero(marked[b_ends])

    def keys(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> np.ndarray:
        """One number for the id pair of each link."""
        return a[a_last].astype(np.int64) * self.b_count + b[b_last].astype(np.int64)

    def groups(self, a: np.ndarray, b: np.ndarray, a_last: np.ndarray, b_last: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Numbers into ``written`` in the order of the groups, and the place of each A and B token among them."""
        in_a, in_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        in_a[a_last], in_b[b_last] = 1, 1
        a_before, b_before = np.concatenate([[0], a_last + 1]), np.concatenate([[0], b_last + 1])
        a_place = np.arange(len(a)) + b_before[np.cumsum(in_a) - in_a]
        b_place = np.arange(len(b)) + a_before[np.cumsum(in_b) - in_b + 1]
        out = np.empty(len(a) + len(b), np.int64)
        out[a_place] = a + in_a * self.a_count
        out[b_place] = 2 * self.a_count + b + in_b * self.b_count
        return out.tolist(), a_place, b_place


_aligners: dict = {}


def _tools(a_path: str, b_path: str) -> tuple[ByteTokens, PieceTokens, Aligner]:
    a, b = byte_tokens(a_path), piece_tokens(b_path)
    if (a_path, b_path) not in _aligners:
        _aligners[a_path, b_path] = Aligner(a.bytes, b.bytes)
    return a, b, _aligners[a_path, b_path]


def _encoded(texts: list[str], a: ByteTokens, b: PieceTokens, aligner: Aligner) -> tuple[list, list]:
    """Ids of both sides for each text; empty ones where the bytes differ.

    Both vocabularies spell every text but what they have no token for, and B writes the space for its mark, so the bytes are
    equal when the text holds no mark, B knows all of it, and both sides have the bytes of the space and the text in number.
    """
    a_ids, b_ids = [], []
    for text, pieces in zip(texts, b.encode_all(texts)):
        ids, pieces = a.encode(" " + text, plain=True) if text else np.zeros(0, np.uint32), np.array(pieces, np.uint32)
        size = len(text.encode()) + 1
        if SPACE in text or aligner.a_sizes[ids].sum() != size or aligner.b_sizes[pieces].sum() != size or b.unknown in pieces:
            ids = pieces = np.zeros(0, np.uint32)
        a_ids.append(ids)
        b_ids.append(pieces)
    return a_ids, b_ids


def _bounds(parts: list) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)


def _joined(parts: list) -> np.ndarray:
    return np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)


def _store(docs: DataFrame, a_path: str, b_path: str, with_groups: bool) -> DataFrame:
    @tidy
    def run(batches):
        a, b, aligner = _tools(a_path, b_path)
        a_type, b_type = ("<u2" if len(t) <= 65_536 else "<u4" for t in (a.bytes, b.bytes))
        for batch in batches:
            rows, ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            at = 0
            while at < len(texts):
                stop, held = at, 0
                while stop < len(texts) and (stop == at or held + len(texts[stop]) <= PART_BYTES):
                    held += len(texts[stop])
                    stop += 1
                a_ids, b_ids = _encoded(texts[at:stop], a, b, aligner)
                a_all, b_all = _joined(a_ids), _joined(b_ids)
                a_last, b_last = aligner.links(a_all, b_all)
                codes, _, _ = aligner.groups(a_all, b_all, a_last, b_last)
                a_at, b_at = _bounds(a_ids), _bounds(b_ids)
                counts = np.diff(np.searchsorted(a_last, a_at))
                texts_out = ["".join(map(aligner.written.__getitem__, codes[i:j]))[:-1] for i, j in zip((a_at + b_at)[:-1].tolist(), (a_at + b_at)[1:].tolist())]
                columns = [rows[at:stop], ids[at:stop], np.diff(a_at), np.diff(b_at), counts, [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts_out],
                           [x.astype(a_type).tobytes() for x in a_ids], [x.astype(b_type).tobytes() for x in b_ids]]
                types = [pa.int64()] * 5 + [pa.string(), pa.binary(), pa.binary()]
                names = ["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a", "b"]
                if with_groups:
                    columns, types, names = columns + [texts_out], types + [pa.string()], names + ["groups"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
                at = stop

    texts = id_and_text(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return texts.mapInArrow(run, _STORED + (", groups string" if with_groups else ""))


def _again(stored: DataFrame, a_path: str, b_path: str, use, schema: str, keep: tuple = ()) -> DataFrame:
    """Align the stored ids again; ``use`` gets pairs, bounds and batch of each batch: the links of row i are pairs[bounds[i]:bounds[i + 1]]."""

    @tidy
    def run(batches):
        a, b, aligner = _tools(a_path, b_path)
        a_type, b_type = ("<u2" if len(t) <= 65_536 else "<u4" for t in (a.bytes, b.bytes))

        def aligned():
            for batch in batches:
                sizes = [pc.binary_length(batch.column(c)).to_numpy() // np.dtype(t).itemsize for c, t in ((1, a_type), (2, b_type))]
                ends, at = np.cumsum(sizes[0] + sizes[1]), 0
                while at < len(ends):
                    stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART_IDS, "right")))
                    part = batch.slice(at, stop - at)
                    a_all, b_all = (np.frombuffer(b"".join(part.column(c).to_pylist()), t) for c, t in ((1, a_type), (2, b_type)))
                    a_last, b_last = aligner.links(a_all, b_all)
                    bounds = np.concatenate([[0], np.cumsum(sizes[0][at:stop])])
                    yield aligner.keys(a_all, b_all, a_last, b_last), np.searchsorted(a_last, bounds), part
                    at = stop

        yield from use(aligned(), aligner.b_count)

    return stored.select("row", "a", "b", *keep).mapInArrow(run, schema)


def _distinct(parts, _):
    """Pairs of a task, each once as far as the task remembers."""
    known = np.zeros(0, np.int64)
    for pairs, _, _ in parts:
        new = np.setdiff1d(pairs, known)
        if len(new):
            known = np.union1d(known, new) if len(known) + len(new) <= KEPT_PAIRS else new
            yield pa.RecordBatch.from_arrays([pa.array(new)], ["key"])


def _numbered(pairs: np.ndarray, function, part: int, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and numbers of the links whose pair belongs to one slice."""
    places = np.flatnonzero(_slice_of(pairs, parts) == part) if parts > 1 else np.arange(len(pairs))
    numbers = function.number(pairs[places])
    if len(numbers) and numbers.min() < 0:
        raise ValueError("a linked pair is missing in the hash of the pairs")
    return places, numbers


def _slice_of(pairs: np.ndarray, parts: int) -> np.ndarray:
    return (mix(pairs.astype(np.uint64), 104) % np.uint64(parts)).astype(np.int64)


def _slice(keys: DataFrame, part: int, parts: int) -> DataFrame:
    def own(batches):
        for batch in batches:
            yield batch.filter(pa.array(_slice_of(batch.column(0).to_numpy(), parts) == part))

    return keys.mapInArrow(own, "key long") if parts > 1 else keys


def _counted(stored: DataFrame, a_path: str, b_path: str, sent, size: int, part: int, parts: int) -> DataFrame:
    """``block, counts``: how many links hold each pair of a slice, from a dense vector of each task, added up in two levels."""

    def count(aligned, _):
        total = np.zeros(size, np.int64)
        for pairs, _, _ in aligned:
            _, numbers = _numbered(pairs, sent.value, part, parts)
            seen, times = np.unique(numbers, return_counts=True)
            total[seen] += times
        blocks = [b for b in range(-(-size // BLOCK)) if total[b * BLOCK:(b + 1) * BLOCK].any()]
        if blocks:
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array([total[b * BLOCK:(b + 1) * BLOCK].astype("<i8").tobytes() for b in blocks])], ["block", "counts"])

    leaves = _again(stored, a_path, b_path, count, "block int, counts binary")
    lanes = leaves.select("block", (F.spark_partition_id() % LANES).cast("int").alias("lane"), "counts")
    return added_up(added_up(lanes).select("block", "counts"))


def _vector(blocks: DataFrame, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    for r in blocks.toLocalIterator():
        out[r.block * BLOCK:(r.block + 1) * BLOCK] = np.frombuffer(r["counts"], "<i8")
    return out


def _looked_up(stored: DataFrame, a_path: str, b_path: str, sent, part: int, parts: int) -> DataFrame:
    """The stored columns but the ids, with the sums over the links of a slice."""
    keep = tuple(c for c in stored.columns if c not in ("row", "a", "b"))

    def look(aligned, b_count):
        function, counts, best = sent.value
        for pairs, bounds, batch in aligned:
            places, numbers = _numbered(pairs, function, part, parts)
            found, highest = np.zeros(len(pairs) + 1, np.int64), np.zeros(len(pairs) + 1, np.int64)
            found[places + 1] = counts[numbers]
            highest[places + 1] = counts[numbers] == best[pairs[places] % b_count]
            sums = [pa.array(np.diff(np.cumsum(x)[bounds])) for x in (highest, found)]
            yield pa.RecordBatch.from_arrays([*sums, batch.column(0), *batch.columns[3:]], ["n_best", "count_sum", "row", *keep])

    schema = ", ".join(["n_best long, count_sum long, row long", *(f"{f.name} {f.dataType.simpleString()}" for f in stored.select(*keep).schema)])
    return _again(stored, a_path, b_path, look, schema, keep)


def align(docs: DataFrame, a_path: str, b_path: str, slice_pairs: int = SLICE_PAIRS, with_groups: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row; ``with_groups`` adds ``groups``."""
    send = docs.sparkSession.sparkContext.broadcast
    scratch = Scratch(docs.sparkSession, "alignment")
    stored = scratch.stage(_store(docs, a_path, b_path, with_groups), "ids")
    keys = scratch.stage(_again(stored, a_path, b_path, _distinct, "key long").distinct(), "pairs")
    total = keys.count()
    parts = max(1, -(-total // slice_pairs))
    b_count = _tools(a_path, b_path)[2].b_count
    best, tables = np.zeros(b_count, np.int64), []
    for part in range(parts):
        function = perfect_hash.build(_slice(keys, part, parts), -(-total // parts))
        sent = send(function)
        tables.append(scratch.stage(_counted(stored, a_path, b_path, sent, len(function.keys), part, parts), f"counts-{part}"))
        counts = _vector(tables[part], len(function.keys))
        np.maximum.at(best, (function.keys % np.uint64(b_count)).astype(np.int64), counts)
        sent.destroy()
    found = None
    for part in range(parts):
        if parts > 1:
            # The same keys give the same function again, so only one slice is held at a time.
            function = perfect_hash.build(_slice(keys, part, parts), -(-total // parts))
            counts = _vector(tables[part], len(function.keys))
        sums = _looked_up(stored, a_path, b_path, send((function, counts, best)), part, parts)
        if parts > 1:
            sums = scratch.stage(sums if part == 0 else sums.select("row", "n_best", "count_sum"), f"found-{part}")
        found = sums if found is None else found.unionByName(sums, allowMissingColumns=True)
    if parts > 1:
        first = [F.max(c).alias(c) for c in found.columns if c not in ("row", "n_best", "count_sum")]
        found = found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"), *first)
    return found.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))
