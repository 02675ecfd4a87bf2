"""Exact top-k similarity join in rectangles: a block of queries stays in a task while docs stream past it.

A task holds one block of queries, as large as ``memory`` allows, and the k best of each so far; the docs it meets pass in
batches, so their number is bounded by parallelism alone. Each doc is copied once per query block and each query once per
part of the docs: with blocks of 65,536 rows a sixteenth of what square blocks of 4,096 would copy.

With ``lists``, blocks and docs are formed by nearness and cells are skipped exactly. Docs are assigned to centroids, which have an
angular radius; queries of neighbouring centroids share a block. A first pass lets each query meet the docs of its own list, which gives
it a lower bound for its k-th similarity. A doc of a list within radius r of centroid c has at most the cosine
cos(max(0, angle(q, c) - r)) with q, so a block needs only the lists that one of its queries can reach by that bound; other
cells (block x list) are neither moved nor compared. Inside a cell, the leading components of a rotation that concentrates
the docs' length there bound the product: ``lead(q) . lead(d) + |rest(q)| |rest(d)|`` (Cauchy-Schwarz); docs whose bound reaches no query
of the block are dropped before the full product.

Results are those of comparing every pair: similarities in double precision from the stored vectors, rounded, ties to the smaller id.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from pairloom.functions.vectors import as_matrix, packed, row_lengths, stored_rows
from pairloom.operators.kernels import _first_k, _keep_first_k, _round
from pairloom.session import stage

QUERY_BYTES = 256 << 20      # doubles of one query block
MIN_QUERIES = 512            # a block is not cut below this for the sake of parallelism
MIN_DOCS = 1024              # nor a part of the docs
MAX_PART_DOCS = 4_000_000    # docs one task compares with its block
MAX_TASKS = 20_000           # beyond it a task takes several rectangles, one after the other
MAX_LISTS = 1024
MAX_REACH = 2_000_000        # (block, list) pairs a plan may hold; lists are fewer where blocks are many
DOC_SLICE, QUERY_SLICE = 2048, 2048
LEAD_SHARE = 4               # a rotation keeps one in so many components
SLACK = 1e-6                 # covers rounding of similarities and of bounds
FEW = 4                      # pairs worth a similarity of their own, in units of k a query and slice; more are compared as a whole
HELD = 3                     # rows a query slice collects before the k best are kept, in units of k a query
PAIRS = 4096                 # pairs compared in doubles at a time
KEPT_BYTES = 64              # of a row that a task keeps for a query, while it is sorted
NEAR = "near"                # the queries say themselves which lists they search
_DOC, _QUERY = 1, 0


@dataclass(frozen=True)
class BlockReport:
    """What a join moved and skipped: cells are pairs of a query block and a doc list (or part)."""

    blocks: int
    parts: int
    lists: int
    cells: int
    searched: int
    doc_copies: float      # copies of a doc, on average over all docs
    query_copies: int

    @property
    def skipped(self) -> int:
        return self.cells - self.searched


def rotation(docs: DataFrame, vec: str, dim: int) -> np.ndarray:
    """The ``dim / LEAD_SHARE`` directions that hold most of the docs' length, as columns.

    From the sum of outer products of unit vectors over all docs, one matrix per task. It only shapes the bound; any orthonormal columns are valid.
    """
    schema = "i int, row array<double>"

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            m = as_matrix(batch.column(0))
            if len(m):
                length = row_lengths(m)
                u = m[length > 0] / length[length > 0][:, None]
                total += u.T @ u
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(total))], names=["i", "row"])

    def add(rows: pa.Table) -> pa.Table:
        return pa.table({"i": rows["i"][:1], "row": pa.array([as_matrix(rows["row"]).sum(axis=0)])})

    parts = docs.select(vec).mapInArrow(products, schema).withColumn("part", F.spark_partition_id() % 64)
    summed = parts.groupBy("i", "part").applyInArrow(add, schema).groupBy("i").applyInArrow(add, schema).collect()
    matrix = np.zeros((dim, dim))
    for r in summed:
        matrix[r["i"]] = r["row"]
    _, vectors = np.linalg.eigh(matrix)
    return vectors[:, ::-1][:, :max(1, dim // LEAD_SHARE)]


class _Rectangle:
    """One query block in a task: the queries, their thresholds and the best rows so far.

    A product in single precision, whose error is bounded, finds the pairs that may reach a query's threshold; only those get a similarity in
    doubles from the stored vectors, so the rows are those of comparing every pair in doubles.
    """

    def __init__(self, tables: list[pa.RecordBatch], k: int, floor: float, exclude_same_id: bool, grouped: bool, lists, lead):
        self.k, self.lists, self.lead = k, lists, lead
        # Held once, as stored; a slice becomes floats or doubles where it is used. Combined, the other columns let go of the batches.
        self.matrix = _stored([t.column(t.schema.names.index("vec")) for t in tables])
        self.queries = pa.Table.from_batches(tables).drop_columns(["vec"]).combine_chunks()
        n = len(self.matrix)
        self.slices = [slice(s, min(n, s + QUERY_SLICE)) for s in range(0, n, QUERY_SLICE)]
        self.lengths = np.concatenate([row_lengths(self._doubles(s)) for s in self.slices] or [np.zeros(0)])
        given = self.queries["kth"].fill_null(-np.inf).to_numpy()
        # A zero query has no similarity, so nothing reaches it.
        self.least = np.where(self.lengths > 0, np.maximum(given, floor), np.inf)
        self.own = self.queries["list"].to_numpy()
        self.near = _stored(self.queries["near"].chunks) if lists == NEAR else None
        usual = self.lengths[self.lengths > 0]
        # Vectors of a usual size enter the product as they are, others divided by their length.
        self.plain = self.matrix.dtype != np.float64 and bool(((usual > 1e-12) & (usual < 1e12)).all())
        self.scale = self.lengths if self.plain else np.where(self.lengths > 0, 1.0, 0.0)
        self.slack = SLACK + (self.matrix.shape[1] + 16) * 2.0 ** -23
        self.banned = [_Banned(self.queries[a], b) for a, b in (("query_id", "doc_id"), ("query_group", "doc_group"))[not exclude_same_id:1 + grouped]]
        self.held: dict[int, list] = {}
        self.products, self.marks = np.empty(QUERY_SLICE * DOC_SLICE, np.float32), np.empty(QUERY_SLICE * DOC_SLICE, bool)
        if lead is not None:
            self.front = np.concatenate([self._unit(s) @ lead for s in self.slices] or [np.zeros((0, lead.shape[1]))])
            self.rest = np.sqrt(np.maximum(0, 1 - (self.front ** 2).sum(axis=1)))
        self.useful = True

    def _doubles(self, rows) -> np.ndarray:
        return self.matrix[rows].astype(np.float64)

    def _unit(self, rows) -> np.ndarray:
        return self._doubles(rows) / np.where(self.lengths[rows] > 0, self.lengths[rows], 1)[:, None]

    def _floats(self, rows) -> np.ndarray:
        return self.matrix[rows].astype(np.float32, copy=False) if self.plain else self._unit(rows).astype(np.float32)

    def active(self, number: int) -> np.ndarray:
        """The queries that have to meet a list."""
        if self.lists is None:
            return np.flatnonzero(self.least < np.inf)
        if self.lists == NEAR:
            return np.flatnonzero((self.near == number).any(axis=1) & (self.least < np.inf))
        centroids, radius, first = self.lists
        if first:
            return np.flatnonzero((self.own == number) & (self.least < np.inf))
        angle = np.arccos(np.clip(np.concatenate([self._unit(s) @ centroids[number] for s in self.slices]), -1, 1))
        bound = np.cos(np.maximum(0.0, angle - radius[number])) + SLACK
        return np.flatnonzero((self.own != number) & (bound >= self.least))

    def meet(self, docs: pa.RecordBatch, queries: np.ndarray) -> None:
        order = pc.sort_indices(docs.column(docs.schema.names.index("doc_id")))
        d = stored_rows(docs.column(docs.schema.names.index("vec")))[order.to_numpy()].astype(np.float64)
        dn = row_lengths(d)
        kept = np.flatnonzero((dn > 0) & np.isfinite(d).all(axis=1))
        if self.lead is not None and self.useful and len(kept) and np.isfinite(self.least[queries]).all():
            unit = d[kept] / dn[kept][:, None]
            front = unit @ self.lead
            rest = np.sqrt(np.maximum(0, 1 - (front ** 2).sum(axis=1)))
            reached = np.zeros(len(kept), bool)
            for start in range(0, len(queries), QUERY_SLICE):
                part = queries[start:start + QUERY_SLICE]
                bound = self.front[part] @ front.T + self.rest[part][:, None] * rest[None, :]
                reached |= (bound >= (self.least[part] - SLACK)[:, None]).any(axis=0)
            # A bound that drops little is not worth its product, so it is given up for this block.
            self.useful = reached.mean() < 0.7
            kept = kept[reached]
        if not len(kept):
            return
        docs, d, dn = docs.take(order.take(pa.array(kept))), d[kept], dn[kept]
        unit = (d / dn[:, None]).astype(np.float32)
        codes = [b.codes(docs) for b in self.banned]
        ids = docs.column(docs.schema.names.index("doc_id"))
        cuts = np.searchsorted(queries, [s.start for s in self.slices] + [len(self.matrix)])
        for number, (begin, end) in enumerate(zip(cuts[:-1], cuts[1:])):
            if begin < end:
                whole = end - begin == self.slices[number].stop - self.slices[number].start
                found = self._best(self.slices[number] if whole else queries[begin:end], queries[begin:end], d, dn, unit, codes)
                if len(found[0]):
                    self.held.setdefault(number, []).append((*found[:2], ids.take(pa.array(found[2]))))
                    if sum(len(h[0]) for h in self.held[number]) > HELD * self.k * (self.slices[number].stop - self.slices[number].start):
                        self.settle(number)

    def _best(self, rows, part: np.ndarray, d: np.ndarray, dn: np.ndarray, unit: np.ndarray, codes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, similarities and doc numbers of the pairs that may be among the k best; ``rows`` picks the queries ``part``."""
        shape = (len(part), len(d))
        dots = np.matmul(self._floats(rows), unit.T, out=self.products[:shape[0] * shape[1]].reshape(shape))
        hits = self.marks[:shape[0] * shape[1]].reshape(shape)
        bar = lambda: ((self.least[part] - self.slack) * self.scale[part]).astype(np.float32)[:, None]
        np.greater_equal(dots, bar(), out=hits)
        many = FEW * self.k * len(part)
        n = np.count_nonzero(hits)
        if n > many and len(d) > self.k:
            # No doc below the k-th best of these can be among the k best of all.
            for (q, _), c in zip(((b.own[part], b) for b in self.banned), codes):
                dots[(q[:, None] == c[None, :]) & (q >= 0)[:, None]] = -np.inf
            kth = np.concatenate([np.partition(dots[s:s + 256], len(d) - self.k, axis=1)[:, len(d) - self.k] for s in range(0, len(part), 256)])
            self.least[part] = np.maximum(self.least[part], kth / self.scale[part] - self.slack)
            n = np.count_nonzero(np.greater_equal(dots, bar(), out=hits))
        if n > many:
            every = [self._compared(part[s:s + 256], d, dn, [(b.own[part[s:s + 256]], c) for b, c in zip(self.banned, codes)]) for s in range(0, len(part), 256)]
            return tuple(np.concatenate([e[i] for e in every]) for i in range(3))
        at = np.flatnonzero(hits.reshape(-1))
        rows, cols = at // shape[1], at % shape[1]
        for b, c in zip(self.banned, codes):
            own = b.own[part[rows]]
            free = (own != c[cols]) | (own < 0)
            rows, cols = rows[free], cols[free]
        q = part[rows]
        dots = [np.einsum("ij,ij->i", self._doubles(q[s:s + PAIRS]), d[cols[s:s + PAIRS]]) for s in range(0, len(q), PAIRS)]
        values = _round(np.concatenate(dots or [np.zeros(0)]) / (self.lengths[q] * dn[cols]))
        fits = values >= self.least[q]
        return q[fits], values[fits], cols[fits]

    def _compared(self, part: np.ndarray, d: np.ndarray, dn: np.ndarray, codes: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best of every pair, in doubles throughout: where many docs are level."""
        sims = _round((self._doubles(part) @ d.T) / (self.lengths[part][:, None] * dn[None, :]))
        sims[~(sims >= self.least[part][:, None])] = -np.inf
        for q, c in codes:
            sims[(q[:, None] == c[None, :]) & (q >= 0)[:, None]] = -np.inf
        rows, cols = _first_k(sims, self.k)
        return part[rows], sims[rows, cols], cols

    def settle(self, number: int) -> None:
        """Keep the k best of each query of a slice and raise its threshold to the last of them."""
        q, values, ids = zip(*self.held[number])
        held = _keep_first_k(pa.table({"q": pa.array(np.concatenate(q)), "similarity": pa.array(np.concatenate(values)), "doc_id": pa.concat_arrays(ids)}), self.k).combine_chunks()
        q, values = held["q"].to_numpy(), held["similarity"].to_numpy()
        last = np.flatnonzero(np.diff(q, append=-1))
        full = last[np.diff(last, prepend=-1) >= self.k]
        self.least[q[full]] = np.maximum(self.least[q[full]], values[full])
        self.held[number] = [(q, values, held["doc_id"].chunk(0) if len(q) else pa.concat_arrays(ids)[:0])]

    def results(self) -> Iterator[pa.RecordBatch]:
        for number in sorted(self.held):
            self.settle(number)
            (q, values, ids), = self.held.pop(number)
            out = pa.table({"query_id": self.queries["query_id"].take(pa.array(q)), "doc_id": ids, "similarity": values})
            yield from out.combine_chunks().to_batches()


class _Banned:
    """Numbers for the values of a query column, so that the docs a query may not meet are found by number; null is no value."""

    def __init__(self, queries: pa.ChunkedArray, docs: str):
        numbered = queries.combine_chunks().dictionary_encode()
        numbered = numbered.combine_chunks() if isinstance(numbered, pa.ChunkedArray) else numbered
        self.own, self.values, self.docs = numbered.indices.fill_null(-1).to_numpy(zero_copy_only=False), numbered.dictionary, docs

    def codes(self, docs: pa.RecordBatch) -> np.ndarray:
        return pc.index_in(docs.column(docs.schema.names.index(self.docs)), value_set=self.values).fill_null(-2).to_numpy(zero_copy_only=False)


class _BandRectangle:
    """One query block: of the docs whose similarity lies strictly inside a band, those of the smallest priorities for each query."""

    def __init__(self, tables: list[pa.RecordBatch], k: int, band: tuple[float, float], seed: str):
        self.queries, self.k, self.band, self.seed = pa.Table.from_batches(tables), k, band, seed
        self.matrix = as_matrix(self.queries["vec"])
        self.lengths = row_lengths(self.matrix)
        self.keys = draws(self.queries["query_id"], seed)
        self.most = np.full(len(self.matrix), np.iinfo(np.int64).max)
        self.held: list[tuple] = []
        self.rows, self.limit = 0, max(200_000, 4 * k * len(self.matrix))

    def active(self, number: int) -> np.ndarray:
        return np.flatnonzero(self.lengths > 0)

    def meet(self, docs: pa.RecordBatch, queries: np.ndarray) -> None:
        d = as_matrix(docs.column(docs.schema.get_field_index("vec")))
        dn, ids = row_lengths(d), docs.column(docs.schema.get_field_index("doc_id"))
        keys = draws(ids, self.seed)
        low, high = self.band
        for start in range(0, len(queries), QUERY_SLICE):
            part = queries[start:start + QUERY_SLICE]
            # Only priorities that still count are worth a similarity.
            priority = self.keys[part][:, None] ^ keys[None, :]
            scale = self.lengths[part][:, None] * dn[None, :]
            dots = self.matrix[part] @ d.T
            near = (priority < self.most[part][:, None]) & (scale > 0) & (dots > (low - SLACK) * scale) & (dots < (high + SLACK) * scale)
            rows, cols = np.nonzero(near)
            values = _round(dots[rows, cols] / scale[rows, cols])
            inside = (values > low) & (values < high)
            rows, cols, values = rows[inside], cols[inside], values[inside]
            if len(rows):
                self.held.append((part[rows], priority[rows, cols], values, ids.take(pa.array(cols))))
                self.rows += len(rows)
        if self.rows > self.limit:
            self.settle()

    def settle(self) -> None:
        q, priority, values = (np.concatenate([h[i] for h in self.held]) for i in range(3))
        ids = pa.chunked_array([h[3] for h in self.held])
        order = np.lexsort((priority, q))
        q = q[order]
        starts = np.concatenate([[0], np.flatnonzero(np.diff(q)) + 1]) if len(q) else np.zeros(0, int)
        rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
        kept = order[rank < self.k]
        full = q[rank == self.k - 1]
        self.most[full] = priority[order[rank == self.k - 1]] + 1
        self.held = [(q[rank < self.k], priority[kept], values[kept], ids.take(pa.array(kept)).combine_chunks())]
        self.rows = len(kept)

    def results(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self.settle()
            q, priority, values, ids = self.held[0]
            out = pa.table({"query_id": self.queries["query_id"].take(pa.array(q)), "doc_id": ids, "similarity": pa.array(values), "priority": pa.array(priority)})
            yield from out.combine_chunks().to_batches()


def draws(ids, seed: str) -> np.ndarray:
    """60 bits of the md5 of seed and id; the exclusive or of two of them is the priority of a pair."""
    return np.array([int(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[:15], 16) for i in ids.to_pylist()], np.int64)


def _stored(columns: list[pa.Array]) -> np.ndarray:
    """The rows of vector columns without nulls as one matrix of their own type, column by column."""
    columns = [c for c in columns if len(c)]
    if not columns:
        return np.zeros((0, 0))
    parts = [stored_rows(c) for c in columns]
    out = np.empty((sum(map(len, parts)), parts[0].shape[1]), dtype=np.result_type(*{p.dtype for p in parts}))
    at = 0
    for i, part in enumerate(parts):
        out[at:at + len(part)], parts[i] = part, None
        at += len(part)
    return out


def _top_k(k: int, floor: float | None, exclude_same_id: bool, grouped: bool, lists, lead):
    lowest = -math.inf if floor is None else floor
    return lambda waiting: _Rectangle(waiting, k, lowest, exclude_same_id, grouped, lists, lead)


def _stream(make, lists=None):

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, waiting, rectangle, number, active, since = None, [], None, None, None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in (0, 1, 2)])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                here, kind, listed = (int(x) for x in keys[:, begin])
                if here != cell:
                    if rectangle is not None:
                        yield from rectangle.results()
                    cell, waiting, rectangle, number = here, [], None, None
                part = batch.slice(begin, end - begin)
                if kind == _QUERY:
                    waiting.append(part)
                    continue
                if rectangle is None:
                    if not waiting:
                        continue
                    # Queries come first in a cell: the rectangle holds them, the batches go.
                    rectangle, waiting = make(waiting), []
                if listed != number:
                    number, active = listed, rectangle.active(listed)
                    since = 0
                for start in range(0, part.num_rows if len(active) else 0, DOC_SLICE):
                    rectangle.meet(part.slice(start, DOC_SLICE), active)
                    since += 1
                    if lists and since % 16 == 0:
                        active = rectangle.active(listed)
        if rectangle is not None:
            yield from rectangle.results()

    return run


def _rectangles(q: DataFrame, d: DataFrame, cells: int, make, grouped: bool = False, lists=None, more=()) -> DataFrame:
    """Both sides carry ``_cell`` and ``list``: the rows of ``query_id, doc_id, similarity`` (and ``more``) that each rectangle keeps."""
    groups = ["query_group", "doc_group"] if grouped else []
    if lists == NEAR:
        q, d, groups = q.withColumn(NEAR, F.col("_near")), d.withColumn(NEAR, F.lit(None).cast("array<int>")), [*groups, NEAR]
    query_type, doc_type = q.schema["query_id"].dataType, d.schema["doc_id"].dataType
    none = lambda kind: F.lit(None).cast(kind)
    left = q.select("_cell", F.lit(_QUERY).alias("_kind"), "list", "query_id", none(doc_type).alias("doc_id"), F.col("query_vec").alias("vec"), "kth",
                    *(["query_group", none(d.schema["doc_group"].dataType).alias("doc_group")] if grouped else []), *([NEAR] if lists == NEAR else []))
    right = d.select("_cell", F.lit(_DOC).alias("_kind"), "list", none(query_type).alias("query_id"), "doc_id", F.col("doc_vec").alias("vec"), F.lit(None).cast("double").alias("kth"),
                     *([none(q.schema["query_group"].dataType).alias("query_group"), "doc_group"] if grouped else []), *([NEAR] if lists == NEAR else []))
    run = max(1, -(-cells // MAX_TASKS))
    both = left.unionByName(right).withColumn("_task", F.floor(F.col("_cell") / run).cast("int")).repartitionById(max(1, -(-cells // run)), "_task")
    ordered = both.sortWithinPartitions("_cell", "_kind", "list").select(F.col("_cell").cast("long"), F.col("_kind").cast("long"), F.col("list").cast("long"), "list", "query_id", "doc_id", "vec", "kth", *groups)
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("doc_id", doc_type), T.StructField("similarity", T.DoubleType()), *more])
    return ordered.toDF("_cell", "_kind", "_number", *ordered.columns[3:]).mapInArrow(_stream(make, lists), schema)


def _shape(n_queries: int, n_docs: int, dim: int, slots: int, memory: int) -> tuple[int, int]:
    """Query blocks, and parts of the docs: as few as memory allows, enough to keep every slot at work, with the fewest copies of rows."""
    rows = max(1, memory // (8 * max(dim, 1)))
    least, fewest = max(1, -(-n_queries // rows)), max(1, -(-n_docs // MAX_PART_DOCS))
    wanted = range(least, max(least, min(2 * slots, n_queries // MIN_QUERIES)) + 1)
    shapes = [(blocks, max(fewest, min(-(-2 * slots // blocks), n_docs // MIN_DOCS))) for blocks in wanted]
    # A cell for every slot comes first, then the copies: each query goes to every part, each doc to every block.
    return min(shapes, key=lambda s: (-min(s[0] * s[1], 2 * slots), s[0] * n_docs + s[1] * n_queries))


def _with_kept(dim: int, k: int) -> int:
    """The components of a query and the rows kept for it, in doubles."""
    return dim + KEPT_BYTES // 8 * k


def _laid_out(q: DataFrame, d: DataFrame, n_queries: int, n_docs: int, dim: int, memory: int) -> tuple[DataFrame, DataFrame, int]:
    """Both sides in cells of all pairs of a query block and a part of the docs, cut by id hash."""
    blocks, parts = _shape(n_queries, n_docs, dim, d.sparkSession.sparkContext.defaultParallelism, memory)
    q = q.withColumn("_block", F.pmod(F.xxhash64("query_id"), F.lit(blocks))).withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    d = d.withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(parts))).withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    cell = (F.col("_block") * parts + F.col("_part")).alias("_cell")
    return q.select("*", cell, F.lit(0).alias("list"), F.lit(None).cast("double").alias("kth")), d.select("*", cell, F.lit(0).alias("list")), blocks * parts


def plain_rectangles(q: DataFrame, d: DataFrame, k: int, floor, exclude_same_id: bool, grouped: bool, n_queries: int, n_docs: int, dim: int, memory: int = QUERY_BYTES) -> DataFrame:
    """Every pair is compared. ``q`` has ``query_id, query_vec``, ``d`` has ``doc_id, doc_vec``."""
    q, d, cells = _laid_out(packed(q, "query_vec"), packed(d, "doc_vec"), n_queries, n_docs, _with_kept(dim, k), memory)
    return _rectangles(q, d, cells, _top_k(k, floor, exclude_same_id, grouped, None, None), grouped)


def band_join(q: DataFrame, d: DataFrame, k: int, band: tuple[float, float], seed: str, memory: int = QUERY_BYTES) -> DataFrame:
    """``query_id, doc_id, similarity, priority``: of all docs with a similarity strictly inside ``band``, k for each query.

    Which k is drawn by ``priority``, the exclusive or of two md5 draws, so every doc of the band has the same chance and a rerun the
    same result. Every pair is compared; a rectangle keeps k rows per query, never the pairs. ``q`` has ``query_id, query_vec``, ``d`` has
    ``doc_id, doc_vec``, both with unique ids; rows without a vector take no part.
    """
    q, d = q.where(F.col("query_vec").isNotNull()), d.where(F.col("doc_vec").isNotNull())
    first = q.select(F.size("query_vec").alias("n")).first()
    q, d, cells = _laid_out(q, d, q.count(), d.count(), first["n"] if first else 1, memory)
    found = _rectangles(q, d, cells, lambda waiting: _BandRectangle(waiting, k, band, seed), more=[T.StructField("priority", T.LongType())])
    order = Window.partitionBy("query_id").orderBy("priority", "doc_id")
    return found.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= k).drop("_nth")


def _blocks_of_lists(sizes: dict, centroids: np.ndarray, blocks: int) -> dict:
    """First block and number of blocks for each list of queries: neighbouring lists share a block, a large list has several."""
    if not sizes:
        return {}
    rows = max(1, -(-sum(sizes.values()) // blocks))
    # Neighbours by a walk from each centroid to the nearest one not yet seen.
    left, at, order = set(sizes), min(sizes), []
    while left:
        order.append(at)
        left.remove(at)
        if left:
            rest = sorted(left)
            at = rest[int((centroids[rest] @ centroids[at]).argmax())]
    out, block, held = {}, 0, 0
    for c in order:
        if held and held + sizes[c] > rows:
            block, held = block + 1, 0
        own = max(1, -(-sizes[c] // rows)) if not held else 1
        out[c] = (block, own)
        held += sizes[c]
        if own > 1:
            block, held = block + own, 0
    return out


class _Listed:
    """Queries in blocks formed by nearness, and the docs of an index: a block meets the lists that its queries reach."""

    def __init__(self, q: DataFrame, index, k: int, floor, exclude_same_id: bool, grouped: bool, n_queries: int, dim: int, memory: int):
        spark = q.sparkSession
        self.index, self.floor, self.options = index, floor, (k, floor, exclude_same_id, grouped)
        blocks, self.parts = _shape(n_queries, sum(index.sizes.values()), _with_kept(dim, k), spark.sparkContext.defaultParallelism, memory)
        sizes = {r["_list"]: r["n"] for r in q.groupBy("_list").agg(F.count("*").alias("n")).collect()}
        self.placed = _blocks_of_lists(sizes, index.centroids, blocks)
        self.blocks = max((b + n for b, n in self.placed.values()), default=1)
        table = F.broadcast(spark.createDataFrame([(c, b, n) for c, (b, n) in sorted(self.placed.items())], "_list int, _first int, _own int"))
        self.queries = stage(q.join(table, "_list").withColumn("_block", (F.col("_first") + F.pmod(F.xxhash64("query_id"), "_own")).cast("int")).drop("_first", "_own"), "query-blocks")

    def search(self, asked: DataFrame, reach: dict, lists, lead=None) -> DataFrame:
        """``asked`` has ``kth``, ``reach`` the blocks that each list is sent to."""
        wanted = asked.sparkSession.createDataFrame([(c, b) for c, b in sorted(reach.items())], "_list int, _blocks array<int>")
        cell = (F.col("_block") * self.parts + F.col("_part")).alias("_cell")
        d = packed(self.index.docs.join(F.broadcast(wanted), "_list"), "doc_vec")
        d = d.withColumn("_block", F.explode("_blocks")).drop("_blocks").withColumn("_part", F.pmod(F.xxhash64("doc_id"), F.lit(self.parts)))
        asked = packed(asked, "query_vec").withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(self.parts - 1))))
        grouped = self.options[-1]
        return _rectangles(asked.select("*", cell, F.col("_list").alias("list")), d.select("*", cell, F.col("_list").alias("list")), self.blocks * self.parts,
                           _top_k(*self.options, lists, lead), grouped, lists)

    @staticmethod
    def reach(pairs: DataFrame) -> dict:
        """The blocks of each list from ``block, list``, of which there are at most as many as cells."""
        out: dict = {}
        for r in pairs.distinct().collect():
            out.setdefault(r["list"], []).append(r["block"])
        return out


def probed_rectangles(q: DataFrame, index, k: int, floor, exclude_same_id: bool, grouped: bool, n_queries: int, dim: int, memory: int = QUERY_BYTES) -> DataFrame:
    """Every query meets the docs of the lists in ``_near``; ``q`` has ``_list`` (nearest centroid) and ``_near`` (so many for each query)."""
    laid = _Listed(q, index, k, floor, exclude_same_id, grouped, n_queries, dim, memory)
    reach = laid.reach(laid.queries.select(F.col("_block").alias("block"), F.explode("_near").alias("list")))
    return laid.search(laid.queries.withColumn("kth", F.lit(None).cast("double")), {c: b for c, b in reach.items() if c in index.sizes}, NEAR)


def pruned_rectangles(q: DataFrame, index, k: int, floor, exclude_same_id: bool, grouped: bool, n_queries: int, dim: int, memory: int = QUERY_BYTES, use_lead: bool = True) -> tuple[DataFrame, BlockReport]:
    """The same rows from the cells that can hold a result; ``q`` has ``_list`` (nearest centroid), ``index`` the docs by list."""
    laid = _Listed(q, index, k, floor, exclude_same_id, grouped, n_queries, dim, memory)
    n_docs, blocks, parts, placed = sum(index.sizes.values()), laid.blocks, laid.parts, laid.placed
    radius = np.full(len(index.centroids), -np.inf)
    for c, r in index.radius.items():
        radius[c] = r
    lead = rotation(index.docs, "doc_vec", dim) if use_lead and n_docs else None

    own = {c: list(range(b, b + n)) for c, (b, n) in placed.items() if c in index.sizes}
    first = stage(laid.search(laid.queries.withColumn("kth", F.lit(None).cast("double")), own, (index.centroids, radius, True), lead), "own-lists")
    # The rows of a query lie in several parts, so its k-th best is known only over all of them.
    bounded = stage(laid.queries.join(_kth(first, k), "query_id", "left"), "bounded-queries")
    lowest, centroids = -2.0 if floor is None else floor, index.centroids

    def reached(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((blocks, len(centroids)), bool)
        for batch in batches:
            m = as_matrix(batch.column(0))
            if not len(m):
                continue
            length = row_lengths(m)
            cos = (m / np.where(length > 0, length, 1)[:, None]) @ centroids.T
            bound = np.cos(np.maximum(0.0, np.arccos(np.clip(cos, -1, 1)) - radius[None, :])) + SLACK
            least = np.maximum(batch.column(1).fill_null(lowest).to_numpy(zero_copy_only=False), lowest)
            hits = (bound >= least[:, None]) & (length > 0)[:, None] & np.isfinite(radius)[None, :]
            hits[np.arange(len(m)), batch.column(3).to_numpy()] = False
            rows, lists = np.nonzero(hits)
            seen[batch.column(2).to_numpy()[rows], lists] = True
        pairs = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)) for p in pairs], names=["block", "list"])

    reach = laid.reach(bounded.select("query_vec", "kth", "_block", "_list").mapInArrow(reached, "block int, list int"))
    searched = sum(len(b) for b in reach.values())
    copies = sum(index.sizes[c] * len(b) for c, b in reach.items()) + sum(index.sizes[c] * len(b) for c, b in own.items())
    report = BlockReport(blocks, parts, len(index.sizes), blocks * len(index.sizes), len({(b, c) for c, bs in reach.items() for b in bs} | {(b, c) for c, bs in own.items() for b in bs}),
                         copies / max(n_docs, 1), 2 * parts)
    second = laid.search(bounded, reach, (index.centroids, radius, False), lead) if searched else first.limit(0)
    return first.unionByName(second), report


def _kth(found: DataFrame, k: int) -> DataFrame:
    """The k-th best similarity of each query that has so many, from the k best of every part."""
    best = F.slice(F.sort_array(F.collect_list("similarity"), asc=False), k, 1)
    return found.groupBy("query_id").agg(F.try_element_at(best, F.lit(1)).alias("kth"))
