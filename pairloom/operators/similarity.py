"""Top-k similarity join: exact on a grid of blocks, exact with pruning, or approximate with probes."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from pairloom.functions.hashing import draw
from pairloom.functions.vectors import as_matrix, row_lengths
from pairloom.operators.blocks import QUERY_BYTES, BlockReport, _with_kept, plain_rectangles, probed_rectangles, pruned_rectangles
from pairloom.operators.kernels import _banned_pairs, _cosines, _first_k, _keep_first_k, _round  # noqa: F401
from pairloom.session import stage

QUERY_SLICE = 512        # query rows multiplied at a time inside a cell
SCAN_QUERIES = 256       # up to this many queries are sent to the docs instead of shuffling the docs
SCAN_SLICE = 2048        # doc rows multiplied at a time in a scan
MAX_CELL_TASKS = 20_000
COPIED_SHARE = 0.8       # below this share of distinct vectors, copies are compared once
COPIED_PAIRS = 10 ** 9   # with fewer pairs to compare, looking for copies costs more than it saves
MAX_CENTROIDS = 4096


# ---------------------------------------------------------------- kernels (run inside tasks)

def _cell_kernel(k: int, floor: float, exclude_same_id: bool, grouped: bool):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", left.schema.field("query_id").type),
                            ("doc_id", right.schema.field("doc_id").type), ("similarity", pa.float64())])
        if left.num_rows == 0 or right.num_rows == 0:
            return schema.empty_table()
        # Columns in id order, so that the first k by column number are the first k by id on ties.
        right = right.take(pc.sort_indices(right["doc_id"]))
        q, d = as_matrix(left["query_vec"]), as_matrix(right["doc_vec"])
        qn, dn = row_lengths(q), row_lengths(d)
        banned = _banned_pairs(left, right, exclude_same_id, grouped)
        q_rows, d_rows, values = [], [], []
        for start in range(0, len(q), QUERY_SLICE):
            part = slice(start, start + QUERY_SLICE)
            sims = _cosines(q[part], qn[part], d, dn)
            for mask in banned(part):
                sims[mask] = -np.inf
            sims[sims < floor] = -np.inf
            rows, cols = _first_k(sims, k)
            q_rows.append(rows + start)
            d_rows.append(cols)
            values.append(sims[rows, cols])
        return pa.table([
            left["query_id"].combine_chunks().take(pa.array(np.concatenate(q_rows))),
            right["doc_id"].combine_chunks().take(pa.array(np.concatenate(d_rows))),
            pa.array(np.concatenate(values)),
        ], schema=schema)

    return run


# ---------------------------------------------------------------- sides

def _side(df: DataFrame, role: str, id_col: str, vec_col: str, group_col: str | None) -> DataFrame:
    cols = [F.col(id_col).alias(f"{role}_id"), F.col(vec_col).alias(f"{role}_vec")]
    if group_col:
        cols.append(F.col(group_col).alias(f"{role}_group"))
    return df.select(*cols).where(F.col(f"{role}_vec").isNotNull())


def _rank(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "doc_id")
    return (
        pairs.withColumn("_nth", F.row_number().over(order))
        .where(F.col("_nth") <= k)
        .select("query_id", "doc_id", "similarity", (F.col("_nth") - 1).cast("bigint").alias("rank"))
    )


# ---------------------------------------------------------------- copies of one vector

def _copy_key(vec: str) -> Column:
    """128 bits that the copies of a vector share."""
    return F.concat_ws("-", F.hex(F.xxhash64(vec)), F.hex(F.xxhash64(F.lit(1), vec)))


def _has_copies(side: DataFrame, vec: str) -> bool:
    """Whether many rows of a side repeat the vector of another: one pass, partial sketches only."""
    row = side.agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64(vec)).alias("d")).first()
    return row["d"] < COPIED_SHARE * row["n"]


def _first_copies(docs: DataFrame, keep: int, grouped: bool) -> DataFrame:
    """Of docs with the same vector (and group), the ``keep`` smallest ids: no other can be in a top ``keep``.

    Each task keeps that many per vector before the shuffle, so copies never gather anywhere.
    """
    keyed = docs.withColumn("_copy", _copy_key("doc_vec"))
    order = Window.partitionBy("_copy", *(["doc_group"] if grouped else [])).orderBy("doc_id")
    first = keyed.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= keep)
    return first.drop("_copy", "_nth")


def _search(queries: DataFrame, n_docs: int, k: int, exclude_same_id: bool, grouped: bool, collapse: bool | None,
            run) -> DataFrame:
    """Rank what ``run(queries, k, exclude_same_id)`` finds; queries with the same vector are searched once.

    One row then stands for all copies and asks for one result more, since each copy leaves out its own id.
    """
    if collapse is None:
        collapse = queries.count() * n_docs > COPIED_PAIRS and _has_copies(queries, "query_vec")
    if not collapse:
        return _rank(run(queries, k, exclude_same_id), k)
    wanted = k + 1 if exclude_same_id else k
    same = [_copy_key("query_vec"), *([F.col("query_group").cast("string")] if grouped else [])]
    members = queries.withColumn("_rep", F.concat_ws(":", *same))
    kept = [F.any_value(c).alias(c) for c in ("query_vec", *(["query_group"] if grouped else []))]
    reps = stage(members.groupBy("_rep").agg(*kept).withColumnRenamed("_rep", "query_id"), "distinct-queries")
    found = _rank(run(reps, wanted, False), wanted).select(
        F.col("query_id").alias("_rep"), "doc_id", "similarity")
    each = members.select("query_id", "_rep").join(found, "_rep")
    if exclude_same_id:
        each = each.where(F.col("query_id") != F.col("doc_id"))
    return _rank(each, k)


def _run_cells(queries: DataFrame, docs: DataFrame, k: int, floor: float | None, exclude_same_id: bool,
               grouped: bool, cells: int) -> DataFrame:
    """Both sides carry ``_cell``, a number below ``cells``: one matrix product that keeps k rows per query.

    A task takes one cell, or with very many cells a run of neighbours, which mostly belong to the same
    queries, so that ranking can drop rows before the next shuffle.
    """
    fields = [T.StructField("query_id", queries.schema["query_id"].dataType),
              T.StructField("doc_id", docs.schema["doc_id"].dataType),
              T.StructField("similarity", T.DoubleType())]
    kernel = _cell_kernel(k, -math.inf if floor is None else floor, exclude_same_id, grouped)
    run = max(1, -(-cells // MAX_CELL_TASKS))
    tasks = max(1, -(-cells // run))

    def placed(side: DataFrame):
        numbered = side.withColumn("_task", F.floor(F.col("_cell") / run).cast("int"))
        return numbered.repartitionById(tasks, "_task").groupBy("_task", "_cell")

    return placed(queries).cogroup(placed(docs)).applyInArrow(kernel, T.StructType(fields))


def _grid(queries: DataFrame, docs: DataFrame, k: int, floor: float | None, exclude_same_id: bool, grouped: bool,
          n_queries: int, n_docs: int, block: int) -> DataFrame:
    q_blocks, d_blocks = max(1, -(-n_queries // block)), max(1, -(-n_docs // block))
    q = (
        queries.withColumn("_qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)))
        .withColumn("_db", F.explode(F.sequence(F.lit(0), F.lit(d_blocks - 1))))
        .withColumn("_cell", F.col("_qb") * d_blocks + F.col("_db"))
    )
    d = (
        docs.withColumn("_db", F.pmod(F.xxhash64("doc_id"), F.lit(d_blocks)))
        .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
        .withColumn("_cell", F.col("_qb") * d_blocks + F.col("_db"))
    )
    return _run_cells(q.drop("_qb", "_db"), d.drop("_qb", "_db"), k, floor, exclude_same_id, grouped,
                      q_blocks * d_blocks)


def _scan(queries: pa.Table, id_type: T.DataType, docs: DataFrame, k: int, floor: float | None,
          exclude_same_id: bool, grouped: bool) -> DataFrame:
    """A bounded query table goes to every doc partition; each keeps k rows per query, docs stay in place."""
    schema = T.StructType([T.StructField("query_id", id_type), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("similarity", T.DoubleType())])
    lowest = -math.inf if floor is None else floor

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = as_matrix(queries["query_vec"])
        qn = row_lengths(q)
        held: pa.Table | None = None
        for batch in batches:
            for start in range(0, batch.num_rows if queries.num_rows else 0, SCAN_SLICE):
                part = pa.Table.from_batches([batch.slice(start, SCAN_SLICE)])
                part = part.take(pc.sort_indices(part["doc_id"]))
                d = as_matrix(part["doc_vec"])
                sims = _cosines(q, qn, d, row_lengths(d))
                for mask in _banned_pairs(queries, part, exclude_same_id, grouped)(slice(None)):
                    sims[mask] = -np.inf
                sims[sims < lowest] = -np.inf
                rows, cols = _first_k(sims, k)
                found = pa.table({"q": pa.array(rows), "similarity": pa.array(sims[rows, cols]),
                                  "doc_id": part["doc_id"].take(pa.array(cols))})
                held = found if held is None else _keep_first_k(pa.concat_tables([held, found]), k)
        if held is not None and held.num_rows:
            ids = queries["query_id"].take(held["q"])
            out = pa.table({"query_id": ids, "doc_id": held["doc_id"], "similarity": held["similarity"]})
            yield from out.combine_chunks().to_batches()

    return docs.mapInArrow(scan, schema)


def _dimensions(queries: DataFrame) -> int:
    row = queries.select(F.size("query_vec").alias("n")).first()
    return row["n"] if row else 1


def topk_join(queries: DataFrame, docs: DataFrame, k: int, *, query_id: str, query_vec: str, doc_id: str,
              doc_vec: str, floor: float | None = None, exclude_same_id: bool = True,
              query_group: str | None = None, doc_group: str | None = None, block: int | None = None,
              scan_queries: int = SCAN_QUERIES, collapse: bool | None = None, memory: int = QUERY_BYTES) -> DataFrame:
    """The k most similar docs of every query: ``query_id, doc_id, similarity, rank`` with rank from 0.

    Exact. At most ``scan_queries`` queries are sent to the docs, which then need no shuffle. Beyond that,
    a task holds a block of queries of ``memory`` bytes and docs stream past it (``blocks``); with ``block`` both sides are
    cut by id hash into square blocks of so many rows instead. Either way no task grows with the data, whatever it looks like,
    and a task keeps k rows per query, never the pairs. Similarities are rounded to six decimals before ranking; ties go to the smaller doc id. Rows
    below ``floor``, zero vectors, the query's own id and, with groups, its own group are left out.
    ``collapse`` compares copies of a vector once, which changes no result; by default where there are many
    copies and many pairs to compare.
    Inputs are counted, then read: pass stored or staged tables.
    """
    q = _side(queries, "query", query_id, query_vec, query_group)
    d = _side(docs, "doc", doc_id, doc_vec, doc_group)
    grouped = query_group is not None and doc_group is not None
    n_queries = queries.count()
    if n_queries <= scan_queries:
        return _rank(_scan(q.toArrow(), q.schema["query_id"].dataType, d, k, floor, exclude_same_id, grouped), k)
    n_docs = docs.count()
    big = n_queries * n_docs > COPIED_PAIRS
    if (big and _has_copies(d, "doc_vec")) if collapse is None else collapse:
        d = stage(_first_copies(d, k + 1 if exclude_same_id else k, grouped), "distinct-docs")
        n_docs = d.count()

    def run(asked: DataFrame, wanted: int, exclude: bool) -> DataFrame:
        n_asked = n_queries if asked is q else asked.count()
        if block:
            return _grid(asked, d, wanted, floor, exclude, grouped, n_asked, n_docs, block)
        return plain_rectangles(asked, d, wanted, floor, exclude, grouped, n_asked, n_docs, _dimensions(asked), memory)

    return _search(q, n_docs, k, exclude_same_id, grouped, collapse, run)


# ---------------------------------------------------------------- centroid lists

@dataclass(frozen=True)
class VectorIndex:
    """Docs assigned to their nearest centroid (``_list``), with the size and angular radius of each list.

    With ``keep_copies``, only that many docs of equal vector and group are held.
    """

    docs: DataFrame
    centroids: np.ndarray = field(repr=False)
    sizes: dict = field(repr=False)
    radius: dict = field(repr=False)
    keep_copies: int | None = None

    def check(self, k: int, exclude_same_id: bool) -> None:
        """A search may ask for no more results than copies are held, or it would miss some."""
        wanted = k + 1 if exclude_same_id else k
        if self.keep_copies is not None and wanted > self.keep_copies:
            raise ValueError(f"the index keeps {self.keep_copies} copies of a vector, this search needs {wanted}")


def _unit(matrix: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(length == 0, 1, length)


def train_centroids(docs: DataFrame, id_col: str, vec_col: str, lists: int, seed: int = 42, iterations: int = 10,
                    sample_per_list: int | None = None, max_lists: int = MAX_CENTROIDS) -> np.ndarray:
    """Unit centroids from distributed k-means (cosine) on all rows.

    ``sample_per_list`` fits on a hash-drawn sample of about that many rows per list instead. It only places the
    centroids; every row is assigned to a list and searched. ``max_lists`` bounds the matrix sent to the tasks.
    """
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    if not 1 <= lists <= max_lists:
        raise ValueError(f"lists must be between 1 and {max_lists}")
    usable = docs.where(F.col(vec_col).isNotNull() & F.exists(vec_col, lambda x: x != 0))
    if sample_per_list is not None:
        share = min(1.0, lists * sample_per_list / max(usable.count(), 1))
        usable = usable.where(draw(seed, F.col(id_col)) < int(share * 2 ** 32))
    vectors = stage(usable.select(array_to_vector(F.col(vec_col).cast("array<double>")).alias("features")), "kmeans")
    model = KMeans(k=lists, seed=seed, maxIter=iterations, distanceMeasure="cosine").fit(vectors)
    return _unit(np.array(model.clusterCenters()))


def build_index(docs: DataFrame, doc_id: str, doc_vec: str, lists: int, seed: int = 42,
                group_col: str | None = None, keep_copies: int | None = None) -> VectorIndex:
    """Train centroids and assign every doc to its nearest one."""
    centroids = train_centroids(docs, doc_id, doc_vec, lists, seed)
    return assign_to_lists(docs, doc_id, doc_vec, centroids, group_col, keep_copies)


def assign_to_lists(docs: DataFrame, doc_id: str, doc_vec: str, centroids: np.ndarray,
                    group_col: str | None = None, keep_copies: int | None = None) -> VectorIndex:
    side = _side(docs, "doc", doc_id, doc_vec, group_col)
    if keep_copies is not None:
        side = _first_copies(side, keep_copies, group_col is not None)
    schema = T.StructType([*side.schema.fields, T.StructField("_list", T.IntegerType()),
                           T.StructField("_angle", T.DoubleType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = as_matrix(batch.column(batch.schema.get_field_index("doc_vec")))
            if not len(matrix):
                continue
            length = row_lengths(matrix)
            batch = batch.filter(pa.array(length > 0))
            cos = (matrix[length > 0] / length[length > 0][:, None]) @ centroids.T
            best = cos.argmax(axis=1) if len(cos) else np.zeros(0, int)
            angle = np.arccos(np.clip(cos[np.arange(len(cos)), best], -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(best.astype(np.int32)), pa.array(angle)],
                                             names=[*batch.schema.names, "_list", "_angle"])

    assigned = stage(side.mapInArrow(assign, schema), "lists")
    stats = assigned.groupBy("_list").agg(F.count("*").alias("n"), F.max("_angle").alias("r")).collect()
    return VectorIndex(assigned.drop("_angle"), centroids, {s["_list"]: s["n"] for s in stats},
                       {s["_list"]: s["r"] for s in stats}, keep_copies)


def extend_index(index: VectorIndex, docs: DataFrame, doc_id: str, doc_vec: str, group_col: str | None = None, max_list: int | None = None,
                 seed: int = 42) -> VectorIndex:
    """The index with new and changed docs (one row per id) in place of what it held of these ids; nothing is trained again.

    Only ``docs`` are assigned, to the centroids there are. The radius of a list widens to its farthest new doc, so its bound stays
    valid and exact searches stay exact. A list of more than ``max_list`` docs is split in two by a 2-means of its own docs, the only ones
    that are assigned again; a list of equal vectors stays whole. A doc that has lost its vector leaves the index.
    """
    if index.keep_copies is not None:
        raise ValueError("an index that keeps few copies cannot tell which of them a change concerns")
    fresh = assign_to_lists(docs, doc_id, doc_vec, index.centroids, group_col)
    left = index.docs.join(docs.select(F.col(doc_id).alias("doc_id")), "doc_id", "left_anti").select(*index.docs.columns)
    merged = stage(left.unionByName(fresh.docs), "lists")
    sizes = {r["_list"]: r["n"] for r in merged.groupBy("_list").agg(F.count("*").alias("n")).collect()}
    radius = {c: max(index.radius.get(c, 0.0), fresh.radius.get(c, 0.0)) for c in sizes}
    out, whole = VectorIndex(merged, index.centroids, sizes, radius), set()
    while max_list and (big := sorted(c for c, n in out.sizes.items() if n > max_list and c not in whole)):
        out = _split_lists(out, big, whole, seed)
    return out


def _split_lists(index: VectorIndex, big: list, whole: set, seed: int) -> VectorIndex:
    """Each list of ``big`` in two, the second under a new number; lists that have one direction only join ``whole``."""
    centroids, halves = index.centroids, {}
    for c in big:
        two = train_centroids(index.docs.where(F.col("_list") == c), "doc_id", "doc_vec", 2, seed)
        if len(two) < 2 or np.allclose(two[0], two[1]):
            whole.add(c)
            continue
        halves[c] = len(centroids)
        centroids = np.concatenate([centroids, two[1:]])
        centroids[c] = two[0]
    if not halves:
        return index
    new, place = centroids, index.docs.columns.index("_list")
    schema = T.StructType([*index.docs.schema.fields, T.StructField("_angle", T.DoubleType())])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(place).to_numpy().copy()
            angle = np.full(len(lists), -1.0)
            rows = np.flatnonzero(np.isin(lists, list(halves)))
            if len(rows):
                unit = _unit(as_matrix(batch.column(batch.schema.get_field_index("doc_vec")).take(pa.array(rows))))
                first, second = lists[rows], np.array([halves[c] for c in lists[rows]])
                a, b = (unit * new[first]).sum(axis=1), (unit * new[second]).sum(axis=1)
                lists[rows] = np.where(b > a, second, first)
                angle[rows] = np.arccos(np.clip(np.maximum(a, b), -1, 1))
            columns = [pa.array(lists) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(angle)], names=[*batch.schema.names, "_angle"])

    split = stage(index.docs.mapInArrow(again, schema), "lists")
    stats = split.groupBy("_list").agg(F.count("*").alias("n"), F.max("_angle").alias("r")).collect()
    radius = {s["_list"]: s["r"] if s["r"] >= 0 else index.radius[s["_list"]] for s in stats}
    sizes = {s["_list"]: s["n"] for s in stats}
    for c, other in halves.items():
        if not (sizes.get(c) and sizes.get(other)):
            whole |= {c, other}
    return VectorIndex(split.drop("_angle"), centroids, sizes, radius)


def _route(queries: DataFrame, index: VectorIndex, choose) -> DataFrame:
    """One row per query and list that ``choose(cosines, bounds)`` selects."""
    centroids = index.centroids
    schema = T.StructType([*[f for f in queries.schema.fields if not f.name.startswith("_")],
                           T.StructField("_list", T.IntegerType())])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = as_matrix(batch.column(batch.schema.get_field_index("query_vec")))
            if not len(matrix):
                continue
            length = row_lengths(matrix)
            cos = (matrix / np.where(length == 0, 1, length)[:, None]) @ centroids.T
            wanted = choose(cos, batch) & (length > 0)[:, None]
            rows, lists = np.nonzero(wanted)
            kept = batch.select([n for n in batch.schema.names if not n.startswith("_")]).take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(lists.astype(np.int32))],
                                             names=[*kept.schema.names, "_list"])

    return queries.mapInArrow(route, schema)


def _nearest_lists(nprobe: int):
    def choose(cos: np.ndarray, batch: pa.RecordBatch) -> np.ndarray:
        order = np.argsort(-cos, axis=1, kind="stable")[:, :nprobe]
        wanted = np.zeros(cos.shape, dtype=bool)
        wanted[np.arange(len(cos))[:, None], order] = True
        return wanted

    return choose


def probe_topk(queries: DataFrame, index: VectorIndex, k: int, nprobe: int, *, query_id: str, query_vec: str,
               floor: float | None = None, exclude_same_id: bool = True, query_group: str | None = None,
               block: int | None = None, collapse: bool | None = None) -> DataFrame:
    """Approximate top-k: every query searches its ``nprobe`` nearest lists. With all lists it is exact.

    Queries move as blocks, as in ``block_topk`` (``block`` queries at most, by default as many as memory allows), not once per list.
    """
    index.check(k, exclude_same_id)
    grouped, dim, centroids = query_group is not None, index.centroids.shape[1], index.centroids

    def run(asked: DataFrame, wanted: int, exclude: bool) -> DataFrame:
        schema = T.StructType([*asked.schema.fields, T.StructField("_list", T.IntegerType()), T.StructField("_near", T.ArrayType(T.IntegerType()))])

        def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                matrix = as_matrix(batch.column(batch.schema.get_field_index("query_vec")))
                if not len(matrix):
                    continue
                length = row_lengths(matrix)
                batch, cos = batch.filter(pa.array(length > 0)), (matrix[length > 0] / length[length > 0][:, None]) @ centroids.T
                near = np.argsort(-cos, axis=1, kind="stable")[:, :nprobe].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1, dtype=np.int32) * near.shape[1]), pa.array(near.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(near[:, 0].copy()), lists], names=[*batch.schema.names, "_list", "_near"])

        routed = stage(asked.mapInArrow(nearest, schema), "nearest")
        return probed_rectangles(routed, index, wanted, floor, exclude, grouped, routed.count(), dim, _block_bytes(block, dim, wanted))

    q = _side(queries, "query", query_id, query_vec, query_group)
    return _search(q, sum(index.sizes.values()), k, exclude_same_id, grouped, collapse, run)


def pruned_topk(queries: DataFrame, index: VectorIndex, k: int, *, query_id: str, query_vec: str,
                floor: float | None = None, exclude_same_id: bool = True, query_group: str | None = None,
                block: int | None = None, collapse: bool | None = None) -> DataFrame:
    """Exact top-k that skips lists which cannot hold a result.

    First every query searches its nearest list, which gives a lower bound for its k-th similarity. A doc
    of a list lies within the list's angular radius of the centroid, so by the triangle inequality on
    angles its cosine is at most ``cos(max(0, angle(query, centroid) - radius))``; only lists whose bound
    reaches the query's lower bound (or the floor) are searched in the second pass. Queries move as blocks, as in
    ``block_topk`` (``block`` queries at most, by default as many as memory allows), not once per list they reach.
    """
    index.check(k, exclude_same_id)
    grouped, dim = query_group is not None, index.centroids.shape[1]

    def run(asked: DataFrame, wanted: int, exclude: bool) -> DataFrame:
        # The list each query searches first is stored with it, so that the second pass leaves out exactly that.
        routed = stage(_route(asked, index, _nearest_lists(1)), "nearest")
        return pruned_rectangles(routed, index, wanted, floor, exclude, grouped, routed.count(), dim, _block_bytes(block, dim, wanted), False)[0]

    q = _side(queries, "query", query_id, query_vec, query_group)
    return _search(q, sum(index.sizes.values()), k, exclude_same_id, grouped, collapse, run)


def _block_bytes(block: int | None, dim: int, k: int) -> int:
    return QUERY_BYTES if block is None else 8 * block * _with_kept(dim, k)


def block_topk(queries: DataFrame, index: VectorIndex, k: int, *, query_id: str, query_vec: str, floor: float | None = None,
               exclude_same_id: bool = True, query_group: str | None = None, memory: int = QUERY_BYTES, use_lead: bool = True,
               collapse: bool | None = None) -> tuple[DataFrame, BlockReport]:
    """Exact top-k in rectangles formed by nearness, and a report of the cells that were skipped.

    As ``pruned_topk`` every query is bounded by its own list first, but queries move as blocks, not once per list they reach.
    """
    index.check(k, exclude_same_id)
    report: list[BlockReport] = []

    def run(asked: DataFrame, wanted: int, exclude: bool) -> DataFrame:
        routed = stage(_route(asked, index, _nearest_lists(1)), "nearest")
        found, done = pruned_rectangles(routed, index, wanted, floor, exclude, query_group is not None, routed.count(), index.centroids.shape[1], memory, use_lead)
        report.append(done)
        return found

    q = _side(queries, "query", query_id, query_vec, query_group)
    out = _search(q, sum(index.sizes.values()), k, exclude_same_id, query_group is not None, collapse, run)
    return out, report[0]
