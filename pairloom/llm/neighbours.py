"""Nearest neighbours by largest inner product with a forest of random-projection trees.

Fit: at most ``sample`` vectors, drawn by a hash of the id, reach the driver. Each tree splits its nodes at the median
along the difference of two of them, down to about ``leaves`` leaves. Every row of the table is then
indexed: it goes to its leaf in each tree. Norms may differ: a component is added that makes all indexed vectors
equally long, so that the largest inner product is the smallest angle.

Search: one priority queue over all trees serves a query. Nodes come out by how far the query lies on their wrong
sides (sum of squared margins), and leaves are taken until they hold ``share`` of all rows. Their rows are scored
exactly in double precision. The fitting sample gives each query a score that its result has to reach, so that
cells return few rows. A cell is a slice of at most ``CELL`` rows of a leaf and a slice of the queries.

Of equal vectors only the ``k + 1`` smallest distinct ids can be in a result, and only they are indexed. Vectors that are null or
zero, hold null or non-finite components, or have another length than most take no part. A repeated id
counts once. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from pairloom.llm.common import Scratch

TREES, LEAVES, SAMPLE, SHARE, CELL = 4, 64, 8192, 0.74, 4096
SLACK = 1e-4


class Forest:
    """Per tree: hyperplanes and thresholds in heap order, and the leaf number of every node without children."""

    def __init__(self, points: np.ndarray, trees: int = TREES, leaves: int = LEAVES, seed: int = 5):
        least = max(4, len(points) // leaves)
        self.trees = []
        for t in range(trees):
            draw = np.random.default_rng([seed, t])
            planes, cuts, kids, ends = [], [], [], []

            def grow(rows: np.ndarray) -> int:
                node = len(planes)
                planes.append(np.zeros(points.shape[1], np.float32))
                cuts.append(0.0)
                kids.append((-1, -1))
                ends.append(-1)
                for _ in range(3 if len(rows) > least else 0):
                    a, b = draw.choice(len(rows), 2, replace=False)
                    plane = points[rows[a]] - points[rows[b]]
                    size = float(np.linalg.norm(plane))
                    if size < 1e-6:
                        continue
                    plane = plane / size
                    along = points[rows] @ plane
                    cut = float(np.median(along))
                    right = along > cut
                    if right.any() and not right.all():
                        planes[node], cuts[node] = plane.astype(np.float32), cut
                        kids[node] = (grow(rows[~right]), grow(rows[right]))
                        return node
                ends[node] = sum(x >= 0 for x in ends)
                return node

            if len(points):
                grow(np.arange(len(points)))
            self.trees.append((np.array(planes, np.float32), np.array(cuts, np.float32), np.array(kids), np.array(ends)))

    def leaves_of(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point in each tree."""
        out = np.zeros((len(points), len(self.trees)), np.int32)
        for t, (planes, cuts, kids, leaves) in enumerate(self.trees):
            node = np.zeros(len(points), np.int64)
            while True:
                inner = np.flatnonzero(kids[node, 0] >= 0)
                if not len(inner):
                    break
                at = node[inner]
                side = np.einsum("ij,ij->i", points[inner], planes[at]) > cuts[at]
                node[inner] = kids[at, side.astype(np.int64)]
            out[:, t] = leaves[node]
        return out

    def search(self, point: np.ndarray, counts: dict, rows: float) -> list[tuple[int, int]]:
        """(tree, leaf) in the order of the shared queue, until they hold ``rows`` rows."""
        margins = [planes @ point - cuts for planes, cuts, *_ in self.trees]
        queue = [(0.0, t, 0) for t in range(len(self.trees))]
        out, held = [], 0.0
        while queue and held < rows:
            cost, t, node = heapq.heappop(queue)
            _, _, kids, leaves = self.trees[t]
            if kids[node, 0] < 0:
                out.append((t, int(leaves[node])))
                held += counts.get((t, int(leaves[node])), 0)
                continue
            margin = float(margins[t][node])
            near = int(margin > 0)
            heapq.heappush(queue, (cost, t, int(kids[node, near])))
            heapq.heappush(queue, (cost + margin * margin, t, int(kids[node, 1 - near])))
        return out


def _vectors(column) -> np.ndarray:
    data = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(data)
    return data.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1) if n else np.zeros((0, 0))


def _levelled(x: np.ndarray, longest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(0.0, longest * longest - np.einsum("ij,ij->i", x, x)))
    return (np.column_stack([x, rest]) / longest).astype(np.float32)


def _aimed(x: np.ndarray) -> np.ndarray:
    return (np.column_stack([x, np.zeros(len(x))]) / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vec`` (double) of the vectors that take part."""
    vec = F.col("vec")
    rows = rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec")).filter("vec_id is not null and size(vec) > 0")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.coalesce(finite, F.lit(False)) & F.exists(vec, lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.filter(F.size("vec") == (sizes[0]["d"] if sizes else 0))


def nearest(rows: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
            leaves: int = LEAVES, sample: int = SAMPLE, share: float = SHARE) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best found for each row where ``is_query`` (on ``vec_id``) holds."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "neighbours")
    table = scratch.stage(usable(rows, id_col, vector_col), "vectors")
    seen = table.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).alias("longest"), F.count_if(is_query).alias("q")).first()
    if not seen["n"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n, longest = seen["n"], float(seen["longest"]) * (1 + 1e-9)

    # Each task passes on at most k + 1 rows of one vector, so copies of a vector never meet in one place.
    copies = W.partitionBy("vec").orderBy("vec_id")
    # Repeated rows go first, or they would take the places of other ids.
    index = table.dropDuplicates(["vec_id", "vec"]).withColumn("place", F.row_number().over(copies)).filter(F.col("place") <= k + 1).select("vec_id", "vec")
    index = scratch.stage(index, "index")
    kept = index.count()
    draw = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30))
    drawn = index.filter(draw < min(1 << 30, (1 << 30) * 3 * sample // (2 * kept) + 1)).orderBy(draw, "vec_id").limit(sample).collect()
    sample_ids = np.array([r["vec_id"] for r in drawn], np.int64)
    points = np.array([r["vec"] for r in drawn], np.float64)
    forest = Forest(_levelled(points, longest), trees, leaves)
    sent = spark.sparkContext.broadcast((forest, sample_ids, points, longest))
    # So many rows over all trees hold k others even when the trees agree.
    wanted = max(kept * share * _reach(trees, share), 3 * trees * (k + 1))

    def place(batches):
        forest, _, _, longest = sent.value
        for batch in batches:
            x = _vectors(batch.column(1))
            if not len(x):
                continue
            leaves = forest.leaves_of(_levelled(x, longest))
            who = np.repeat(np.arange(len(x)), leaves.shape[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(leaves.shape[1], dtype=np.int32), len(x))), pa.array(leaves.ravel()),
                 batch.column(0).take(pa.array(who)), pa.array([v.tobytes() for v in x], pa.binary()).take(pa.array(who))], ["tree", "leaf", "vec_id", "vec"])

    members = scratch.stage(index.mapInArrow(place, "tree int, leaf int, vec_id long, vec binary"), "members")
    counts = {(r["tree"], r["leaf"]): r["count"] for r in members.groupBy("tree", "leaf").count().collect()}
    slices = {key: math.ceil(c / CELL) for key, c in counts.items()}
    query_slices = max(1, math.ceil(seen["q"] / CELL))
    sent_counts = spark.sparkContext.broadcast((counts, slices, forest.leaves_of(_levelled(points, longest))))

    def route(batches):
        forest, ids, points, _ = sent.value
        counts, slices, sample_leaves = sent_counts.value
        for batch in batches:
            x = _vectors(batch.column(1))
            if not len(x):
                continue
            aimed, own = _aimed(x), batch.column(0).to_numpy()
            against = x @ points.T
            against[own[:, None] == ids[None, :]] = -np.inf
            out = []
            for i in range(len(x)):
                vec = x[i].tobytes()
                taken = forest.search(aimed[i], counts, wanted)
                # The k-th best of the sample vectors in these leaves, all of which will be scored, bounds the result.
                inside = np.zeros(len(ids), bool)
                for tree in range(len(forest.trees)):
                    inside |= np.isin(sample_leaves[:, tree], [leaf for t, leaf in taken if t == tree])
                met = against[i][inside]
                floor = float(np.partition(met, -k)[-k]) if len(met) > k else -np.inf
                for tree, leaf in taken:
                    for s in range(slices.get((tree, leaf), 0)):
                        out.append((tree, leaf, s, int(own[i]), vec, floor))
                if len(out) > 50_000 or i + 1 == len(x):
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.float64()))],
                                                         ["tree", "leaf", "part", "query_id", "query", "floor"])
                    out = []

    asked = table.filter(is_query).dropDuplicates(["vec_id"]).mapInArrow(route, "tree int, leaf int, part int, query_id long, query binary, floor double")
    asked = asked.withColumn("ask", F.pmod(F.xxhash64("query_id"), F.lit(query_slices)).cast("int"))
    sized = spark.createDataFrame([(t, l, s) for (t, l), s in slices.items()], "tree int, leaf int, parts int")
    held = members.join(F.broadcast(sized), ["tree", "leaf"]).withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    held = held.withColumn("ask", F.explode(F.sequence(F.lit(0), F.lit(query_slices - 1)))).select("tree", "leaf", "part", "ask", "vec_id", "vec")
    cell = ["tree", "leaf", "part", "ask"]

    def score(members: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if members.num_rows and queries.num_rows:
            ids = members.column("vec_id").to_numpy()
            data = np.frombuffer(b"".join(members.column("vec").to_pylist()), np.float64).reshape(len(ids), -1)
            small = data.astype(np.float32).T.copy()
            own = queries.column("query_id").to_numpy()
            asked = np.frombuffer(b"".join(queries.column("query").to_pylist()), np.float64).reshape(len(own), -1)
            floors = queries.column("floor").to_numpy()
            slack = SLACK * np.linalg.norm(data, axis=1).max()
            for at in range(0, len(own), 512):
                q = asked[at:at + 512]
                rough = q.astype(np.float32) @ small
                room = slack * np.linalg.norm(q, axis=1)
                for i in range(len(q)):
                    near = np.flatnonzero(rough[i] >= floors[at + i] - room[i])
                    near = near[ids[near] != own[at + i]]
                    if len(near) > 4 * k:
                        near = near[rough[i][near] >= np.partition(rough[i][near], -k)[-k] - room[i]]
                    if len(near):
                        exact = (data[near] * q[i]).sum(axis=1)
                        best = np.lexsort((ids[near], -exact))[:k]
                        out_q.append(np.full(len(best), own[at + i]))
                        out_v.append(ids[near][best])
                        out_s.append(exact[best])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": pa.array(join(out_q, np.int64)), "vec_id": pa.array(join(out_v, np.int64)), "score": pa.array(join(out_s, np.float64))})

    found = held.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(score, "query_id long, vec_id long, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
            .filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))


def _reach(trees: int, share: float) -> float:
    """Rows to take over all trees for each row wanted: rows that several trees offer count once in the end.

    With independent trees of which each gives the part ``p`` of its rows, 1 - (1 - p) ** trees of all rows are seen.
    """
    return trees * (1 - (1 - share) ** (1 / trees)) / share
