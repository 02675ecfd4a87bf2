"""Text quality by ordinal regression on graded ratings, with cumulative links.

A text's score is the sum over its distinct tokens (lower-cased words and runs of marks) of their weights, over the fourth
root of their number. A token's weight is that of the token itself and of its ``GRAM``-letter parts, each hashed to
one of ``BUCKETS``. The weights are shared by all grades; ordered thresholds turn the score into tail probabilities
P(grade >= g) = logistic(score - threshold_g), and their sum is the expected grade.

Training is done in numpy on at most about ``sample`` rated documents, drawn by a hash of the id; buckets met in fewer
than ``LEAST`` of them keep the weight 0. Ratings are
joined by id: null ratings, and ratings of unknown documents, are not used; of several ratings of one document each
counts. Null text counts as empty and has the score 0. Without ratings of two grades the expected grade is null and
everything is kept. Repeated rows get equal rows; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import id_and_text

BUCKETS, GRAM, SAMPLE, LEAST = 1 << 18, 4, 6_000, 12
EPOCHS, RATE, DECAY, BATCH, SEED = 10, 0.5, 4e-4, 64, 3
KEPT_TOKENS = 250_000
KEEP = 0.5
_TOKEN = re.compile(r"[^\W\d_]+|[^\w\s]{2,}")


def parts(token: str) -> np.ndarray:
    """Buckets of a token and of its parts, beginning and end marked."""
    marked = f"^{token}$"
    names = {token, *(marked[i:i + GRAM] for i in range(len(marked) - GRAM + 1))}
    return np.unique(np.array([xxhash.xxh64_intdigest(n) & (BUCKETS - 1) for n in names], np.int32))


class _Kept(dict):
    """A bounded table of what a function gives for tokens."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, token: str):
        if len(self) >= KEPT_TOKENS:
            self.clear()
        value = self[token] = self.function(token)
        return value


def tokens(text: str) -> set[str]:
    return set(_TOKEN.findall(text.lower()))


def features(text: str) -> tuple[np.ndarray, int]:
    """Buckets of all distinct tokens, as often as they come, and the number of tokens."""
    found = tokens(text)
    return (np.concatenate([parts(t) for t in found]) if found else np.zeros(0, np.int32)), len(found)


def _scale(count):
    return np.maximum(count, 1) ** 0.25


def grade(quality: Column, toxic: Column) -> Column:
    """0 for toxic, 1 for other poor text, 2 for good text; null when a rating is null."""
    return F.when(toxic.isNotNull() & quality.isNotNull(), F.when(toxic > 0, 0).when(quality > 0, 2).otherwise(1))


class Ordinal:
    """Weights and thresholds; the gaps between thresholds are kept as logarithms, so they stay in order."""

    def __init__(self, grades: int):
        self.weights = np.zeros(BUCKETS)
        self.first, self.gaps = -1.0, np.zeros(max(0, grades - 2))

    def thresholds(self) -> np.ndarray:
        return self.first + np.concatenate([[0.0], np.cumsum(np.exp(self.gaps))])

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= 1), P(grade >= 2), ... of each score."""
        return 1 / (1 + np.exp(np.clip(self.thresholds()[None, :] - scores[:, None], -40, 40)))



def train(rows: list[tuple[np.ndarray, int, int]], grades: int, epochs: int = EPOCHS) -> Ordinal:
    """Adaptive stochastic gradient ascent of the likelihood, a grade weighing the root of its number.

    ``rows`` hold the buckets of a text, its number of tokens and its grade.
    """
    met = np.zeros(BUCKETS, np.int32)
    for found, *_ in rows:
        met[np.unique(found)] += 1
    often = met >= min(LEAST, max(1, len(rows) // 50))
    rows = [(found[often[found]], float(_scale(n)), g) for found, n, g in rows]
    model, draw = Ordinal(grades), np.random.default_rng(SEED)
    y = np.array([g for *_, g in rows])
    weight = np.sqrt(len(rows) / np.maximum(1, np.bincount(y, minlength=grades)) / grades)[y]
    squares, side = np.full(BUCKETS, 1e-4), np.full(grades - 1, 1e-4)
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            batch = order[at:at + BATCH]
            scores = np.array([model.weights[rows[i][0]].sum() / rows[i][1] for i in batch])
            # The likelihood of grade g is tail(g) - tail(g + 1), with tail(0) = 1 and tail(grades) = 0.
            tails = np.column_stack([np.ones(len(batch)), model.tails(scores), np.zeros(len(batch))])
            slope = tails * (1 - tails)
            k = np.arange(len(batch))
            g = y[batch]
            odds = np.maximum(tails[k, g] - tails[k, g + 1], 1e-9)
            up = weight[batch] * (slope[k, g] - slope[k, g + 1]) / odds
            found = [rows[i][0] for i in batch]
            sizes = np.array([len(f) for f in found])
            where = np.concatenate(found)
            grad = np.repeat(up / np.array([rows[i][1] for i in batch]), sizes)
            touched, inverse = np.unique(where, return_inverse=True)
            step = np.bincount(inverse, grad, len(touched)) - DECAY * BATCH * model.weights[touched]
            squares[touched] += step * step
            model.weights[touched] += RATE * step / np.sqrt(squares[touched])
            # Thresholds: a higher one lowers its tail.
            down = np.zeros(grades + 1)
            np.add.at(down, g, -weight[batch] * slope[k, g] / odds)
            np.add.at(down, g + 1, weight[batch] * slope[k, g + 1] / odds)
            by_cut = down[1:grades]
            moves = np.concatenate([[by_cut.sum()], [by_cut[j + 1:].sum() * math.exp(gap) for j, gap in enumerate(model.gaps)]])
            side += moves * moves
            moves = 0.1 * moves / np.sqrt(side)
            model.first += moves[0]
            model.gaps += moves[1:]
    return model


def rated(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE) -> list[tuple[np.ndarray, int, int]]:
    """Features and grades of the drawn documents, for the driver: at most about ``sample`` rows."""
    known = ratings.select(F.col("doc_id").cast("long").alias("doc_id"), grade(F.col("quality"), F.col("toxic")).alias("grade")).filter("grade is not null and doc_id is not null")
    count = known.count()
    if not count:
        return []
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = known.filter(draw < min(1 << 30, (1 << 30) * sample // count))

    def run(batches):
        for batch in batches:
            found = [features(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([n for _, n in found], pa.int32()), pa.array([np.sort(f).tobytes() for f, _ in found], pa.binary())],
                                             ["doc_id", "grade", "n", "found"])

    rows = docs.join(chosen, "doc_id").select("doc_id", "text", "grade").mapInArrow(run, "doc_id long, grade int, n int, found binary").collect()
    return [(np.frombuffer(r["found"], np.int32), r["n"], r["grade"]) for r in sorted(rows)]


def assess(docs: DataFrame, ratings: DataFrame, sample: int = SAMPLE, keep: float = KEEP, grades: int = 3) -> DataFrame:
    """``doc_id, expected_grade, tail_1 .., keep``: ``keep`` when P(grade >= 1) reaches ``keep``; one pass after training."""
    docs = id_and_text(docs)
    rows = rated(docs, ratings, sample)
    model = train(rows, grades) if len({g for *_, g in rows}) > 1 else None
    sent = docs.sparkSession.sparkContext.broadcast(model)
    names = [f"tail_{g}" for g in range(1, grades)]

    def run(batches):
        model = sent.value
        weigh = _Kept(lambda token: float(model.weights[parts(token)].sum())).__getitem__
        for batch in batches:
            n = batch.num_rows
            if model is None:
                empty = pa.nulls(n, pa.float64())
                columns = [batch.column(0), empty, *[empty] * len(names), pa.array([True] * n)]
            else:
                found = [tokens(t.as_py()) for t in batch.column(1)]
                tails = model.tails(np.array([math.fsum(map(weigh, f)) for f in found]) / _scale(np.array([len(f) for f in found])))
                columns = [batch.column(0), pa.array(tails.sum(axis=1)), *[pa.array(tails[:, j]) for j in range(len(names))], pa.array(tails[:, 0] >= keep)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "expected_grade", *names, "keep"])

    return docs.mapInArrow(run, "doc_id long, expected_grade double, " + ", ".join(f"{c} double" for c in names) + ", keep boolean")
