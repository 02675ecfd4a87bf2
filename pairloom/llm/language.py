"""Language identification with a bidirectional gated recurrent network over bytes.

Training is done in numpy by backpropagation through time on a bounded, documented sample: about ``per_language``
documents of each language, drawn by a hash of their id, one piece of ``PIECE`` bytes at a hashed place of each. At
inference every byte of a text is labelled. The bytes are cut into segments of ``SEGMENT`` bytes, which run side by side
through both directions; the document's probability of a language is the mean over the positions of its letters.

Lower-case ASCII folding is the only rewriting. Null text, and text without letters, is ``und`` with score 0. Without
any training document everything is ``und``. Repeated rows get equal rows; an empty table gives an empty result; other
columns are not read. Ties go to the language first in the alphabet.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from pairloom.llm.common import give_back, tidy

UNKNOWN = "und"
HIDDEN, SEGMENT, PIECE, PER_LANGUAGE = 8, 128, 256, 500
BATCH, STEPS, RATE, SEED = 96, 420, 0.02, 11
LANES = 2048
PASS = 1_000_000
# Python's own idea of a letter, so that any script counts.
_LETTER = re.compile(r"[^\W\d_]")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
# Bytes whose positions count for a document: ASCII letters and all bytes of longer characters.
_COUNTS = np.zeros(256, np.float32)
_COUNTS[97:123] = 1
_COUNTS[128:] = 1


class ByteNetwork:
    """Weights: per direction an input table (256 x 3H), a recurrent matrix (H x 3H) and its bias for the candidate.

    Gates are kept as the tanh form of the logistic function, sigma(x) = (1 + tanh(x / 2)) / 2.
    """

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = SEED):
        draw = np.random.default_rng(seed)
        self.labels, self.hidden = labels, hidden
        self.weights = {}
        for side in "fb":
            self.weights[f"x{side}"] = draw.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.weights[f"h{side}"] = draw.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden)).astype(np.float32)
            self.weights[f"c{side}"] = np.zeros(hidden, np.float32)
        self.weights["out"] = draw.normal(0, 0.3, (2 * hidden, len(labels))).astype(np.float32)
        self.weights["bias"] = np.zeros(len(labels), np.float32)

    def _direction(self, side: str, codes: np.ndarray, keep: bool, active: np.ndarray | None = None):
        """Hidden states (T, B, H) of one direction over codes (T, B); with ``keep`` also what the gradient needs.

        With ``active`` only the first ``active[t]`` lanes have a byte at position t, so that no direction reads padding.
        """
        table, back, bias = (self.weights[k + side] for k in "xhc")
        steps, lanes = codes.shape
        n = self.hidden
        states = np.zeros((steps, lanes, n), np.float32)
        whole = np.zeros((lanes, n), np.float32)
        kept = []
        for t in range(steps) if side == "f" else range(steps - 1, -1, -1):
            many = lanes if active is None else active[t]
            state = whole[:many]
            x = table[codes[t, :many]]
            r = state @ back
            gates = x[:, :2 * n] + r[:, :2 * n]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            inner = r[:, 2 * n:]
            inner += bias
            new = gates[:, n:] * inner
            new += x[:, 2 * n:]
            np.tanh(new, out=new)
            if keep:
                kept.append((t, state, gates, inner, new))
            state = new + gates[:, :n] * (state - new)
            states[t, :many] = state
            if many == lanes:
                whole = state
            else:
                whole[:many] = state
        return states, kept

    def positions(self, codes: np.ndarray, active: np.ndarray | None = None) -> np.ndarray:
        """Probabilities (T, B, languages) of every position."""
        forward, _ = self._direction("f", codes, False, active)
        backward, _ = self._direction("b", codes, False, active)
        n = self.hidden
        logits = forward @ self.weights["out"][:n]
        logits += backward @ self.weights["out"][n:]
        logits += self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=2, keepdims=True)
        return logits

    def gradients(self, codes: np.ndarray, target: np.ndarray, weight: np.ndarray) -> tuple[float, dict]:
        """Mean cross-entropy over positions with weights (T, B), and its gradients through time."""
        n = self.hidden
        sides = {side: self._direction(side, codes, True) for side in "fb"}
        both = np.concatenate([sides["f"][0], sides["b"][0]], axis=2)
        logits = both @ self.weights["out"] + self.weights["bias"]
        logits -= logits.max(axis=2, keepdims=True)
        odds = np.exp(logits)
        odds /= odds.sum(axis=2, keepdims=True)
        lanes = np.arange(codes.shape[1])
        scale = (weight / weight.sum()).astype(np.float32)
        loss = float(-(np.log(odds[:, lanes, target] + 1e-12) * scale).sum())
        step = odds
        step[:, lanes, target] -= 1
        step *= scale[:, :, None]
        grads = {"out": np.einsum("tbh,tbl->hl", both, step), "bias": step.sum(axis=(0, 1))}
        down = step @ self.weights["out"].T
        for side, part in (("f", down[:, :, :n]), ("b", down[:, :, n:])):
            back = self.weights[f"h{side}"]
            gx, gh, gc = np.zeros_like(self.weights[f"x{side}"]), np.zeros_like(back), np.zeros(n, np.float32)
            carried = np.zeros((codes.shape[1], n), np.float32)
            for t, state, gates, inner, new in reversed(sides[side][1]):
                d = part[t] + carried
                z, r = gates[:, :n], gates[:, n:]
                d_new = d * (1 - z) * (1 - new * new)
                d_z = d * (state - new) * z * (1 - z)
                d_r = d_new * inner * r * (1 - r)
                d_inner = d_new * r
                pre = np.concatenate([d_z, d_r, d_inner], axis=1)
                carried = d * z + pre @ back.T
                gh += state.T @ pre
                gc += d_inner.sum(axis=0)
                np.add.at(gx, codes[t], np.concatenate([d_z, d_r, d_new], axis=1))
            grads |= {f"x{side}": gx, f"h{side}": gh, f"c{side}": gc}
        return loss, grads


def train(rows: list[tuple[bytes, str]], steps: int = STEPS, hidden: int = HIDDEN) -> ByteNetwork | None:
    """Adam over balanced random batches of pieces; short pieces are padded and the padding has no weight."""
    rows = sorted({(t, label) for t, label in rows if _COUNTS[_FOLD[np.frombuffer(t, np.uint8)]].any()})
    if not rows:
        return None
    labels = sorted({label for _, label in rows})
    net, draw = ByteNetwork(labels, hidden), np.random.default_rng(SEED)
    by = [[_FOLD[np.frombuffer(t, np.uint8)] for t, label in rows if label == one] for one in labels]
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        target = draw.integers(len(labels), size=BATCH)
        # Short and long stretches, as documents have them.
        width = int(draw.choice([16, 32, 64]))
        codes = np.full((width, BATCH), 32, np.uint8)
        weight = np.zeros((width, BATCH), np.float32)
        for lane, label in enumerate(target):
            text = by[label][draw.integers(len(by[label]))]
            at = int(draw.integers(max(1, len(text) - width + 1)))
            part = text[at:at + width]
            codes[:len(part), lane] = part
            weight[:len(part), lane] = _COUNTS[part]
        if not weight.any():
            continue
        _, grads = net.gradients(codes, target, weight)
        rate = RATE * min(1.0, 4 * (1 - step / (steps + 1)))
        for k, g in grads.items():
            g = np.clip(g, -1, 1)
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            net.weights[k] -= (rate * (first[k] / (1 - 0.9 ** step)) / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-6)).astype(np.float32)
    return net


def label_texts(net: ByteNetwork, texts: list[str]) -> list[tuple[str, float]]:
    """``(language, score)`` of each text, from all of its bytes."""
    data = [t.encode() for t in texts]
    sizes = np.array([len(d) for d in data], np.int64)
    parts = -(-sizes // SEGMENT)
    sums = np.zeros((len(texts), len(net.labels)))
    weights = np.zeros(len(texts))
    flat = _FOLD[np.frombuffer(b"".join(data), np.uint8)]
    begins = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(texts)), parts)
    offset = (np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)) * SEGMENT
    starts, left = begins[owner] + offset, np.minimum(SEGMENT, sizes[owner] - offset)
    order = np.argsort(-left, kind="stable")
    for at in range(0, len(order), LANES):
        lanes = order[at:at + LANES]
        width = int(left[lanes[0]])
        place = starts[lanes][None, :] + np.arange(width)[:, None]
        inside = np.arange(width)[:, None] < left[lanes][None, :]
        codes = np.where(inside, flat[np.minimum(place, len(flat) - 1)], np.uint8(32))
        weight = _COUNTS[codes] * inside
        odds = net.positions(codes, inside.sum(axis=1))
        np.add.at(sums, owner[lanes], np.einsum("tbl,tb->bl", odds, weight))
        np.add.at(weights, owner[lanes], weight.sum(axis=0))
    out = []
    for text, total, weight in zip(texts, sums, weights):
        if weight <= 0 or not _LETTER.search(text):
            out.append((UNKNOWN, 0.0))
        else:
            best = int(np.argmax(total))
            out.append((net.labels[best], round(float(min(1.0, total[best] / weight)), 6)))
    return out


def label_positions(net: ByteNetwork, text: str) -> list[str]:
    """The language of every byte of a text."""
    codes = _FOLD[np.frombuffer(text.encode(), np.uint8)]
    out = []
    for at in range(0, len(codes), SEGMENT):
        odds = net.positions(codes[at:at + SEGMENT, None])[:, 0]
        out += [net.labels[i] for i in odds.argmax(axis=1)]
    return out


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> list[tuple[bytes, str]]:
    """About ``per_language`` pieces of each language, drawn below a hash bound that follows from its count."""
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    # One row per language: the network's output has a column for each, so the driver holds them in any case.
    counts = docs.sparkSession.createDataFrame([tuple(r) for r in rows.groupBy("lang").count().collect()], "lang string, count long")
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = rows.join(F.broadcast(counts), "lang").filter(draw < F.lit(float(1 << 30)) * per_language / F.col("count"))
    place = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - PIECE + 1, F.lit(1))).cast("int")
    return sorted((r["text"].encode(), r["lang"]) for r in chosen.select("lang", F.substring("text", place + 1, F.lit(PIECE)).alias("text")).collect())


def model(docs: DataFrame, per_language: int = PER_LANGUAGE) -> ByteNetwork | None:
    return train(training_rows(docs, per_language))


def predict(docs: DataFrame, net: ByteNetwork | None, keep=()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row, one pass without a shuffle.

    With ``keep``, these columns of ``docs`` follow unchanged; one named like a result is left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net)
    names = ["doc_id", "held_out", "lang_pred", "score"]
    kept = [c for c in keep if c not in names]

    @tidy
    def run(batches):
        net = sent.value
        for batch in batches:
            found, held, size = [], [], 0
            for i, text in enumerate(batch.column(2)):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > PASS or i + 1 == batch.num_rows:
                    found += label_texts(net, held) if net else [(UNKNOWN, 0.0)] * len(held)
                    held, size = [], 0
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                                              *batch.columns[3:]], names + kept)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("text").alias("_text"), *kept)
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    return rows.mapInArrow(run, ", ".join([schema, *(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in kept)]))


def told(net: ByteNetwork | None, least: float) -> Callable[[Column], Column]:
    """Whether the language of a text can be told with at least this score; only the text travels to Python, and one boolean back."""

    @F.arrow_udf("boolean")
    def known(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            out, held, size = [], [], 0
            for i, text in enumerate(batch):
                held.append(text.as_py() or "")
                size += len(held[-1])
                if size > PASS or i + 1 == len(batch):
                    found = label_texts(net, held) if net else [(UNKNOWN, 0.0)] * len(held)
                    out += [lang != UNKNOWN and score >= least for lang, score in found]
                    held, size = [], 0
            yield pa.array(out, pa.bool_())
            give_back()

    return known
