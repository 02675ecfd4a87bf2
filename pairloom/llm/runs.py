"""Periodic runs of words, found with string synchronising sets.

A run is a stretch of consecutive words with smallest period q (words q apart are identical), at least ``LEAST``
and at least ``2 q`` words long, that no neighbouring word extends keeping period q.

For a scale t (a power of two) a position i belongs to the synchronising set when, among the hashes of the t-word
windows at i .. i + t, the smallest is that of the window at i or at i + t; windows that are themselves highly
periodic (period up to t / 3) do not count. Membership follows from the 2 t words at i alone, and each t positions in
a row hold a member unless they lie in a highly periodic region. So in a run of period 3 t - 1 .. 6 t - 2 two members
one period apart have equal contexts, and pairs of members with equal contexts propose every period of that range
once. Contexts of members have no small period, so a context recurs at most 18 times within 6 t words. Each proposal is
extended to both sides with substring hashes, and what is reported has been compared word by word.

Highly periodic regions are found apart and supply what the sets omit. Periods up to ``DIRECT`` come from comparing
words at that distance; the runs of smaller scales tell which windows of a larger one are highly periodic. Where two regions
of one period p touch, as in ``(a b)^20 a (a b)^20 a``, each distance that lays one upon the other is the period of a
run whose repeated stretch is highly periodic itself; these distances are a progression of step p, and the bounds of
their runs follow from those of the two regions.

Work and memory grow with the words of a slice of documents (n log n at most). One document is one unit: its text has
to fit a task. There is no shuffle, and nothing reaches the driver.

Null and empty texts have no words, no runs and the empty text. Each row is judged by itself, so repeated ids, ties, other
columns and their names do not matter; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from pairloom.llm.common import id_and_text, tidy
from pairloom.llm.words import mix

LEAST = 12
DIRECT = 4               # periods found by direct comparison; the scales begin at 2 and cover 5 and more
SLICE_BYTES = 4_000_000  # texts handled at a time; a longer one stands alone
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


class Fingerprints:
    """Hashes of any stretch of a sequence of codes, in constant time each; equal stretches have equal hashes."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        power, inverse = np.full(n, _BASE, np.uint64), np.full(n + 1, _INVERSE, np.uint64)
        power[:1], inverse[0] = 1, 1
        self.inverse = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(codes.astype(np.uint64)) * np.cumprod(power, dtype=np.uint64), dtype=np.uint64, out=self.sums[1:])

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        return (self.sums[starts + size] - self.sums[starts]) * self.inverse[starts]

    def all(self, size: int) -> np.ndarray:
        return (self.sums[size:] - self.sums[:len(self.sums) - size]) * self.inverse[:len(self.sums) - size]

    def common_after(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes from ``a`` on equal those from ``b`` on (``b`` above ``a``)."""
        n, out = len(self.sums) - 1, np.zeros(len(a), np.int64)
        for bit in reversed(range(n.bit_length())):
            fits = np.flatnonzero(b + out + (1 << bit) <= n)
            fits = fits[self.at(a[fits] + out[fits], 1 << bit) == self.at(b[fits] + out[fits], 1 << bit)]
            out[fits] += 1 << bit
        return out

    def common_before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many codes before ``a`` equal those before ``b`` (``b`` above ``a``)."""
        n, out = len(self.sums) - 1, np.zeros(len(a), np.int64)
        for bit in reversed(range(n.bit_length())):
            fits = np.flatnonzero(a - out - (1 << bit) >= 0)
            fits = fits[self.at(a[fits] - out[fits] - (1 << bit), 1 << bit) == self.at(b[fits] - out[fits] - (1 << bit), 1 << bit)]
            out[fits] += 1 << bit
        return out


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the stretches of true values."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def _direct(codes: np.ndarray, q: int) -> np.ndarray:
    """Rows ``start, end, q`` of the stretches of period q that are three periods long."""
    start, stop = _stretches(codes[q:] == codes[:-q])
    keep = stop - start >= 2 * q
    return np.stack([start[keep], stop[keep] + q, np.full(keep.sum(), q)], axis=1)


def synchronising_set(prints: Fingerprints, t: int, periodic: np.ndarray) -> np.ndarray:
    """Members at scale t, ascending; ``periodic`` marks the t-word windows of period up to t / 3."""
    hashes = mix(prints.all(t))
    if len(hashes) <= t:
        return np.zeros(0, np.int64)
    counted = np.where(periodic[:len(hashes)], _NONE, hashes)
    least, width = counted, 1
    while width < t:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    least = np.minimum(least[:len(hashes) - t], counted[t:])
    return np.flatnonzero((least != _NONE) & ((least == hashes[:-t]) | (least == hashes[t:])))


def _proposals(prints: Fingerprints, members: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of members with equal contexts whose distance is a period of this scale: first members and distances."""
    context = prints.at(members, 2 * t)
    order = np.argsort(context, kind="stable")
    context, place = context[order], members[order]
    first, ahead, starts, periods = np.arange(len(place)), 1, [], []
    while True:
        first = first[first + ahead < len(place)]
        gap = place[first + ahead] - place[first]
        near = (context[first + ahead] == context[first]) & (gap <= 6 * t - 2)
        first, gap = first[near], gap[near]
        if not len(first):
            break
        fits = gap >= 3 * t - 1
        starts.append(place[first[fits]])
        periods.append(gap[fits])
        ahead += 1
    if not starts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(starts), np.concatenate(periods)


def _verified(codes: np.ndarray, start: int, end: int, q: int, seed: int) -> tuple[int, int]:
    """The stretch around ``seed`` in which words q apart are identical, compared word by word."""
    if np.array_equal(codes[start:end - q], codes[start + q:end]):
        return start, end
    differ = np.flatnonzero(codes[start:end - q] != codes[start + q:end]) + start
    before, after = differ[differ < seed], differ[differ >= seed]
    return int(before[-1]) + 1 if len(before) else start, int(after[0]) + q if len(after) else end


def _one_period_each(rows: np.ndarray) -> np.ndarray:
    """A stretch with several periods has the smallest as its own; the others are multiples of it."""
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    first = np.ones(len(rows), bool)
    first[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    return rows[first]


def _across_regions(codes: np.ndarray, rows: np.ndarray) -> tuple[list, list]:
    """Runs that lay one periodic region upon the next one, as ``start, end, period``, and seeds of those with open bounds."""
    exact, seeds = [], []
    rows = rows[(rows[:, 2] > 1) & (rows[:, 1] - rows[:, 0] >= 3 * rows[:, 2])]
    rows = rows[np.lexsort((rows[:, 0], rows[:, 2]))]
    touching = np.flatnonzero((rows[1:, 2] == rows[:-1, 2]) & (rows[1:, 0] <= rows[:-1, 1]))
    for (s1, e1, p), (s2, e2, _) in zip(rows[touching].tolist(), rows[touching + 1].tolist()):
        # Where the root of the first region stands in the second one.
        root, doubled = codes[s1:s1 + p], codes[s2:s2 + 2 * p - 1]
        at = next((int(i) for i in np.flatnonzero(doubled[:p] == root[0]) if np.array_equal(doubled[i:i + p], root)), None)
        if at is None:
            continue
        most = min(e1 - s1, e2 - s2, (e2 - s1) // 2)
        q = np.arange((s2 + at - s1) % p or p, most + 1, p)
        low, high = np.maximum(s1, s2 - q), np.minimum(e1, e2 - q)
        closed = (q != s2 - s1) & (q != e2 - e1)
        exact.append(np.stack([low, high + q, q], axis=1)[closed])
        seeds += zip(low[~closed].tolist(), q[~closed].tolist())
    return exact, seeds


def _extended(codes: np.ndarray, prints: Fingerprints, seeds: np.ndarray, periods: np.ndarray) -> np.ndarray:
    """Rows ``start, end, period`` of the stretches around seeds that are two periods long."""
    start = seeds - prints.common_before(seeds, seeds + periods)
    end = seeds + periods + prints.common_after(seeds, seeds + periods)
    long = end - start >= 2 * periods
    rows = np.stack([start[long], end[long], periods[long], seeds[long]], axis=1)
    rows = rows[np.unique(rows[:, [0, 2]], axis=0, return_index=True)[1]]
    return np.array([(*_verified(codes, s, e, q, at), q) for s, e, q, at in rows.tolist()], np.int64).reshape(-1, 3)


def runs_of(codes: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start and period, in sequences laid end to end.

    ``codes`` holds each sequence followed by one code that occurs nowhere else, ``sizes`` their lengths without it.
    """
    found = [r for q in range(1, DIRECT + 1) if len(r := _direct(codes, q))] if len(codes) > DIRECT else []
    of_sequence = np.repeat(np.arange(len(sizes)), sizes + 1)
    t = 2
    while len(sizes) and 6 * t - 2 <= sizes.max():
        inside = np.flatnonzero((sizes >= 6 * t - 2)[of_sequence])
        part = codes[inside]
        covered = np.zeros(len(codes) + 1, np.int32)
        for rows in found:
            rows = rows[(3 * rows[:, 2] <= t) & (rows[:, 1] - rows[:, 0] >= t)]
            np.add.at(covered, rows[:, 0], 1)
            np.add.at(covered, rows[:, 1] - t + 1, -1)
        prints = Fingerprints(part)
        members = synchronising_set(prints, t, (np.cumsum(covered[:-1]) > 0)[inside])
        seeds, periods = _proposals(prints, members, t)
        if len(seeds):
            rows = _extended(part, prints, seeds, periods)
            rows[:, :2] += (inside[rows[:, 0]] - rows[:, 0])[:, None]
            found.append(rows)
        t *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    rows = _one_period_each(np.concatenate(found))
    more, open_ones = _across_regions(codes, rows)
    if open_ones:
        seeds, periods = np.array(open_ones, np.int64).T
        more.append(_extended(codes, Fingerprints(codes), seeds, periods))
    rows = _one_period_each(np.concatenate([rows, *more])) if more else rows
    rows = rows[rows[:, 1] - rows[:, 0] >= np.maximum(least, 2 * rows[:, 2])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with ``SLICE_BYTES`` of text at most, or one row."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(ends):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SLICE_BYTES, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def _lists(offsets: np.ndarray, values) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Numbers of words and the words of all texts in order."""
    split = pc.ascii_split_whitespace(texts.cast(pa.string()))
    values, ends = split.flatten(), np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64))
    given = pc.binary_length(values).to_numpy(zero_copy_only=False) > 0
    before = np.concatenate([[0], np.cumsum(given)])
    return np.diff(before[np.concatenate([[0], ends])]), values.filter(pa.array(given))


def _judge(part: pa.RecordBatch, least: int, rewrite) -> pa.RecordBatch:
    sizes, words = _words(part.column(1))
    begins = np.concatenate([[0], np.cumsum(sizes)])
    source = np.arange(begins[-1])
    if rewrite:
        for row, doc_id in enumerate(part.column(0).to_pylist()):
            order = rewrite(doc_id, int(sizes[row])) if doc_id is not None else None
            if order is not None:
                source[begins[row]:begins[row + 1]] = begins[row] + order
    numbers = words.dictionary_encode().indices.to_numpy().astype(np.int64)[source]
    known = int(numbers.max()) + 1 if len(numbers) else 0
    # One code of its own behind each document.
    codes = np.insert(numbers, begins[1:], known + np.arange(len(sizes)))
    rows = runs_of(codes, sizes, least)
    row_of = np.searchsorted(begins[1:] + np.arange(len(sizes)), rows[:, 0], "right") if len(rows) else np.zeros(0, np.int64)
    starts, lengths = rows[:, 0] - row_of - begins[row_of], rows[:, 1] - rows[:, 0]
    dropped = np.zeros(len(source) + 1, np.int32)
    np.add.at(dropped, rows[:, 0] - row_of + rows[:, 2], 1)
    np.add.at(dropped, rows[:, 1] - row_of, -1)
    kept = np.cumsum(dropped[:-1]) == 0
    left = np.concatenate([[0], np.cumsum(kept)])[begins]
    collapsed = pc.binary_join(_lists(left, words.take(pa.array(source[kept]))), " ")
    runs = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (starts, lengths, rows[:, 2])], ["start", "length", "period"])
    counts = np.concatenate([[0], np.cumsum(np.bincount(row_of, minlength=len(sizes)))])
    return pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), _lists(counts, runs), collapsed], ["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Callable[[int, int], np.ndarray | None] | None = None) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs``.

    ``runs`` holds ``start`` (word number), ``length`` and ``period`` by start, then period; ``collapsed`` the words that stay when
    each run keeps its first period only, joined by one space. ``rewrite(doc_id, n)`` may give, for a document of n words, the
    numbers of the words that stand in its places; a null id is not asked.
    """

    @tidy
    def run(batches):
        for batch in batches:
            for part in _slices(batch):
                yield _judge(part, least, rewrite)

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
