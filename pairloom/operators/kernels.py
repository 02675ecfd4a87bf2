"""Kernels of the similarity joins, run inside tasks: rounding, ranking, and masks of pairs that may not meet."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pairloom.functions.vectors import DECIMALS


def _round(values: np.ndarray) -> np.ndarray:
    scale = 10.0 ** DECIMALS
    return np.sign(values) * np.floor(np.abs(values) * scale + 0.5) / scale


def _cosines(q: np.ndarray, qn: np.ndarray, d: np.ndarray, dn: np.ndarray) -> np.ndarray:
    """Rounded cosines; minus infinity where a vector is zero."""
    scale = qn[:, None] * dn[None, :]
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(scale > 0, _round((q @ d.T) / scale), -np.inf)


def _first_k(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the k largest per row; on ties, the smaller column numbers."""
    rows, cols = sims.shape
    if cols > k:
        kth = np.partition(sims, cols - k, axis=1)[:, cols - k][:, None]
        above = sims > kth
        level = sims == kth
        room = k - above.sum(axis=1, keepdims=True)
        keep = above | (level & (np.cumsum(level, axis=1) <= room))
    else:
        keep = np.ones_like(sims, dtype=bool)
    keep &= np.isfinite(sims)
    return np.nonzero(keep)


def _banned_pairs(left: pa.Table, right: pa.Table, exclude_same_id: bool, grouped: bool):
    """Masks of the pairs a query may not have: its own row, or rows of its own group."""
    pairs = []
    if exclude_same_id:
        pairs.append(("query_id", "doc_id"))
    if grouped:
        pairs.append(("query_group", "doc_group"))
    codes = []
    for a, b in pairs:
        both = pa.chunked_array(left[a].chunks + right[b].chunks).combine_chunks().dictionary_encode()
        code = both.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        codes.append((code[:left.num_rows], code[left.num_rows:]))

    def masks(part: slice) -> Iterator[np.ndarray]:
        for a, b in codes:
            yield (a[part][:, None] == b[None, :]) & (a[part][:, None] >= 0)

    return masks


def _keep_first_k(found: pa.Table, k: int) -> pa.Table:
    """The k best rows of every query number in ``q``."""
    found = found.sort_by([("q", "ascending"), ("similarity", "descending"), ("doc_id", "ascending")])
    q = found["q"].to_numpy()
    starts = np.concatenate([[0], np.nonzero(np.diff(q))[0] + 1]) if len(q) else np.zeros(0, int)
    rank = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q))))
    return found.filter(pa.array(rank < k))
