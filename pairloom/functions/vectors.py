"""Vector maths on array columns, in double precision."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

DECIMALS = 6
_PACKED = {1: np.int8, 2: np.int16, 4: np.float32, 8: np.float64}  # the first byte of a packed vector: bytes of a component


def dot(a, b) -> Column:
    products = F.zip_with(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b,
                          lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a, b) -> Column:
    """Cosine similarity; NULL for a zero vector, so it passes no threshold and enters no mean."""
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def as_matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The rows of a list column without nulls as a matrix of doubles."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(array), -1) if len(array) else np.zeros((0, 0))


def stored_rows(array: pa.Array) -> np.ndarray:
    """The rows of a column without nulls as a matrix: lists in their own type, packed vectors in the smallest that holds them all."""
    if not (pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type)):
        return array.flatten().to_numpy(zero_copy_only=False).reshape(len(array), -1) if len(array) else np.zeros((0, 0))
    array = array.cast(pa.binary())
    if not len(array):
        return np.zeros((0, 0), np.int8)
    ends = np.frombuffer(array.buffers()[1], np.int32)[array.offset:array.offset + len(array) + 1]
    kinds = np.frombuffer(array.buffers()[2], np.uint8)[ends[:-1]]
    found = np.unique(kinds)
    if len(found) > 1:
        parts = [(kinds == kind, stored_rows(array.filter(pa.array(kinds == kind)))) for kind in found]
        out = np.empty((len(array), parts[0][1].shape[1]), np.result_type(*[part for _, part in parts]))
        for rows, part in parts:
            out[rows] = part
        return out
    rows = np.frombuffer(array.buffers()[2], np.uint8)[ends[0]:ends[-1]].reshape(len(array), -1)
    return np.ascontiguousarray(rows[:, 1:]).view(_PACKED[int(found[0])])


def pack_rows(column: pa.Array) -> pa.Array:
    """Each vector of a list column without nulls as bytes, exact: whole numbers in one or two bytes where they fit, else as they are stored."""
    m = stored_rows(column)
    if m.dtype != np.float32:
        m = m.astype(np.float64)
    size = np.abs(m).max(axis=1, initial=0)
    whole = (np.rint(m) == m).all(axis=1)
    kinds = np.where(whole & (size <= 127), 1, np.where(whole & (size <= 32767), 2, m.itemsize))
    parts, order = [], []
    for kind in np.unique(kinds):
        rows = np.flatnonzero(kinds == kind)
        body = np.empty((len(rows), 1 + m.shape[1] * kind), np.uint8)
        body[:, 0], body[:, 1:] = kind, m[rows].astype(_PACKED[int(kind)]).view(np.uint8)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(body.shape[1])
        parts.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(body)]))
        order.append(rows)
    if len(parts) < 2:
        return parts[0] if parts else pa.array([], pa.binary())
    return pa.concat_arrays(parts).take(pa.array(np.argsort(np.concatenate(order))))


def packed(df: DataFrame, column: str) -> DataFrame:
    """``df`` with the vectors of a column without nulls as bytes, a quarter of the size for small whole numbers; row-local."""
    place = df.columns.index(column)
    schema = T.StructType([T.StructField(f.name, T.BinaryType() if f.name == column else f.dataType) for f in df.schema])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [pack_rows(c) if i == place else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(pack, schema)


def row_lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt((matrix ** 2).sum(axis=1))


@F.arrow_udf(T.DoubleType())
def batched_cosine(a: pa.Array, b: pa.Array) -> pa.Array:
    """``cosine`` by Arrow batches: faster for long vectors, as lambdas over arrays are not compiled."""
    given = a.is_valid().to_numpy(zero_copy_only=False) & b.is_valid().to_numpy(zero_copy_only=False)
    out = np.full(len(a), np.nan)
    if given.any():
        x, y = as_matrix(a.filter(pa.array(given))), as_matrix(b.filter(pa.array(given)))
        scale = row_lengths(x) * row_lengths(y)
        with np.errstate(divide="ignore", invalid="ignore"):
            out[given] = np.where(scale > 0, (x * y).sum(axis=1) / scale, np.nan)
    return pa.array(out, mask=np.isnan(out))
