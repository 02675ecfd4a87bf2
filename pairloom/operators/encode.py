"""Encoders: text columns to vector columns, by Arrow batches."""

from __future__ import annotations

import hashlib
import importlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

VECTOR = T.ArrayType(T.FloatType(), False)
WORD = re.compile(r"[^\W_]+")
CACHE_WORDS = 200_000


def as_lists(flat: np.ndarray, rows: int, dim: int, nulls: pa.Array | None = None) -> pa.Array:
    """The rows of a matrix as a list column; where ``nulls`` is true the list is null."""
    offsets = pa.array(np.arange(rows + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.reshape(-1)), mask=nulls)


class _WordCodes(dict):
    """Word to ``2 * bucket + (1 if the sign is negative)``, filled on first sight and bounded in size."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        digest = hashlib.md5(word.encode()).hexdigest()
        code = self[word] = 2 * (int(digest[:8], 16) % self.dim) + int(digest[8], 16) % 2
        return code


def _hash_counts(texts: list, dim: int, codes: _WordCodes) -> np.ndarray:
    counts = np.zeros((len(texts), dim), dtype=np.float32)
    for row, text in enumerate(texts):
        words = WORD.findall(text)
        if words:
            code = np.fromiter(map(codes.__getitem__, words), dtype=np.int64, count=len(words))
            both = np.bincount(code, minlength=2 * dim)
            counts[row] = both[0::2] - both[1::2]
    return counts


@dataclass(frozen=True)
class HashingEncoder:
    """Feature hashing (Weinberger et al. 2009): signed word counts in ``dim`` buckets.

    Words are runs of letters and digits of the lower-cased text. Bucket: first eight hex digits of the
    word's md5 modulo ``dim``; sign: parity of the ninth. With ``normalize`` the vector has length one;
    without it the counts stay whole numbers, which keeps cosines exact.
    """

    dim: int = 384
    normalize: bool = True

    def __call__(self, text: Column) -> Column:
        dim, normalize = self.dim, self.normalize

        @F.arrow_udf(VECTOR)
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codes = _WordCodes(dim)
            for batch in batches:
                texts = [t or "" for t in batch.to_pylist()]
                flat = _hash_counts(texts, dim, codes)
                if normalize:
                    length = np.sqrt((flat.astype(np.float64) ** 2).sum(axis=1, keepdims=True))
                    flat = (flat / np.where(length == 0, 1, length)).astype(np.float32)
                yield as_lists(flat, len(texts), dim)

        return encode(F.lower(text))


_models: dict = {}  # in each Python worker: the models loaded so far, by name


def _loaded(name: str | None, loader: Callable):
    if name is None:
        return loader()
    if name not in _models:
        _models[name] = loader()
    return _models[name]


@dataclass(frozen=True)
class ModelEncoder:
    """An encoder from user code: ``loader()`` returns ``list[str] -> matrix`` and runs once per Python task.

    With a ``name``, the tasks that follow each other in one Python worker share the loaded model.
    """

    loader: Callable[[], Callable[[list], np.ndarray]]
    dim: int = 384
    batch_size: int = 256
    name: str | None = None

    def __call__(self, text: Column) -> Column:
        loader, dim, size, name = self.loader, self.dim, self.batch_size, self.name

        @F.arrow_udf(VECTOR)
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            model = _loaded(name, loader)
            for batch in batches:
                texts = [t or "" for t in batch.to_pylist()]
                parts = [np.asarray(model(texts[i:i + size]), dtype=np.float32) for i in range(0, len(texts), size)]
                flat = np.concatenate(parts) if parts else np.zeros((0, dim), np.float32)
                if flat.shape != (len(texts), dim):
                    raise ValueError(f"the model gave {flat.shape}, expected {(len(texts), dim)}")
                yield as_lists(flat, len(texts), dim)

        return encode(text)


def with_vector(df: DataFrame, encoder, text_col: str, name: str) -> DataFrame:
    """On-demand transform: a vector column computed from a text column when it is read."""
    return df.withColumn(name, F.when(F.col(text_col).isNotNull(), encoder(F.col(text_col))))


def hashed_counts(df: DataFrame, id_col: str, text_col: str, dim: int = 384) -> DataFrame:
    """The non-zero buckets of each text as rows ``id, bucket, weight``; row-local, no shuffle, and no zero leaves its task."""
    schema = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("bucket", T.LongType()), T.StructField("weight", T.LongType())])

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _WordCodes(dim)
        for batch in batches:
            counts = _hash_counts([t or "" for t in batch.column(1).to_pylist()], dim, codes)
            rows, buckets = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), pa.array(buckets.astype(np.int64)), pa.array(counts[rows, buckets].astype(np.int64))],
                                             names=[id_col, "bucket", "weight"])

    return df.select(id_col, F.lower(text_col).alias("_text")).mapInArrow(sparse, schema)


def loader_named(name: str) -> Callable:
    """The loader that ``package.module:function`` names, for a model given on the command line."""
    module, colon, function = name.partition(":")
    if not colon:
        raise ValueError("a model is named as package.module:function")
    return getattr(importlib.import_module(module), function)
