"""The n-th key of a total order, found without sorting or moving the rows, and the rows up to it.

``nth_hash`` narrows a histogram of hex digits down to the digit groups that hold the n-th row: each pass is a partial
aggregate of at most ``16 ** DIGITS`` counts, whatever the rows hold. ``nth_key`` serves any order: the key columns alone are
sorted by range and stored, and per-partition counts name the row. With the key known, the rows up to it are a filter: no
window, no exchange of what the rows carry, no task that holds n rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.operators.positions import LOCAL_BITS
from pairloom.session import stage

DIGITS = 4        # hex digits a pass of the histogram resolves
LEAF_ROWS = 4096  # so few rows are looked at one by one
KEPT_SORTED = 100_000  # first rows up to this number are kept by each task


def _compared(columns) -> Column:
    return F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(columns)])


def up_to(columns, values) -> Column:
    """Whether the key of a row is at most ``values``; nulls come first, as in a sort."""
    return _compared(columns) <= _compared([F.lit(v) for v in values])


def nth_hash(df: DataFrame, n, key: Column, tie: str) -> tuple[tuple | None, int]:
    """The key ``(hash, tie)`` of row n (from 1) in the order of a hex hash and then ``tie``, and how many rows lie up to it.

    ``n`` may be a function of the number of rows. No key when n is 0 or the table is empty; the last key when n is above the number of rows.
    More rows than n lie up to the key only when they share both hash and tie.
    """
    hashed, prefix, before, wanted = df.select(key.alias("_h"), F.col(tie).alias("_t")), "", 0, None
    while True:
        inside = hashed.where(F.col("_h").startswith(prefix)) if prefix else hashed
        counts = sorted((r["p"], r["n"]) for r in inside.groupBy(F.substring("_h", 1, len(prefix) + DIGITS).alias("p")).agg(F.count("*").alias("n")).collect())
        if wanted is None:
            total = sum(c for _, c in counts)
            wanted = min(n(total) if callable(n) else n, total)
            if wanted <= 0:
                return None, 0
        for prefix, count in counts:
            if before + count >= wanted:
                break
            before += count
        if count <= LEAF_ROWS:
            rows = sorted((r["_h"], r["_t"]) for r in hashed.where(F.col("_h").startswith(prefix)).collect())
            found = rows[wanted - before - 1]
            return found, before + sum(r <= found for r in rows)
        if len(prefix) >= 32:
            # Equal hashes of very many rows: their ties decide.
            ties = hashed.where(F.col("_h") == prefix).groupBy("_t").agg(F.count("*").alias("n"))
            value, extra = _nth_tie(ties, wanted - before)
            return (prefix, value), before + extra


def _nth_tie(ties: DataFrame, n: int) -> tuple:
    """The tie that holds row n of its order, with the number of rows up to it, from ``_t, n`` counts."""
    ranged = stage(ties.repartitionByRange("_t").sortWithinPartitions("_t").withColumn("_part", F.spark_partition_id()), "ties")
    before = 0
    for part, count in sorted((r["_part"], r["c"]) for r in ranged.groupBy("_part").agg(F.sum("n").alias("c")).collect()):
        if before + count >= n:
            break
        before += count
    for r in ranged.where(F.col("_part") == part).sort("_t").toLocalIterator():
        before += r["n"]
        if before >= n:
            return r["_t"], before
    raise AssertionError("the counts hold row n")


def nth_key(df: DataFrame, n: int, *order: str) -> tuple | None:
    """The key of row n (from 1) in the order of the columns ``order``; None when there are fewer rows."""
    keys = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)])
    names = keys.columns
    ranged = keys.repartitionByRange(*names).sortWithinPartitions(*names).select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << LOCAL_BITS) - 1).alias("_local"))
    pinned, before = stage(ranged, "ordered-keys"), 0
    for part, count in sorted((r["_part"], r["n"]) for r in pinned.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        if before + count >= n:
            row = pinned.where((F.col("_part") == part) & (F.col("_local") == n - before - 1)).first()
            return tuple(row[c] for c in names)
        before += count
    return None


def first_rows(df: DataFrame, n: int, *order, kept: int = KEPT_SORTED) -> DataFrame:
    """The first n rows of a total order of columns or expressions.

    Up to ``kept`` rows, every task keeps n and one merges them. Beyond that the n-th key is found first and the rows up to it are a
    filter, so n may be any size. Rows that share the last key, which a total order does not have, would all stay.
    """
    if n <= kept:
        return df.orderBy(*order).limit(n)
    named = df.select("*", *[(F.col(c) if isinstance(c, str) else c).alias(f"_order{i}") for i, c in enumerate(order)])
    names = [f"_order{i}" for i in range(len(order))]
    last = nth_key(named, n, *names)
    return df if last is None else named.where(up_to(names, last)).drop(*names)
