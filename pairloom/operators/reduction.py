"""Semi-join reduction: rows whose key cannot be wanted are left out at the scan, before they are exchanged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from pairloom.session import BROADCAST_ROWS

MAX_BITS = 27            # the largest filter has 2^27 bits, 16 MiB
BITS_PER_KEY = 8
BUCKET_BITS = 15         # bits of one row of the filter, as the bitmap functions cut them


def _slot(key: Column, bits: int) -> Column:
    """The bit of a key, from 0."""
    return F.pmod(F.xxhash64(key), F.lit(1 << bits))


def key_filter(keys: DataFrame, column: str, bits: int) -> DataFrame:
    """``bucket, bitmap``: 2^bits bits in rows of 32,768, with the bit of every key set; built by partial aggregates."""
    slot = keys.select(_slot(F.col(column), bits).alias("_slot"))
    return slot.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap"))


def maybe_known(df: DataFrame, column: str, bitmap: DataFrame, bits: int) -> DataFrame:
    """Rows whose key's bit is set; ``bitmap`` has at most 2^(bits - 15) rows of 4 KiB, so it is broadcast."""
    slot = _slot(F.col(column), bits)
    placed = df.withColumn("_bucket", F.bitmap_bucket_number(slot)).withColumn("_bit", F.bitmap_bit_position(slot))
    byte = F.conv(F.hex(F.substring("_bitmap", F.expr("cast(_bit div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    hit = F.expr("shiftright(_byte, cast(_bit % 8 as int)) & 1") == 1
    return placed.join(F.broadcast(bitmap), "_bucket").withColumn("_byte", byte).where(hit).select(*df.columns)


def only_known(df: DataFrame, column: str, keys: DataFrame, exact_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` without most rows whose key is not in ``keys``, a stored table with a column of the same name.

    Up to ``exact_rows`` distinct keys, counted, the keys themselves are broadcast and exactly their rows stay. Beyond that a
    filter of a few bits per key, 16 MiB at most, lets some others through; every known key stays either way. For use before an inner or
    semi join with the keys.
    """
    distinct = keys.select(column).distinct()
    n = distinct.count()
    if n <= exact_rows:
        return df.join(F.broadcast(distinct), column, "left_semi")
    bits = max(BUCKET_BITS, min(MAX_BITS, (n * BITS_PER_KEY - 1).bit_length()))
    return maybe_known(df, column, key_filter(keys, column, bits), bits)
