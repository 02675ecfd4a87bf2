"""Latest value per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F


def latest_per_key(df: DataFrame, keys, ts: str | None, tie_break=()) -> DataFrame:
    """The newest row of each key; equal times go to the highest ``tie_break``.

    With ``ts=None`` event time is ignored and the tie-break alone decides. Each task reduces its own rows
    first, so a key that holds much of the data costs one row per task in the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = [*([ts] if ts else []), *tie_break]
    if not order:
        raise ValueError("an order needs the event time or a tie-break column")
    if ts:
        df = df.where(F.col(ts).isNotNull())
    newest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(*[c if c in keys else F.col("_row")[c].alias(c) for c in df.columns])


def time_window(df: DataFrame, ts: str, start: dt.datetime | None, end: dt.datetime) -> DataFrame:
    """Rows with ``start < ts <= end``; the bounds reach the Parquet scan."""
    kind = df.schema[ts].dataType
    bounded = df.where(F.col(ts) <= F.lit(end.isoformat(sep=" ")).cast(kind))
    if start is None:
        return bounded
    return bounded.where(F.col(ts) > F.lit(start.isoformat(sep=" ")).cast(kind))


def online_lookup(requests: DataFrame, table: DataFrame, keys, columns) -> DataFrame:
    """Feature columns for the requested keys, NULL where a key is unknown; ``table`` has one row per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return requests.join(table.select(*keys, *columns), keys, "left")
