"""Reproducible draws: every random choice is a function of (seed, key) through md5."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _joined(parts) -> Column:
    return F.concat_ws(":", *[p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts])


def shuffle_key(*parts) -> Column:
    """32 hex digits that put rows in a seeded random order; plain values are literals."""
    return F.md5(_joined(parts).cast("binary"))


def draw(*parts) -> Column:
    """A number uniform on [0, 2^32): the first eight hex digits of the md5."""
    return F.conv(F.substring(shuffle_key(*parts), 1, 8), 16, 10).cast("bigint")
