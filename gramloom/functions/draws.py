"""Reproducible pseudo-random numbers derived from row keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_HEX_DIGITS = 13  # 52 bits: exact in a double


def unit_draw(*parts: Column) -> Column:
    """A number in [0, 1) fixed by the given parts, whatever the partitioning."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    bits = F.conv(F.substring(digest, 1, _HEX_DIGITS), 16, 10).cast("long")
    return bits / F.lit(float(16**_HEX_DIGITS))


def pick_below(unit: Column, total: Column) -> Column:
    """Turn a unit draw into an integer in [0, total)."""
    return F.least(F.floor(unit * total).cast("long"), total - 1)


def hash_bucket(key: Column, digits: int = 3) -> Column:
    """Leading hex digits of the key's md5: at most 16**digits evenly filled buckets."""
    return F.substring(F.md5(key), 1, digits)
