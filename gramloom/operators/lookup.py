"""Equi-join of many rows with a large table when some keys are very frequent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SALTS = 16


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], row_id: list[str],
           how: str = "inner", salts: int = SALTS, few: bool = False) -> DataFrame:
    """Join ``rows`` to ``table`` on ``keys``; ``row_id`` spreads rows that share a key.

    The distinct (key, salt) pairs of ``rows`` meet the table first: a key held by any
    number of rows comes at most ``salts`` times, and the map side has already collapsed
    it. What was found then goes back to the rows on (key, salt), so a hot key's rows are
    split ``salts`` ways, and only the needed part of the table is replicated. Small
    sides are broadcast by Spark on their measured size. With ``few``, for keys that are few
    beside a bucketed table, the hash table is built on the keys, so the table streams by unsorted.
    """
    salt: Column = F.pmod(F.xxhash64(*row_id), F.lit(salts)).cast("int")
    salted = rows.withColumn("salt", salt)
    needed = salted.select(*keys, "salt").distinct()
    found = table.join(needed.hint("shuffle_hash"), keys) if few else needed.join(table, keys)
    return salted.join(found, [*keys, "salt"], how).drop("salt")
