"""Bitmaps of 64-bit hashes: a bounded broadcast table that tells which rows of a large table have no match.

A row whose bit is not set matches nothing, so it needs no shuffle. The others, matches and a few rows that share a bit with
one, are for the caller to compare in full (``same_rows``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITMAP = 1 << 15    # bits of one bitmap: what Spark's bitmap functions make
LISTED = 2048       # bitmaps where the number of hashes is not known beforehand: 8 MB, and no more of them than hashes
# numbers of bitmaps are powers of two: masks and shifts of a hash are never null, so Spark adds no null check that hashes the row again


def hash_of(columns: Sequence[str]) -> str:
    """The 64-bit hash of some columns; a null leaves a hash as it is, so it is told apart."""
    return f"xxhash64({', '.join([*columns, *[f'isnull({c})' for c in columns]])})"


def _place(bitmaps: int) -> tuple[str, str]:
    """The bitmap that a hash is in, and its bit there."""
    return f"shiftright(_hash & {bitmaps * BITMAP - 1}L, {BITMAP.bit_length() - 1})", f"(_hash & {BITMAP - 1}L)"


def bitmaps_of(hashes: DataFrame, bitmaps: int, **marks: str) -> DataFrame:
    """The bitmaps of column ``_hash``: one for each of the ``marks`` (name: which rows set its bits)."""
    at, bit = _place(bitmaps)
    return hashes.groupBy(F.expr(f"{at} AS _map")).agg(
        *[F.expr(f"bitmap_construct_agg({bit}) FILTER (WHERE {rows}) AS {name}") for name, rows in marks.items()])


def asked(df: DataFrame, hashed: str, maps: DataFrame, bitmaps: int, *marks: str) -> DataFrame:
    """The rows with a flag for each of the ``marks``: whether the bit of their hash is set. One broadcast, bounded by ``bitmaps``."""
    own, (at, bit) = df.columns, _place(bitmaps)
    keyed = df.selectExpr("*", f"{hashed} AS _hash").selectExpr("*", f"{at} AS _at", f"CAST({bit} AS int) AS _bit")
    byte = "CAST(conv(hex(substring({}, _bit DIV 8 + 1, 1)), 16, 10) AS int)"
    found = keyed.join(F.broadcast(maps), F.expr("_at = _map"), "left")
    return found.selectExpr(*own, *[f"{m} IS NOT NULL AND getbit({byte.format(m)}, _bit % 8) = 1 AS {m}" for m in marks])


def may_match(df: DataFrame, columns: Sequence[str], listed: DataFrame, flag: str) -> DataFrame:
    """The rows with a flag: false if they differ from every row of ``listed`` (same types, in the order of ``columns``)."""
    hashes = listed.selectExpr(f"{hash_of(listed.columns)} AS _hash")
    return asked(df, hash_of(columns), bitmaps_of(hashes, LISTED, **{flag: "true"}), LISTED, flag)


def same_rows(pairs: Mapping[str, str]) -> str:
    """Null-safe equality of all column pairs: joined by a hash of them, and compared in full where the hashes meet. As keys
    of their own, some thirty columns twice over would be what the rows are sorted by."""
    differ = " + ".join(f"IF({a} <=> {b}, 0, 1)" for a, b in pairs.items())
    return f"{hash_of(list(pairs))} = {hash_of(list(pairs.values()))} AND {differ} = 0"
