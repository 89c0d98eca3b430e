"""Membership bitmaps: rows that surely are not stored yet skip the shuffle of an anti-join.

The keys of the stored table set bits of a bitmap, which is kept as parts of 32,768 bits. A row whose bit is not
set is new; only rows whose bit is set go on to the anti-join, so the rows are the same whatever the
bitmap's size, and only the number of rows shuffled depends on it. The bitmap is broadcast: its size is set
from the number of stored rows and never beyond a limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.operators.lookup import BROADCAST_LIMIT, PERSON, keyed_join
from rostrum.sources.sinks import stored

#: Fixed by Spark's bitmap functions: bits in a part.
PART_BITS = 32768
#: Bits for each stored row: with 16, about 6 in 100 new rows are shuffled all the same.
BITS_PER_ROW = 16
_PART, _BITS, _BIT = "membership__part", "membership__bits", "membership__bit"


class Membership(NamedTuple):
    parts: DataFrame  # a row for each part that has a bit set
    bits: int
    keys: list[str]
    types: list[str]


def _bit(keys: Sequence[str], bits: int) -> Column:
    """The bit of a key, from 1; NULL where a part of the key is, as such keys match nothing."""
    whole = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1
    for key in keys:
        whole = F.when(F.col(key).isNotNull(), whole)
    return whole


def membership(known: DataFrame, keys: Sequence[str], bits_per_row: int = BITS_PER_ROW, limit: int = BROADCAST_LIMIT) -> Membership:
    """The bitmap of a stored table, at most ``limit`` bytes (one part at least). Two passes over its key columns, the
    second with a partial aggregation, so what is shuffled is parts, not rows."""
    keys = list(keys)
    known = known.select(*keys).dropna()
    wanted = -(-known.count() * bits_per_row // PART_BITS)
    bits = max(1, min(wanted, limit * 8 // PART_BITS)) * PART_BITS
    at = known.select(_bit(keys, bits).alias(_BIT))
    parts = at.groupBy(F.bitmap_bucket_number(_BIT).alias(_PART)).agg(F.bitmap_construct_agg(F.bitmap_bit_position(_BIT)).alias(_BITS))
    return Membership(stored(parts, "membership"), bits, keys, [t for _, t in known.dtypes])


def error_rate(found: Membership) -> float:
    """The share of bits set: how many of the new keys are shuffled although they are not stored."""
    return (found.parts.agg(F.sum(F.bitmap_count(_BITS))).first()[0] or 0) / found.bits


def maybe_known(df: DataFrame, found: Membership, name: str) -> DataFrame:
    """Adds the boolean ``name``: false for rows whose key surely is not in the stored table."""
    if [dict(df.dtypes)[k] for k in found.keys] != found.types:
        raise ValueError(f"keys {found.keys} must have the stored table's types {found.types}")
    placed = df.withColumn(_BIT, _bit(found.keys, found.bits)).withColumn(_PART, F.bitmap_bucket_number(_BIT))
    joined = placed.join(F.broadcast(found.parts), _PART, "left")
    bit = F.bitmap_bit_position(_BIT)
    byte = F.conv(F.hex(F.substring(_BITS, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, F.pmod(bit, F.lit(8)).cast("int")) == 1
    return joined.select(*df.columns, F.coalesce(is_set, F.lit(False)).alias(name))


def not_stored(df: DataFrame, known: DataFrame, keys: Sequence[str], found: Membership | None = None) -> DataFrame:
    """Rows of ``df`` whose key is not in ``known``; rows with a NULL in the key are not. ``df`` is read by two
    branches, so it should be a table or cheap to compute; ``found`` may be kept for several feeds."""
    found = found or membership(known, keys)
    marked = maybe_known(df, found, "membership__maybe")
    new = marked.filter(~F.col("membership__maybe")).drop("membership__maybe")
    asked = marked.filter("membership__maybe").drop("membership__maybe")
    return new.unionByName(keyed_join(asked, known.select(*keys).dropna().distinct(), keys, "left_anti", False))


def new_politicians_by_bitmap(df: DataFrame, known: DataFrame, dedupe: bool = False) -> DataFrame:
    """``lookup.new_politicians`` for politicians too many to broadcast, in feeds of mostly new people."""
    new = not_stored(df, known, PERSON)
    return new.dropDuplicates(list(PERSON)) if dedupe else new
