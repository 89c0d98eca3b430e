"""Sum-of-squares packing of documents into sequences of a fixed length.

Every piece goes where the sum, over residual gaps, of the squared number of open sequences with that
gap becomes smallest; a new sequence is one of the choices. Pieces are dealt by a hash to shards of
bounded size and placed there from the longest to the shortest. Sequences that a shard leaves open are
units for a second, smaller round of shards, which the same rule packs again; its remains go to a
third, and so on while there is more than one shard.

Null texts are empty documents (one token). Repeated rows are packed as often as they occur. Null ids
are kept. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.tokens import encoder
from rostrum.sources.sinks import stored

VOCABULARY = "word_bpe_49k.json"
CAPACITY = 4096
END_ID = 1
#: Pieces, or open sequences, that one shard packs on average.
SHARD_UNITS = 16_384
PIECES = "array<struct<piece:int,start:bigint,length:bigint,ids_crc32:bigint>>"


def text_pieces(text: Column, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> Column:
    """The pieces of a text: its ids and ``end_id``, cut after every ``capacity`` ids."""
    path = path or public_tokenizers.path(VOCABULARY)
    end = np.uint32(end_id).astype("<u4").tobytes()

    @F.arrow_udf(PIECES)
    def pieces(texts: pa.Array) -> pa.Array:
        encode = encoder(path).encode
        bounds, rows = [0], []
        for t in texts:
            ids, width = encode(t.as_py()) + end, 4 * capacity
            rows += [(k, k * capacity, len(part := ids[at:at + width]) // 4, zlib.crc32(part))
                     for k, at in enumerate(range(0, len(ids), width))]
            bounds.append(len(rows))
        table = np.array(rows, dtype=np.int64).reshape(-1, 4)
        columns = [pa.array(table[:, 0].astype(np.int32)), *(pa.array(table[:, i]) for i in (1, 2, 3))]
        return pa.ListArray.from_arrays(
            pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, ["piece", "start", "length", "ids_crc32"]))

    return pieces(F.coalesce(text, F.lit("")))


def place(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """The bin and the offset of every unit, in the given order; sizes from 1 to ``capacity``."""
    counts = np.zeros(capacity + 1, dtype=np.int64)  # of open bins by gap; 0 and capacity stay 0
    squares = np.zeros(capacity + 1, dtype=np.int64)  # twice the count: what a change by one costs
    closed = np.iinfo(np.int64).max // 4
    leave = np.full(capacity + 1, closed, dtype=np.int64)  # 2 - 2 * count where a bin is open
    bins: dict[int, list[int]] = defaultdict(list)
    where, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    opened = 0

    def change(gap: int, by: int) -> None:
        if 0 < gap < capacity:
            counts[gap] += by
            squares[gap] = 2 * counts[gap]
            leave[gap] = 2 - 2 * counts[gap] if counts[gap] else closed

    for i, size in enumerate(sizes.tolist()):
        costs = leave[size:] + squares[:capacity + 1 - size]
        costs[0] -= 1  # a full bin has no gap to count
        best = int(costs.argmin())
        if costs[best] <= 1 + squares[capacity - size] - (size == capacity):
            gap = best + size
            b = bins[gap].pop()
            change(gap, -1)
        else:
            gap, b = capacity, opened
            opened += 1
        where[i], offset[i] = b, capacity - gap
        change(gap - size, 1)
        if gap > size:
            bins[gap - size].append(b)
    return where, offset


def _dealt(units: DataFrame, keys: list[str], shard_units: int) -> tuple[DataFrame, int]:
    shards = -(-units.count() // shard_units) or 1
    return units.withColumn("shard", F.pmod(F.xxhash64(*keys), F.lit(shards)).cast("int")), shards


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_units: int = SHARD_UNITS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` with their ``sequence_id`` and ``offset``."""
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = pieces.select(*keys)

    def first(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable")
        bins, offset = place(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=bins + (group["shard"].to_numpy(np.int64) << 32), offset=offset)[[*keys, "sequence_id", "offset"]]

    def again(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["size", "sequence_id"], ascending=[False, True])
        bins, offset = place(group["size"].to_numpy(), capacity)
        own = group["sequence_id"].to_numpy()
        starts = np.zeros(bins.max() + 1, np.int64)
        starts[bins[offset == 0]] = own[offset == 0]  # a sequence keeps the number of its first unit
        return pd.DataFrame({"sequence_id": own, "to_id": starts[bins], "base": offset})

    dealt, shards = _dealt(pieces, keys, shard_units)
    schema = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in pieces.schema)}, sequence_id long, offset long"
    placed = stored(dealt.groupBy("shard").applyInPandas(first, schema), "packed")
    while shards > 1:
        open_units = placed.groupBy("sequence_id").agg(F.sum("length").alias("size")).filter(F.col("size") < capacity)
        units, fewer = _dealt(stored(open_units, "open"), ["sequence_id"], shard_units)
        if fewer >= shards:
            break
        moves = units.groupBy("shard").applyInPandas(again, "sequence_id long, to_id long, base long")
        placed = stored(placed.join(moves, "sequence_id", "left").select(
            *keys, F.coalesce("to_id", "sequence_id").alias("sequence_id"),
            (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset")), "packed")
        shards = fewer
    return placed


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, shard_units: int = SHARD_UNITS) -> DataFrame:
    """One row per piece of every document; ``docs`` has ``doc_id`` and ``text``."""
    pieces = docs.select("doc_id", text_pieces(F.col("text"), path, capacity).alias("p")).select("doc_id", F.inline_outer("p"))  # no filter on the pieces, for which they would be made twice
    return pack_pieces(stored(pieces, "pieces"), capacity, shard_units)
