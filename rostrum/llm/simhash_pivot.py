"""SimHash near-duplicates by tables of distances to reference fingerprints.

References: one base, and for each of eight ranges of bits a family of eight that differs from the base
in more and more bits of that range. A row of the table holds a fingerprint's Hamming distances to all
65. Against the distance to the base, a family's distances depend on its own range only, so two
fingerprints within ``radius`` bits have equal coordinates in all but ``radius`` families. Each
fingerprint is filed once for every choice of families left out; pairs in the same file are discarded
when a coordinate differs by more than ``radius`` (no nearer pair can, by the triangle inequality), and
the survivors are verified bit by bit. A file holds at most 2 ** (8 * radius) different fingerprints,
however many documents there are, and gives a spanning forest of its links instead of all pairs.

Documents without words have fingerprint zero and link like any other. Null texts are empty. Repeated
rows are linked as often as they occur; null ids are never the smallest of a class. An empty table
gives no rows. Extra columns are ignored (``classes``) or kept (``keep_one``).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import KEY, keep_keys, with_key
from rostrum.llm.graph import components
from rostrum.sources.sinks import stored

SHINGLE = 3
SEED = 42
RADIUS = 2
RANGES = 8  # of eight bits
BASE = np.uint64(0x9E3779B97F4A7C15)
MASKS = np.array([[((2 << j) - 1) << (8 * g) for j in range(8)] for g in range(RANGES)], dtype=np.uint64)
REFERENCES = np.concatenate([[BASE], (BASE ^ MASKS).ravel()])


def _bits(digests: bytes) -> np.ndarray:
    """How many digests have each of the 64 bits, the highest first."""
    bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
    whole = len(bits) // 255 * 255
    return bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64) + bits[whole:].sum(axis=0, dtype=np.int64)


def fingerprint_of(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of UTF-8 text: a bit is 1 where over half the shingles' hashes have it."""
    words = text.lower().split()
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(joined, seed), "big", signed=True)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[:len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1:] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for at in range(0, len(starts), 51_000):
        counts += _bits(b"".join([digest(joined[a:b], seed) for a, b in zip(starts[at:at + 51_000], stops[at:at + 51_000])]))
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def fingerprint(text: Column, shingle: int = SHINGLE, seed: int = SEED) -> Column:
    @F.arrow_udf("bigint")
    def column(texts: pa.Array) -> pa.Array:
        return pa.array([fingerprint_of(t.as_buffer().to_pybytes(), shingle, seed) for t in texts], pa.int64())

    return column(F.coalesce(text, F.lit("")))


def distance_table(prints: np.ndarray) -> np.ndarray:
    """Hamming distances of uint64 fingerprints to the references, one row each."""
    return np.bitwise_count(prints[:, None] ^ REFERENCES).astype(np.int8)


def file_keys(table: np.ndarray, radius: int) -> np.ndarray:
    """A key for every choice of families left out: a hash of the other families' coordinates."""
    family = (table[:, 1:] - table[:, :1] + np.int8(8)).astype(np.uint64).reshape(-1, RANGES, 8)
    code = (family * np.uint64(17) ** np.arange(8, dtype=np.uint64)).sum(axis=2)
    mixed = (code + np.arange(1, RANGES + 1, dtype=np.uint64) * BASE) * np.uint64(0xD6E8FEB86659FD93)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    total = mixed.sum(axis=1)
    choices = list(combinations(range(RANGES), radius))
    keys = np.stack([total - sum(mixed[:, g] for g in out) for out in choices], axis=1)
    return keys + np.arange(len(choices), dtype=np.uint64) * BASE


def near_links(keys: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """For each row of files (equal ``keys`` adjacent) the first row of the file that it is linked to."""
    table = distance_table(prints)
    root = np.arange(len(keys))
    for step in range(1, len(keys)):
        i = np.flatnonzero(keys[step:] == keys[:-step])
        if not len(i):
            break
        i = i[root[i] != root[i + step]]
        for some in np.array_split(i, len(i) // 50_000 + 1):
            difference = np.abs(table[some] - table[some + step]).max(axis=1, initial=0)
            some = some[difference <= radius]
            some = some[np.bitwise_count(prints[some] ^ prints[some + step]) <= radius]
            for a, b in zip(some.tolist(), (some + step).tolist()):
                while root[a] != a:
                    a = root[a]
                while root[b] != b:
                    b = root[b]
                root[max(a, b)] = min(a, b)
        while (root != root[root]).any():
            root = root[root]
    return root


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``u, v``: links that connect whatever different ``fingerprint``s lie within ``radius`` bits."""
    edge = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def filed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy(zero_copy_only=False)
            keys = file_keys(distance_table(own.view(np.uint64)), radius)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(own, keys.shape[1]))], ["file", "fingerprint"])

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(keys: np.ndarray, own: np.ndarray) -> pa.RecordBatch:
            shared = np.zeros(len(keys), bool)
            shared[1:] |= keys[1:] == keys[:-1]
            shared[:-1] |= keys[1:] == keys[:-1]
            keys, own = keys[shared], own[shared]
            root = near_links(keys, own.view(np.uint64), radius)
            moved = np.flatnonzero(root != np.arange(len(root)))
            return pa.RecordBatch.from_arrays([pa.array(own[moved]), pa.array(own[root[moved]])], schema=edge)

        keys, own = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            own = np.concatenate([own, batch.column(1).to_numpy(zero_copy_only=False)])
            cut = int(np.searchsorted(keys, keys[-1])) if len(keys) else 0  # the last file may go on
            yield found(keys[:cut], own[:cut])
            keys, own = keys[cut:], own[cut:]
        yield found(keys, own)

    files = prints.select("fingerprint").mapInArrow(filed, "file bigint, fingerprint bigint")
    return files.repartition("file").sortWithinPartitions("file", "fingerprint").mapInArrow(linked, "u bigint, v bigint")


def print_classes(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``fingerprint, first`` (one row each) with the smallest ``first`` of the class, ``class_first``."""
    roots = components(links(prints, radius))
    joined = prints.join(roots, prints["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    least = joined.groupBy("root").agg(F.min("first").alias("class_first"))
    return joined.join(least, "root").select("fingerprint", "class_first")


def classes(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fingerprint`` (16 hexadecimal digits), ``component_id`` (smallest id reachable)."""
    rows = stored(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fingerprint")), "prints")
    prints = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "prints")
    return rows.join(print_classes(prints, radius), "fingerprint").select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), F.col("class_first").alias("component_id"))


def keep_one(docs: DataFrame, radius: int = RADIUS, shingle: int = SHINGLE) -> DataFrame:
    """The document with the smallest id of each class (a null id only where there is no other; the
    smallest text hash among equal ids; one of equal rows), with all columns."""
    rows = with_key(docs).select("doc_id", *KEY, fingerprint(F.col("text"), shingle).alias("fingerprint"))
    rows = stored(rows, "prints")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), *KEY)
    prints = stored(rows.groupBy("fingerprint").agg(F.min(order).alias("first")), "prints")
    kept = print_classes(prints, radius).select("class_first").distinct()
    return keep_keys(docs, kept.select(*[F.col(f"class_first.{k}").alias(k) for k in KEY]))
