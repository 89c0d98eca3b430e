"""Token ids in fixed-width rows: best-fit-decreasing packing with a segment tree, as binary columns.

Each task reads its documents once, in windows of a bounded number of tokens; it encodes them, cuts
overlong ones without loss, and places the pieces of a window from the longest to the shortest, each
into the fullest row that still holds it. A segment tree over residual capacities finds that row.
Nothing is shuffled and no task keeps more than a window.

Null texts are empty documents (the end id alone). Repeated rows are written as often as they occur,
null ids are kept, an empty table gives no rows, extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.tokens import encoder

VOCABULARY = "byte_bpe_50k.tiktoken"
CAPACITY = 4096
END_ID = 50256
#: Tokens that a task gathers before it packs them; a longer document is a window of its own.
WINDOW_TOKENS = 4_000_000
#: ``input_ids``: little-endian uint32, padded with the end id; ``position_ids``: little-endian uint16 or
#: uint32 (capacity over 65,536), counted from 0 in every segment; ``cu_seqlens``: ends of segments after 0.
ROWS = ("sequence_id bigint, n_tokens int, doc_ids array<bigint>, pieces array<int>, cu_seqlens array<int>, "
        "input_ids binary, position_ids binary")


class GapTree:
    """Segment tree over residual gaps 0..capacity, each leaf counting the open rows with that gap."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.total = [0] * (2 * self.leaves)

    def add(self, gap: int, by: int) -> None:
        node = gap + self.leaves
        while node:
            self.total[node] += by
            node >>= 1

    def least_from(self, gap: int) -> int:
        """The smallest gap of an open row that is ``gap`` or more; -1 if there is none."""
        node = gap + self.leaves
        if self.total[node]:
            return gap
        while node > 1 and (node & 1 or not self.total[node + 1]):
            node >>= 1
        if node <= 1:
            return -1
        node += 1
        while node < self.leaves:
            node = 2 * node if self.total[2 * node] else 2 * node + 1
        return node - self.leaves


def best_fit(sizes: list[int], capacity: int) -> list[list[int]]:
    """Rows of unit numbers; units are placed in the given order (the longest first)."""
    tree, rows = GapTree(capacity), []
    by_gap: dict[int, list[int]] = {}
    for i, size in enumerate(sizes):
        gap = tree.least_from(size)
        if gap < 0:
            gap, row = capacity, len(rows)
            rows.append([])
        else:
            row = by_gap[gap].pop()
            tree.add(gap, -1)
        rows[row].append(i)
        if gap > size:
            by_gap.setdefault(gap - size, []).append(row)
            tree.add(gap - size, 1)
    return rows


def pack_ids(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID,
             window_tokens: int = WINDOW_TOKENS) -> DataFrame:
    """Packed rows (``ROWS``) of the documents' ids; ``docs`` has ``doc_id`` and ``text``.

    A row number is the task's number and the place in its result, so a repeated task writes the same.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    schema = pa.schema([
        ("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
        ("pieces", pa.list_(pa.int32())), ("cu_seqlens", pa.list_(pa.int32())), ("input_ids", pa.binary()),
        ("position_ids", pa.binary())])
    end = np.uint32(end_id).astype("<u4").tobytes()
    counts = np.arange(capacity, dtype="<u2" if capacity <= 1 << 16 else "<u4")
    per_batch = max(1, 16_000_000 // (capacity * 6))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, done = encoder(path).encode, TaskContext.get().partitionId() << 32
        window: list[tuple[int, int, bytes]] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal done
            window.sort(key=lambda u: -len(u[2]))  # stable: equal lengths stay in the order of the input
            rows = best_fit([len(u[2]) // 4 for u in window], capacity)
            for at in range(0, len(rows), per_batch):
                out = []
                for row in rows[at:at + per_batch]:
                    units = [window[i] for i in row]
                    sizes = [len(u[2]) // 4 for u in units]
                    ends = np.cumsum([0, *sizes])
                    pad = capacity - int(ends[-1])
                    positions = np.concatenate([*(counts[:n] for n in sizes), counts[:pad]])
                    out.append({
                        "sequence_id": done, "n_tokens": int(ends[-1]), "doc_ids": [u[0] for u in units],
                        "pieces": [u[1] for u in units], "cu_seqlens": ends.tolist(),
                        "input_ids": b"".join([*(u[2] for u in units), end * pad]), "position_ids": positions.tobytes()})
                    done += 1
                yield pa.RecordBatch.from_pylist(out, schema)
            window.clear()

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids, width = encode(text.as_py()) + end, 4 * capacity
                window += [(doc_id, k, ids[at:at + width]) for k, at in enumerate(range(0, len(ids), width))]
                held += len(ids) // 4
                if held >= window_tokens:
                    yield from packed()
                    held = 0
        yield from packed()

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(tasks, ROWS)
