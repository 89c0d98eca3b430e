"""Hard negatives by segment summaries that bound inner products.

A vector is cut into segments. For a segment of ``d`` components with means ``m, m'`` and deviations
``s, s'`` the inner product lies between ``d (m m' - s s')`` and ``d (m m' + s s')`` (Cauchy-Schwarz on
what is left after the means), so the summaries of a vector bound its whole product with another one.
Bounds are taken with few long segments first; pairs that they cannot discard are bounded again with
shorter segments (``SEGMENTS``), and what is left is scored exactly.

Rows are dealt by hash into packs of some ``ROW_PACK``, anchors into packs of some ``ANCHOR_PACK``, and every
anchor pack meets every row pack in a task of its own: the anchors are the query set, the packs bound
memory. A pack gives the few best rows of each anchor, and one ranking per anchor merges them; its first
step is taken in the packs' tasks. The first pass finds each anchor's positives: a pair goes when
its upper bound is below ``positives`` lower bounds of rows of the anchor's label. The second finds negatives: a pair goes
when its bounds lie outside each of the anchor's windows, or below as many rows that surely are inside.

Scores are integers and exact: in doubles while sums stay below 2 ** 53, else in whole numbers of any
size; a result beyond 64 bits is an error. Rows with a null id or label, a null vector or a null or
non-finite component take no part. Equal rows count once; rows that share an id only are rows of their
own. Shorter vectors are filled with zeros; an empty vector scores zero. Ties go by smaller id, then by
the rows' keys. Anchors without positives, and positives without negatives, give no rows; neither does
an empty table. Extra columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.sources.sinks import stored

SEGMENTS = (4, 16)
ROW_PACK = 4096
ANCHOR_PACK = 1024
SCALE = 256
POSITIVES = 5
NEGATIVES = 3
#: Negatives score from 50 to 95 hundredths of the positive's score.
SHARES = (50, 95)
#: Of the terms' absolute sum: what rounding may add to a bound.
SLACK = 1e-9
#: Pairs are scored singly where fewer than this share of a pack's pairs is left, else all at once.
FEW = 0.05
EXACT = float(1 << 53)


def usable(rows: DataFrame, vector: str, label: Column, anchor: Column) -> DataFrame:
    """``vec_id, label, anchor, vector`` (doubles) and a ``row`` key of the rows that take part, equal ones once."""
    values = F.col(vector).cast("array<double>")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col(vector).isNotNull() & finite)
    rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.cast("bigint").alias("label"), values.alias("vector")).distinct()
    return rows.withColumns({"anchor": anchor, "row": F.xxhash64("vec_id", "label", "vector")})


# ---- packs -----------------------------------------------------------------------------------

def whole(vectors: list[np.ndarray], scale: int) -> np.ndarray:
    """Scaled components as whole numbers, one row a vector: doubles while they are exact, else Python's integers."""
    matrix = np.zeros((len(vectors), max(map(len, vectors), default=0)))
    for k, v in enumerate(vectors):
        matrix[k, :len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(matrix * scale)
    if not np.isfinite(scaled).all():
        raise OverflowError("a component is too large to be scaled")
    if np.abs(scaled).max(initial=0) < EXACT:
        return scaled
    return np.array([[int(x) for x in row] for row in scaled], object)


def summary(matrix: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations, times the root of the segment's length; of all-zero columns where there are too few."""
    width = -(-max(1, matrix.shape[1]) // segments)
    padded = np.zeros((len(matrix), width * segments))
    padded[:, :matrix.shape[1]] = matrix
    parts = padded.reshape(len(matrix), segments, width)
    return parts.mean(axis=2) * width ** 0.5, parts.std(axis=2) * width ** 0.5


def pack(rows: DataFrame, block: Column, columns: tuple[str, ...], scale: int) -> DataFrame:
    """``block, pack``: the rows of each block as one pickled dict of arrays, vectors as whole numbers."""
    def packed(table: pa.Table) -> pa.Table:
        flat = table.column("vector").combine_chunks()
        vectors = [np.asarray(v.values.to_numpy(zero_copy_only=False), float) for v in flat]
        held = {c: table.column(c).to_numpy() for c in columns} | {"matrix": whole(vectors, scale)}
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "pack": pa.array([pickle.dumps(held)], pa.binary())})

    dealt = rows.withColumn("block", block.cast("bigint")).select("block", *columns, "vector")
    return dealt.groupBy("block").applyInArrow(packed, "block bigint, pack binary")


def met(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Every pack of anchors beside every pack of rows, dealt by both numbers."""
    to = lambda n: F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))
    left = anchors.select(F.col("block").alias("a"), F.col("pack").alias("anchors"), F.explode(to(n_rows)).alias("r"))
    right = rows.select(F.col("block").alias("r"), F.col("pack").alias("rows"), F.explode(to(n_anchors)).alias("a"))
    return left.join(right.hint("merge"), ["a", "r"]).select("anchors", "rows")


# ---- bounds and scores -----------------------------------------------------------------------

def bounds(a: np.ndarray, b: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all inner products of two matrices' rows."""
    (m, s), (n, t) = summary(a, segments), summary(b, segments)
    middle, width = m @ n.T, s @ t.T
    width = width + SLACK * (np.abs(m) @ np.abs(n).T + width) + 1e-6
    return middle - width, middle + width


def filled(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two matrices with as many columns, the narrower one filled with zeros."""
    width = max(a.shape[1], b.shape[1])
    fit = lambda x: np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x
    return fit(a), fit(b)


def scores(a: np.ndarray, b: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row of ``a``, row of ``b`` and exact score of the pairs that ``left`` marks."""
    i, j = np.nonzero(left)
    big = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * a.shape[1]
    if a.dtype == object or b.dtype == object or big >= EXACT:
        whole_a, whole_b = ([[int(x) for x in row] for row in m] for m in (a, b))
        found = [sum(x * y for x, y in zip(whole_a[p], whole_b[q])) for p, q in zip(i.tolist(), j.tolist())]
        return i, j, np.array(found, np.int64) if found else np.empty(0, np.int64)
    if len(i) > FEW * left.size:
        return i, j, (a @ b.T)[i, j].astype(np.int64)
    step = max(1, (1 << 22) // max(1, a.shape[1]))
    parts = [np.einsum("ij,ij->i", a[i[k:k + step]], b[j[k:k + step]]) for k in range(0, len(i), step)]
    return i, j, np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)


def kth(values: np.ndarray, among: np.ndarray, k: int) -> np.ndarray:
    """For each row the ``k``-th largest value among those marked; minus infinity where there are fewer."""
    held = np.where(among, values, -np.inf)
    return np.partition(held, -k, axis=1)[:, -k] if held.shape[1] >= k else np.full(len(held), -np.inf)


def leading(order: list[np.ndarray], group: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each group, by ``order`` (the last key counts most)."""
    by = np.lexsort([*order, group])
    group = group[by]
    first = np.r_[0, np.flatnonzero(group[1:] != group[:-1]) + 1] if len(group) else np.empty(0, int)
    nth = np.arange(len(group)) - np.repeat(first, np.diff(np.r_[first, len(group)]))
    return by[nth < k]


def near_rows(anchors: dict, rows: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, row and score of the best ``k`` other rows of each anchor's label in a pack."""
    a, b = filled(anchors["matrix"], rows["matrix"])
    left = (anchors["label"][:, None] == rows["label"]) & (anchors["row"][:, None] != rows["row"])
    for segments in SEGMENTS:
        if segments < a.shape[1] and left.any():
            low, high = bounds(a, b, segments)
            left &= high >= kth(low, left, k)[:, None]
    i, j, score = scores(a, b, left)
    best = leading([rows["row"][j], rows["vec_id"][j], -score], i, k)
    return i[best], j[best], score[best]


def window_rows(anchors: dict, rows: dict, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, window, row and score of the best ``k`` rows of other labels in each of the anchors' windows in a pack.

    ``low`` and ``high`` of the anchors hold their windows (whole numbers, both ends inside), one column each.
    """
    a, b = filled(anchors["matrix"], rows["matrix"])
    left = anchors["label"][:, None] != rows["label"]
    lows, highs = anchors["low"], anchors["high"]
    for segments in SEGMENTS:
        if segments < a.shape[1] and left.any():
            low, high = bounds(a, b, segments)
            some = np.zeros_like(left)
            for w in range(lows.shape[1]):
                from_, to = lows[:, w, None].astype(float), highs[:, w, None].astype(float)
                sure = kth(low, left & (low >= from_) & (high <= to), k)
                some |= (high >= np.maximum(from_[:, 0], sure)[:, None]) & (low <= to)
            left &= some
    i, j, score = scores(a, b, left)
    found = []
    for w in range(lows.shape[1]):
        inside = np.flatnonzero((score >= lows[i, w]) & (score <= highs[i, w]))
        best = inside[leading([rows["row"][j[inside]], rows["vec_id"][j[inside]], -score[inside]], i[inside], k)]
        found.append((i[best], np.full(len(best), w), j[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found))


# ---- the two passes --------------------------------------------------------------------------

def packs_of(rows: DataFrame, scale: int) -> tuple[DataFrame, int, int]:
    """Stored packs of all rows, and how many packs of rows and of anchors there are to be."""
    n, n_anchors = rows.agg(F.count("*"), F.count_if("anchor")).first()
    n_rows, n_anchors = -(-n // ROW_PACK), -(-n_anchors // ANCHOR_PACK)
    packs = pack(rows, F.pmod("row", F.lit(max(1, n_rows))), ("row", "vec_id", "label"), scale)
    return stored(packs, "packs"), n_rows, n_anchors


def positives(rows: DataFrame, packs: DataFrame, n_rows: int, n_anchors: int, k: int = POSITIVES, scale: int = SCALE) -> DataFrame:
    """``anchor, anchor_id, positive, positive_id, positive_score``: the best other rows of each anchor's label."""
    anchors = pack(rows.filter("anchor"), F.pmod(F.xxhash64("row"), F.lit(n_anchors)), ("row", "vec_id", "label"), scale)

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(batch.column(0), batch.column(1)):
                a, b = pickle.loads(one.as_buffer()), pickle.loads(other.as_buffer())
                i, j, score = near_rows(a, b, k)
                columns = [a["row"][i], a["vec_id"][i], b["row"][j], b["vec_id"][j], score]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "anchor_id", "positive", "positive_id", "positive_score"])

    near = met(anchors, packs, n_anchors, n_rows).mapInArrow(
        found, "anchor bigint, anchor_id bigint, positive bigint, positive_id bigint, positive_score bigint")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    return near.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= k)


def mine(rows: DataFrame, vector: str, label: Column, anchor: Column, n_positives: int = POSITIVES, n_negatives: int = NEGATIVES,
         shares: tuple[int, int] = SHARES, scale: int = SCALE) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` have ``vec_id``, ``label`` and ``vector``; ``label`` gives the label that counts, ``anchor`` marks anchors.
    """
    rows = stored(usable(rows, vector, label, anchor), "vectors")
    packs, n_rows, n_anchors = packs_of(rows, scale)
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    if not n_rows or not n_anchors:
        return rows.sparkSession.createDataFrame([], schema)
    best = stored(positives(rows, packs, n_rows, n_anchors, n_positives, scale), "positives")
    # a window's ends, rounded inwards; an empty one where the positive's score is negative
    score = F.col("positive_score").cast("decimal(38,0)")
    low, high = F.ceil(score * shares[0] / 100), F.floor(score * shares[1] / 100)
    windows = best.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct(
        "nth", low.cast("bigint").alias("low"), high.cast("bigint").alias("high")))).alias("windows"))
    asked = rows.filter("anchor").join(windows, rows["row"] == windows["anchor"]).select(
        "row", "vec_id", "label", "vector", *[F.transform("windows", lambda w: w[end]).alias(end) for end in ("low", "high")])

    def with_windows(held: dict) -> dict:
        for end, empty in (("low", 1), ("high", 0)):
            table = np.full((len(held[end]), n_positives), empty, np.int64)
            for k, values in enumerate(held[end]):
                table[k, :len(values)] = values
            held[end] = table
        return held

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one, other in zip(batch.column(0), batch.column(1)):
                a, b = with_windows(pickle.loads(one.as_buffer())), pickle.loads(other.as_buffer())
                i, w, j, score = window_rows(a, b, n_negatives)
                columns = [a["row"][i], w + 1, b["row"][j], b["vec_id"][j], score]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "nth", "negative", "negative_id", "negative_score"])

    anchors = pack(asked, F.pmod(F.xxhash64("row"), F.lit(n_anchors)), ("row", "vec_id", "label", "low", "high"), scale)
    inside = met(anchors, packs, n_anchors, n_rows).mapInArrow(
        found, "anchor bigint, nth bigint, negative bigint, negative_id bigint, negative_score bigint")
    order = Window.partitionBy("anchor", "nth").orderBy(F.desc("negative_score"), "negative_id", "negative")
    ranked = inside.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_negatives)
    return ranked.join(best, ["anchor", "nth"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
