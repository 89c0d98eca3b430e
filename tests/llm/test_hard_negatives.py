"""Hard negatives against brute force, and the bounds that discard pairs."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import hard_negatives

SCHEMA = "vec_id bigint, label int, embedding array<double>, score double, row string"


def frame(session, rows):
    return session.createDataFrame([(*r, 0.5, "x") for r in rows], SCHEMA)


def mined(session, rows, **options):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    df = hard_negatives.mine(frame(session, rows), "embedding", label, F.col("vec_id") % 50 == 0, **options)
    return sorted(map(tuple, df.collect()))


def expected(rows):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        held[(i, (label + 1) % 10 if i % 7 == 0 else label, tuple(v))] = [math.floor(256 * x) for x in v]
    out = []
    for a, x in held.items():
        if a[0] % 50:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(x, y)), b[0], b[1] == a[1]) for b, y in held.items() if b != a))
        for score, positive, same in [s for s in scored if s[2]][:5]:
            kept = [s for s in scored if not s[2] and 50 * -score <= 100 * -s[0] <= 95 * -score][:3]
            out += [(a[0], positive, k + 1, s[1], -score, -s[0]) for k, s in enumerate(kept)]
    return sorted(out)


@pytest.mark.parametrize("dim, n", [(1, 300), (16, 400), (64, 900)])
def test_against_brute_force(session, monkeypatch, dim, n):
    """Clusters, so that bounds discard pairs, in several packs; ties by repeated vectors."""
    monkeypatch.setattr(hard_negatives, "ROW_PACK", 256)
    monkeypatch.setattr(hard_negatives, "ANCHOR_PACK", 8)
    rng = np.random.default_rng(dim)
    centres = rng.normal(size=(12, dim))
    rows = [(i, int(rng.integers(3)), (centres[i % 12] + 0.2 * rng.normal(size=dim)).tolist()) for i in range(n)]
    rows += [(n + i, *rows[i][1:]) for i in range(60)]
    want = expected(rows)
    assert mined(session, rows) == want and len(want) > 20


def test_odd_rows(session):
    inf, nan = float("inf"), float("nan")
    rows = [(0, 1, [1.0, 2.0]), (0, 1, [1.0, 2.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 1.0]), (3, 2, [0.5]), (4, 2, []), (5, None, [9.0, 9.0]), (6, 2, None),
            (8, 2, [inf, 1.0]), (9, 2, [nan, 1.0]), (10, 2, [None, 1.0]), (None, 2, [0.6, 1.0]), (50, 3, [0.0, 0.0]), (51, 3, [-1.0, 0.0]), (100, 4, [1.0, 1.0])]
    assert mined(session, rows) == expected(rows) != []
    assert mined(session, []) == [] and mined(session, [(0, 1, [1.0])]) == [] and mined(session, [(3, 1, [1.0])]) == []


def test_large_components(session):
    """Products beyond what doubles hold are exact."""
    rows = [(50 * i + j, j % 2, [3e6 * (1 + 0.2 * j) + i / 3, 3.0 * i]) for i in range(4) for j in range(9)]
    assert mined(session, rows) == expected(rows) != []
    with pytest.raises(Exception, match="too large|out of bounds|too big"):
        mined(session, [(0, 1, [1e300]), (1, 1, [1e300]), (2, 2, [1e300])])


def test_bounds_hold_and_tighten():
    rng = np.random.default_rng(3)
    a, b = np.floor(256 * rng.normal(size=(40, 50))), np.floor(256 * rng.normal(size=(70, 50)))
    exact, before = a @ b.T, None
    for segments in (1, 4, 16, 50):
        low, high = hard_negatives.bounds(a, b, segments)
        assert (low <= exact).all() and (exact <= high).all()
        assert before is None or (high - low).mean() < before
        before = (high - low).mean()
    assert before < 1


def test_bounds_discard_pairs(monkeypatch):
    """On clustered vectors few pairs are scored exactly."""
    rng = np.random.default_rng(4)
    centres = np.repeat(rng.normal(size=(20, 4)), 16, axis=1)
    matrix = np.floor(256 * (centres[np.arange(2000) % 20] + 0.05 * rng.normal(size=(2000, 64))))
    rows = {"matrix": matrix, "label": np.arange(2000) % 20 % 5, "row": np.arange(2000), "vec_id": np.arange(2000)}
    anchors = {k: v[:40] for k, v in rows.items()}
    seen = []
    score = hard_negatives.scores
    monkeypatch.setattr(hard_negatives, "scores", lambda a, b, left: (seen.append(left.mean()), score(a, b, left))[1])
    hard_negatives.near_rows(anchors, rows, 5)
    assert seen[0] < 0.06
