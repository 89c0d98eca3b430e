"""Exact and near duplicates and fingerprints against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rostrum.llm import graph, merkle, queries, simhash_pivot, tree_dedup

SF = "/root/testdata/sf0.001"


def texts(session):
    return session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()


# ---- exact duplicates ------------------------------------------------------------------------

@pytest.mark.parametrize("bits", [1, 4, 7])
def test_tree_merge_equals_group_by(session, bits):
    rows = [(i, i % 37 if i % 3 else 0) for i in range(3000)]
    runs = session.createDataFrame(rows, "doc_id bigint, k int").select(
        "doc_id", F.unhex(F.sha2(F.col("k").cast("string"), 256)).alias("digest"), F.lit(2).alias("bytes"),
        F.col("k").cast("bigint").alias("_llm_hash"), F.lit(1).cast("bigint").alias("copies"))
    for keep, pick in (("largest", max), ("smallest", min)):
        found = {r["_llm_hash"]: (r["keep_id"], r["group_size"]) for r in tree_dedup.merge_runs(runs, keep, bits).collect()}
        members = {k: [i for i, x in rows if x == k] for k in {k for _, k in rows}}
        assert found == {k: (pick(m), len(m)) for k, m in members.items()}


def test_rounds_merge_sorted_runs(session):
    """Every round sorts what its runs bring and merges it in order; no round hashes."""
    rows = [(i, bytes([i % 5]), 1, i % 5, 1) for i in range(50)]
    runs = session.createDataFrame(rows, "doc_id bigint, digest binary, bytes int, _llm_hash bigint, copies bigint")
    for bits in (2, 6):
        plan = tree_dedup.merge_runs(runs, node_bits=bits, round_bits=2)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" not in plan and plan.count("SortAggregate") >= bits // 2 and plan.count("Sort [node") >= bits // 2


def test_null_ids_stay_last(session):
    rows = [(i, b"a", 1, 0, 1) for i in (None, 3, 5)] + [(None, b"b", 1, 1, 2)]
    runs = session.createDataFrame(rows, "doc_id bigint, digest binary, bytes int, _llm_hash bigint, copies bigint")
    for keep, kept in (("largest", 5), ("smallest", 3)):
        found = {bytes(r.digest): (r.keep_id, r.group_size) for r in tree_dedup.merge_runs(runs, keep, 3).collect()}
        assert found == {b"a": (kept, 3), b"b": (None, 2)}


def test_groups_of_odd_rows(odd, none):
    found = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in tree_dedup.groups(odd).collect())
    assert found == Counter([
        (1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, False), (3, 4, 3, False), (4, 4, 3, True), (None, 4, 3, False),
        (None, None, 1, True), (5, 5, 1, True), (6, 6, 1, True), (7, 7, 1, True), (8, 8, 1, True), (9, 9, 1, True)])
    kept = tree_dedup.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["2", "4", "5", "6", "7", "8", "9", "None"]
    assert tree_dedup.groups(none).count() == 0 and tree_dedup.keep_one(none).count() == 0


def test_exact_query_equals_sql(session):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    found = queries.QUERIES["op4_tree_dedup"](session, SF)
    columns = sorted(found.columns)
    expected = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLE['op4_tree_dedup']})").fetchall()
    assert Counter(map(tuple, found.select(columns).collect())) == Counter(expected)


# ---- near duplicates -------------------------------------------------------------------------

def brute_fingerprint(text: str) -> int:
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text).replace("\r", " ").split() if w] if text.isascii() \
        else text.encode().lower().split()
    words = [w if isinstance(w, bytes) else w.encode() for w in words]
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_roots(prints: list[int], radius: int) -> dict[int, int]:
    prints, root = sorted(set(prints)), {}
    for p in prints:
        near = {root[q] for q in root if (p ^ q).bit_count() <= radius}
        for q in root:
            if root[q] in near:
                root[q] = p
        root[p] = p
    return root


def test_fingerprints(session):
    for r in texts(session)[:40]:
        assert simhash_pivot.fingerprint_of(r.text.encode()) & (1 << 64) - 1 == brute_fingerprint(r.text)
    assert simhash_pivot.fingerprint_of(b"") == simhash_pivot.fingerprint_of(b" \t\x0b\n") == 0
    assert simhash_pivot.fingerprint_of(b"One Two") == np.uint64(xxhash.xxh64_intdigest(b"one two", 42)).astype(np.int64)
    assert simhash_pivot.fingerprint_of(("É B c d " * 9).encode()) & (1 << 64) - 1 == brute_fingerprint("É B c d " * 9)


def test_distances_bound_coordinates():
    rng = np.random.default_rng(3)
    a = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    b = a ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 200, dtype=np.uint64))
    ta, tb = simhash_pivot.distance_table(a), simhash_pivot.distance_table(b)
    assert (np.abs(ta - tb).max(axis=1) <= 2).all()
    shared = simhash_pivot.file_keys(ta, 2) == simhash_pivot.file_keys(tb, 2)
    assert shared.any(axis=1).all()  # whatever two bits differ, one file holds both


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_classes_equal_brute_force(session, radius):
    rng = random.Random(radius)
    prints = [rng.getrandbits(64) for _ in range(60)]
    for p in prints[:12]:  # balls and chains
        for _ in range(25):
            q = p
            for _ in range(rng.randint(1, 4)):
                q ^= 1 << rng.randrange(64)
            prints.append(q)
    root = brute_roots(prints, radius)
    signed = [p - (1 << 64) if p >> 63 else p for p in sorted(root)]
    df = session.createDataFrame([(p, i) for i, p in enumerate(signed)], "fingerprint bigint, first bigint")
    found = {r.fingerprint & (1 << 64) - 1: r.class_first for r in simhash_pivot.print_classes(df, radius).collect()}
    first = {p & (1 << 64) - 1: i for i, p in enumerate(signed)}
    least = {}
    for p, r in root.items():
        least[r] = min(least.get(r, 1 << 60), first[p])
    assert found == {p: least[r] for p, r in root.items()}


def test_near_duplicates_of_odd_rows(odd, none):
    found = {(r.doc_id, r.component_id) for r in simhash_pivot.classes(odd).collect()}
    assert {(1, 1), (2, 1), (3, 3), (4, 3), (7, 3), (5, 5)} <= found and (None, 3) in found
    kept = simhash_pivot.keep_one(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "5", "6", "8", "9", "None"]
    assert simhash_pivot.classes(none).count() == 0 and simhash_pivot.keep_one(none).count() == 0


def test_components_of_a_long_chain(session):
    edges = [(i, i + 1) for i in range(100)] + [(300, 200), (200, 300), (400, 400), (250, 300)]
    found = {r.node: r.root for r in graph.components(session.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert found == {**{i: 0 for i in range(101)}, 200: 200, 250: 200, 300: 200}


# ---- fingerprint trees -----------------------------------------------------------------------

def test_merkle_query_equals_brute_force(session):
    rows = sorted(texts(session))
    found = {r.doc_id: r for r in queries.QUERIES["op2_merkle"](session, SF).collect()}
    assert len(found) == len(rows)
    for k, (doc_id, text) in enumerate(rows):
        other, n = rows[(k + 1) % len(rows)][1], len(text) // 4
        changed = text[:len(text) - n] + other[:n]
        r = found[doc_id]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (r.fingerprint == r.edited_fingerprint) == (text == changed)
        assert 0 <= r.near_next <= 1 and (text == changed) == (r.near_edited == 1.0 and r.n_edits == 0)
    near = sorted(r.near_edited for r in found.values() if r.n_chars > 400)
    assert near[0] >= 0.3 and near[len(near) // 20] > 0.6  # texts that repeat a few words have few different spans
    assert sum(r.near_edited > r.near_next for r in found.values() if r.n_chars > 400) >= 0.97 * len(near)


def test_edits_are_located(session):
    text = "".join(f"line {i} of the text\n" for i in range(40)) + "\nlast section\n"
    changed = text.replace("line 20 of", "line 20 off").replace("last", "final")
    df = session.createDataFrame([(text, changed)], "a string, b string").select(
        merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b"))
    found = df.select(merkle.edits(F.col("a"), F.col("b")).alias("e"), merkle.root(F.col("a")).alias("ra"), merkle.root(F.col("b")).alias("rb")).first()
    assert [tuple(e) for e in found.e] == [(1, 4), (3, 0)] and found.ra != found.rb
    leaves = df.select(F.flatten(F.transform("a.sections", lambda s: s["paragraphs"])).alias("p")).first().p
    assert leaves[20] == hashlib.sha256(b"line 20 of the text\n").hexdigest()


@pytest.mark.parametrize("partitions", [1, 3, 50])
def test_next_document_whatever_the_ranges(session, odd, partitions):
    rows = [(i * 3, f"text {i}") for i in range(40)]
    df = session.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r.following for r in merkle.with_next(df, partitions).select("doc_id", F.col("next.text").alias("following")).collect()}
    assert found == {d: rows[(i + 1) % 40][1] for i, (d, _) in enumerate(rows)}
    single = session.createDataFrame([(27, "alone")], "doc_id bigint, text string")
    assert merkle.with_next(single, partitions).select("text", "next.text").collect() == [("alone", "alone")]


def test_trees_of_odd_rows(session, odd, none):
    """Nulls, empty and long texts, repeated rows: every value against the definition."""
    rows = [(r.doc_id, r.text or "") for r in odd.collect()]
    found = sorted(merkle.fingerprints(odd).collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.n_chars))
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in found) == sorted((d is None, d or 0, len(t)) for d, t in rows)
    alike = {}
    for r in merkle.with_next(odd).select("doc_id", "text", F.col("next.text").alias("following"), merkle.root(F.col("tree")).alias("root")).collect():
        changed = r.text[:len(r.text) - len(r.text) // 4] + r.following[:len(r.text) // 4]
        alike.setdefault((r.doc_id, len(r.text), hashlib.sha256(changed.encode()).hexdigest(), r.root), []).append(r.text == changed)
    got = {}
    for r in found:
        got.setdefault((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint), []).append(r.fingerprint == r.edited_fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert got == alike
    by_text = {}
    for r in found:
        by_text.setdefault((r.doc_id, r.n_chars), set()).add(r.fingerprint)
    assert by_text[(2, 23)] == by_text[(1, 23)] and by_text[(3, 0)] == by_text[(4, 0)] == by_text[(None, 0)] and len(by_text[(5, 580000)]) == 1
    assert merkle.fingerprints(none).collect() == []


def test_another_second_reading_is_an_error(session):
    def fresh(batches):
        for batch in batches:
            ids = pa.array([random.SystemRandom().getrandbits(60) for _ in range(batch.num_rows)], pa.int64())
            yield pa.RecordBatch.from_arrays([ids, pa.array(["text"] * batch.num_rows)], ["doc_id", "text"])

    moving = session.range(50).mapInArrow(fresh, "doc_id bigint, text string")
    with pytest.raises(PySparkException, match="second reading"):
        merkle.with_next(moving, 4).select("doc_id", "next.text").collect()
