"""Token ids, both packings and the piece lattice: exact round trips and brute force."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rostrum.llm import bfd_pack, queries, sp_lattice, ss_pack, tokens

SF = "/root/testdata/sf0.001"
ODD = ["", " ", "a", "Hello, it's 42 ΑΣ İstanbul é <|endoftext|>x a b\x1cc don'T we'LL 漢字 ß ﬁ", " lead", "a  b\n\n c \n", "\n",
       "naïve—dash…", "tab\tand\x85more\xa0space", "é́ combining", "x" * 3000, "don't stop 'til it's 3rd, ok?!"]


def texts(session):
    return [r.text for r in session.read.parquet(f"{SF}/documents.parquet").collect()]


# ---- ids -------------------------------------------------------------------------------------

def test_word_ids_equal_the_library(session):
    path = public_tokenizers.path(ss_pack.VOCABULARY)
    all_texts = texts(session) + ODD
    expected = [e.ids for e in Tokenizer.from_file(path).encode_batch(all_texts, add_special_tokens=False)]
    for entries in (10**6, 50):  # with a full cache, too
        encoder = tokens.WordEncoder(path, entries)
        for _ in range(2):
            assert [np.frombuffer(encoder.encode(t), "<u4").tolist() for t in all_texts] == expected
        assert len(encoder) <= entries


def test_byte_ids_equal_the_library_and_decode(session):
    encoder = tokens.ByteEncoder(public_tokenizers.path(bfd_pack.VOCABULARY), 1000)
    for t in texts(session) + ODD:
        ids = np.frombuffer(encoder.encode(t), "<u4").tolist()
        assert ids == encoder.full.encode_ordinary(t) and encoder.full.decode(ids) == t


# ---- placement -------------------------------------------------------------------------------

def brute_sums_of_squares(sizes: list[int], capacity: int) -> list[int]:
    """The sum of squares after every placement, each choice tried."""
    gaps: list[int] = []
    sums = []
    for size in sizes:
        choices = []
        for k in [*range(len(gaps)), None]:
            after = gaps.copy()
            if k is None:
                after.append(capacity - size)
            elif gaps[k] >= size:
                after[k] -= size
            else:
                continue
            open_gaps = [g for g in after if g]
            choices.append((sum(open_gaps.count(g) ** 2 for g in set(open_gaps)), k is None, after[k if k is not None else -1], after))
        best = min(choices, key=lambda c: c[:3])
        gaps = best[3]
        sums.append(best[0])
    return sums


@pytest.mark.parametrize("seed", range(4))
def test_each_placement_gives_the_smallest_sum(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, 2, 3, 5, 8, 12, 20]) for _ in range(80)]
    expected, capacity = brute_sums_of_squares(sizes, 20), 20
    for n in range(1, len(sizes) + 1):
        bins, offset = ss_pack.place(np.array(sizes[:n]), capacity)
        fill = np.bincount(bins, sizes[:n])
        counts = np.bincount(np.int64(capacity - fill))[1:]
        assert int((counts ** 2).sum()) == expected[n - 1] and fill.max() <= capacity
    assert all(offset[i] == sum(sizes[j] for j in range(i) if bins[j] == bins[i]) for i in range(len(sizes)))


def test_best_fit_by_segment_tree():
    rng = random.Random(1)
    sizes = sorted((rng.randint(1, 64) for _ in range(400)), reverse=True)
    found, gaps, expected = bfd_pack.best_fit(sizes, 64), [], []
    for i, size in enumerate(sizes):
        fits = [k for k in range(len(gaps)) if gaps[k] >= size]
        least = min((gaps[k] for k in fits), default=None)
        if least is None:
            gaps.append(64 - size)
        else:
            gaps[next(k for k in fits if gaps[k] == least)] -= size
        expected.append(least)
    assert sorted(i for row in found for i in row) == list(range(400))
    assert sorted(64 - sum(sizes[i] for i in row) for row in found) == sorted(gaps)


# ---- packings --------------------------------------------------------------------------------

def check_places(rows, capacity):
    by: dict[int, list] = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by)


def test_packed_pieces(session):
    found = queries.QUERIES["op6_ss_pack"](session, SF).collect()
    full, ids = Tokenizer.from_file(public_tokenizers.path(ss_pack.VOCABULARY)), {}
    for r in session.read.parquet(f"{SF}/documents.parquet").collect():
        ids[r.doc_id] = [*full.encode(r.text, add_special_tokens=False).ids, 1]
    assert check_places(found, 4096) <= -(-sum(map(len, ids.values())) // 4096) * 1.03 + 1
    pieces = {(r.doc_id, r.piece): r for r in found}
    assert len(pieces) == len(found) == sum(-(-len(x) // 4096) for x in ids.values())
    for (doc_id, piece), r in pieces.items():
        own = ids[doc_id][4096 * piece:4096 * (piece + 1)]
        assert (r.start, r.length, r.ids_crc32) == (4096 * piece, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))


def test_open_sequences_of_shards_are_packed_again(session):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    few = ss_pack.pack(docs, shard_units=20)
    assert few.count() == ss_pack.pack(docs).count()
    one, many = check_places(ss_pack.pack(docs).collect(), 4096), check_places(few.collect(), 4096)
    assert many <= one * 1.1 + 1


def test_packings_of_odd_rows(session, odd):
    found = ss_pack.pack(odd)
    assert {r.doc_id: r.length for r in found.collect() if r.doc_id in (3, 4, 7)} == {3: 1, 4: 1, 7: 1}
    assert found.filter("piece = 0").count() == odd.count() and ss_pack.pack(odd.limit(0)).count() == 0
    assert found.filter("doc_id = 5").count() > 5
    rows = bfd_pack.pack_ids(odd).collect()
    assert sum(p == 0 for r in rows for p in r.pieces) == odd.count() and bfd_pack.pack_ids(odd.limit(0)).count() == 0


@pytest.mark.parametrize("window", [10**7, 3000])
def test_id_rows_give_back_the_texts(session, window):
    docs = session.read.parquet(f"{SF}/documents.parquet")
    encoder = tokens.ByteEncoder(public_tokenizers.path(bfd_pack.VOCABULARY))
    found: dict[int, dict[int, list[int]]] = {}
    rows = bfd_pack.pack_ids(docs, capacity=512, window_tokens=window).collect()
    assert len({r.sequence_id for r in rows}) == len(rows)
    for r in rows:
        ids, positions = np.frombuffer(r.input_ids, "<u4"), np.frombuffer(r.position_ids, "<u2")
        assert len(ids) == len(positions) == 512 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        for doc_id, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (positions[a:b] == np.arange(b - a)).all()
            found.setdefault(doc_id, {})[piece] = ids[a:b].tolist()
        assert (ids[r.n_tokens:] == bfd_pack.END_ID).all()
    for r in docs.collect():
        whole = [i for k in sorted(found[r.doc_id]) for i in found[r.doc_id][k]]
        assert whole.pop() == bfd_pack.END_ID and encoder.full.decode(whole) == r.text
        assert all(len(found[r.doc_id][k]) == 512 for k in sorted(found[r.doc_id])[:-1])


# ---- piece lattice ---------------------------------------------------------------------------

def brute_segmentation(word: str, by: dict, pieces: sp_lattice.Pieces) -> list[int]:
    best: list = [(0.0, [])]
    for b in range(1, len(word) + 1):
        choices = []
        for a in range(max(0, b - pieces.longest), b):
            p = word[a:b]
            if p in by:
                choices.append((best[a][0] + by[p][1], -a, best[a][1] + [by[p][0]]))
            elif b - a == 1:
                choices.append((best[a][0] + pieces.unknown, -a, best[a][1] + [pieces.first_byte + x for x in p.encode()]))
        top = max(choices, key=lambda c: c[:2])
        best.append((top[0], top[2]))
    return best[-1][1]


def test_lattice_equals_brute_force(session, odd):
    pieces = sp_lattice.Pieces(public_tokenizers.path(sp_lattice.VOCABULARY))
    by = {t: (i, s) for t, i, s in pieces.rows}
    made = session.createDataFrame([(10_000 + i, t) for i, t in enumerate(ODD) if len(t) < 1000], "doc_id bigint, text string")
    docs = session.read.parquet(f"{SF}/documents.parquet").filter("n_chars < 3000").select("doc_id", "text") \
        .union(made).union(odd.filter("doc_id is null or doc_id not in (5, 9)").select("doc_id", "text"))
    found = sp_lattice.encode_documents(docs, block_docs=50).withColumn("back", sp_lattice.decode(F.col("ids"))).collect()
    assert len(found) == docs.count()
    known: dict[str, list[int]] = {}
    for r in found:
        for w in sp_lattice.words(r.text):
            known.setdefault(w, brute_segmentation(sp_lattice.SPACE + w, by, pieces))
        assert r.ids == [i for w in sp_lattice.words(r.text) for i in known[w]] and r.back == r.text
    assert sp_lattice.encode_documents(docs.limit(0)).count() == 0


def test_cuts_leave_the_best_path_as_it_is(session):
    pieces = sp_lattice.Pieces(public_tokenizers.path(sp_lattice.VOCABULARY))
    by = {t: (i, s) for t, i, s in pieces.rows}
    words = list({w for t in texts(session)[:20] + ODD for w in sp_lattice.words(t) if len(w) < 200})
    all_parts, ends = sp_lattice.Cutter(pieces.spanned).parts(words)
    for w, a, b in zip(words, [0, *ends], ends):
        word, parts = sp_lattice.SPACE + w, all_parts[a:b].to_pylist()
        assert "".join(parts) == word
        assert [i for p in parts for i in brute_segmentation(p, by, pieces)] == brute_segmentation(word, by, pieces)
