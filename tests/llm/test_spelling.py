"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from rostrum.llm import spelling


def expected(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall(r"[A-Za-z\u00C0-\u00FF]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(b) - len(a) == 1 and a[i:] == b[i + 1:])

    others = {w: [x for x in n if near(w, x)] for w in n}
    form = {}
    for w in n:
        best = min(others[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, form[w] or "", root(w), n[w], len(others[w]), n[form[w]] if form[w] else 0) for w in n)


def found(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in df.collect())


def frame(session, docs):
    return session.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id bigint, text string, word string, n int")


def test_against_all_pairs(session):
    """Runs of one letter, accents, edits at both ends, chains of forms, and words beyond the tries."""
    rng = random.Random(5)
    words = ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa", "letters", "lettersx", "xletters", "lettres", "Éclairée", "éclairée", "abcdefg", "abcdefh", "bbcdefg"]
    for size in (7, 8, 12, spelling.LONG - 1, spelling.LONG, spelling.LONG + 1, spelling.LONG + 2, 300):
        word = "".join(rng.choice("abé") for _ in range(size))
        words.append(word)
        for _ in range(6):
            i, c = rng.randrange(size), rng.choice("abcé")
            words += [word[:i] + word[i + 1:], word[:i] + c + word[i:], word[:i] + c + word[i + 1:]]
    docs = [(k % 40, " ".join(rng.choices(words, k=30)) + ", " + " ".join([w] * rng.choice((1, 2, 25, 400)))) for k, w in enumerate(words)]
    want = expected(docs)
    assert found(spelling.variants(frame(session, docs))) == want
    assert any(form and root != form for _, form, root, *_ in want) and any(len(w) > spelling.LONG and near for w, _, _, _, near, _ in want)


def test_odd_rows(session, odd, none):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(spelling.variants(odd)) == expected(docs)
    assert found(spelling.variants(none)) == []
    ties = [(1, " ".join(["holding"] * 60 + ["folding"] * 60 + ["molding"] * 2))]
    assert found(spelling.variants(frame(session, ties))) == expected(ties)


def test_digests_of_words_lacking_a_letter():
    word = "abracadabra" * 9
    whole, lacking = spelling.lacking(word), [spelling.lacking(word[:i] + word[i + 1:]) for i in range(len(word))]
    assert all(whole[m][i + 1] == lacking[i][m][0] for m in range(2) for i in range(len(word)))


def test_pairs_come_once_each_way_and_in_few_rounds(session):
    """Runs of one letter, where an inserted letter can stand in several places, and words that part late."""
    rng = random.Random(11)
    words = {"".join(rng.choice("ab") for _ in range(rng.choice((7, 8, 9, 10)))) for _ in range(150)}
    words |= {"a" * size for size in range(7, 30)} | {"b" + "a" * size for size in range(7, 30)} | {"a" * 15 + c + "a" * 12 for c in "bcd"}
    listed = session.createDataFrame([(w, k + 2) for k, w in enumerate(sorted(words))], "word string, n bigint").repartition(3)
    n = {r.word: r.n for r in listed.collect()}
    lacking = {w: {w[:i] + w[i + 1:] for i in range(len(w))} for w in n}
    holed = {w: {(i, w[:i] + w[i + 1:]) for i in range(len(w))} for w in n}
    near = lambda a, b: a != b and (a in lacking[b] or b in lacking[a] or bool(holed[a] & holed[b]))
    found = spelling.trie_neighbours(listed)
    assert sorted((r.word, r.other, r.n) for f in found for r in f.collect()) == sorted((a, b, n[b]) for a in n for b in n if near(a, b))
    assert len(found) <= 1 + 15 // (1 + spelling.STRIDE)  # 29 letters had a round for each of 16 depths
