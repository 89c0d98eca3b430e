"""Spans of fingerprint trees: likeness after an inserted word and in texts without white space."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from rostrum.llm import merkle


def near(session, a, b):
    df = session.createDataFrame([(a, b)], "a string, b string").select(merkle.tree(F.col("a")).alias("a"), merkle.tree(F.col("b")).alias("b"))
    return df.select(merkle.likeness(F.col("a"), F.col("b"))).first()[0]


def test_inserted_word_in_a_long_line(session):
    words = [f"word{i}" for i in range(400)]
    for at in (0, 1, 3, 200, 400):
        assert near(session, " ".join(words), " ".join([*words[:at], "new", *words[at:]])) > 0.97
    assert near(session, " ".join(words), " ".join(words[1:])) > 0.97


def test_texts_without_white_space(session):
    rng = random.Random(5)
    for letters, n in (("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdef0123456789+/", 4000), ("日本語文章漢字仮名交文例示春夏秋冬山川", 20), ("日本語文章漢字仮名交文例示春夏秋冬山川", 600),
                       ("𠀀𠀁𠀂𠀃𠀄𠀅𠀆𠀇𠀈𠀉", 200), ("กขคงจฉชซฌญ", 80)):
        a, b = ("".join(rng.choice(letters) for _ in range(n)) for _ in range(2))
        docs = session.createDataFrame([(1, a), (2, b)], "doc_id bigint, text string")
        assert all(0.5 <= r.near_edited < 0.99 and r.near_next < 0.2 for r in merkle.fingerprints(docs).collect())
        assert near(session, a, a[:3] + b[0] + a[3:]) > 0.6


def test_spans_lie_below_their_paragraphs(session):
    text = "one two three four five six\nseven\n\nlast one\n"
    got = session.createDataFrame([(text,)], "a string").select(merkle.tree(F.col("a")).alias("t")).first().t
    assert [[len(p) for p in s.spans] for s in got.sections] == [[2, 1, 0], [1]]
    assert [len(s.paragraphs) for s in got.sections] == [3, 1]


def test_repeated_spans_count_as_often_as_they_occur(session):
    words = "a b c d e".split()
    assert near(session, " ".join(words * 40), " ".join(words * 20)) == 2 * 96 / (196 + 96)
    assert near(session, "x " * 304, "x " * 104) == 2 * 100 / (300 + 100)
