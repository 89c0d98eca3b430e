"""Language, toxicity, quality and license scans: definitions and held-out accuracy."""

from __future__ import annotations

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import license_join, ordinal_quality, ppm_langid, queries, string_kernel

SF = "/root/testdata/sf0.01"


def table(session, name):
    return session.read.parquet(f"{SF}/{name}.parquet")


def held(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


# ---- language --------------------------------------------------------------------------------

def brute_bits(text: bytes, training: list[bytes]) -> float:
    """Escape method C over contexts of up to three bytes, from the definition."""
    counts: list[dict] = [{} for _ in range(4)]
    for t in training:
        t = ppm_langid.LEAD + t
        for i in range(3, len(t)):
            for k in range(4):
                counts[k].setdefault(t[i - k:i], {}).setdefault(t[i], 0)
                counts[k][t[i - k:i]][t[i]] += 1

    def cost(context: bytes, byte: int) -> float:
        after = counts[len(context)].get(context)
        shorter = (lambda: cost(context[1:], byte)) if context else (lambda: 8.0)
        if not after:
            return shorter()
        total = sum(after.values()) + len(after)
        return math.log2(total / after[byte]) if byte in after else math.log2(total / len(after)) + shorter()

    t = ppm_langid.LEAD + text
    return sum(cost(t[i - 3:i], t[i]) for i in range(3, len(t)))


def test_code_lengths_are_exact(session):
    training = {"a": ["abracadabra, abracadabra", "a bar"], "b": ["the cat sat on the mat", "théâtre\nend"]}
    rows = [(i, t, lang) for lang, ts in training.items() for i, t in enumerate(ts)]
    model = ppm_langid.train(session.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for text in (b"abracadabra", b"the bat", b"", "thé zzz".encode(), b"\n\nthe"):
        found = ppm_langid.code_lengths([b"x", text, b"cat"], model)[1]
        expected = [brute_bits(text, [t.encode() for t in training[lang]]) for lang in model.languages]
        assert np.allclose(found, expected, rtol=1e-9, atol=1e-9)


def test_long_texts_are_priced_in_steps(session, monkeypatch):
    model = ppm_langid.train(table(session, "documents").limit(60))
    texts = [b"", b"one", "äö text ".encode() * 500, b"last one"]
    whole = ppm_langid.code_lengths(texts, model)
    monkeypatch.setattr(ppm_langid, "STEP", 101)
    assert np.allclose(whole, ppm_langid.code_lengths(texts, model))


def test_trees_keep_every_byte_string(session):
    """Texts of some 250 byte values: all byte strings of the sample stay, however many there are."""
    rng = np.random.default_rng(4)
    rows = [(i, "".join(map(chr, rng.integers(32, 0x2000, 4000))), "ab"[i % 2]) for i in range(16)]
    model = ppm_langid.train(session.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for k, lang in enumerate(model.languages):
        own = [ppm_langid.LEAD + t.encode() for _, t, at in rows if at == lang]
        assert len(model.trees[k].grams[3]) == len({t[i - 3:i + 1] for t in own for i in range(3, len(t))}) > 60_000
        found = ppm_langid.code_lengths([rows[0][1].encode()], model)[0, k]
        assert np.isclose(found, brute_bits(rows[0][1].encode(), [t[3:] for t in own]), rtol=1e-9)


def test_languages_held_out(session):
    found = queries.QUERIES["op3_ppm_langid"](session, SF).join(table(session, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert len(found) == 1000 and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in found)
    tried = [r.lang == r.lang_pred for r in found if r.held_out]
    assert len(tried) > 200 and np.mean(tried) > 0.98


def test_languages_of_odd_rows(session, odd, none):
    found = {r.text: r for r in ppm_langid.predict_languages(odd).collect()}
    assert ppm_langid.predict_languages(odd).columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    assert all(found[t].lang_pred == "und" and found[t].score == 0 for t in (None, "", " \n\t "))
    assert found["x"].lang_pred != "und"
    named = odd.withColumns({"held_out": F.lit("a"), "score": F.lit("b"), "other": F.lit("c")})
    assert {r.text: (r.lang_pred, r.score, r.other) for r in ppm_langid.predict_languages(named).collect()} \
        == {t: (r.lang_pred, r.score, "c") for t, r in found.items()}
    assert ppm_langid.predict_languages(none).count() == 0
    nothing = ppm_langid.predict_languages(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in nothing.collect()} == {"und"}


# ---- toxicity --------------------------------------------------------------------------------

def brute_word(a: str, b: str) -> float:
    """Weighted common subsequences of two words, from the definition, by the norms of their lengths."""
    from itertools import combinations

    def weights(w: str) -> dict:
        out: dict = {}
        for at in combinations(range(len(w)), string_kernel.LENGTH):
            span = at[-1] - at[0] + 1
            if span <= string_kernel.SPAN:
                u = "".join(w[i] for i in at)
                out[u] = out.get(u, 0) + string_kernel.DECAY ** span
        return out

    x, y = weights(a), weights(b)
    norm = string_kernel._norms(np.array([len(a), len(b)]))
    return sum(v * y.get(u, 0) for u, v in x.items()) / float(np.prod(norm))


def test_word_values_follow_the_kernel():
    for landmark in ("idiot", "worthless"):
        table = np.zeros(1 << string_kernel.TABLE_BITS, np.float32)
        s = np.concatenate([string_kernel.letters(landmark), np.full(string_kernel.SPAN - 1, string_kernel.STOP, np.uint8)])
        room = string_kernel._rooms(s)
        for p in string_kernel.PATTERNS:
            code = string_kernel._codes(s, p)
            for i in np.flatnonzero(room[:len(code)] > p[-1]):
                table[code[i]] += string_kernel.DECAY ** (p[-1] + 1)
        table /= string_kernel._norms(np.array([len(landmark)]))[0]
        for word in ("idiot", "idixot", "worthless", "worth", "cat", "other"):
            _, values = string_kernel.word_values(string_kernel.letters(word), table)
            assert math.isclose(values[0], brute_word(word, landmark), rel_tol=1e-4, abs_tol=1e-6)
    assert brute_word("idxiot", "idiot") > 0.3  # an inserted letter weakens a match, it does not end it


def test_letters():
    s = string_kernel.letters
    assert (s("i.d.i.o.t") == s("idiot")).all() and (s("You i d i o t!") == s("you idiot!")).all()
    assert (s("id*iot") == s("IDIOT")).all()
    assert s("a b").tolist() != s("a. b").tolist() and s("").tolist() == [string_kernel.STOP]
    assert (s("we " * 40) == string_kernel.STOP).sum() >= 3  # long sentences are cut


def test_letters_of_other_scripts():
    s = string_kernel.letters
    for a, b in (("\u0441\u043b\u043e\u0432\u043e", "\u043c\u0435\u0441\u0442\u043e"), ("\u03bb\u03cc\u03b3\u03bf\u03c2", "\u03c4\u03cc\u03c0\u03bf\u03c2"),
                 ("\u0643\u0644\u0645\u0629", "\u0645\u0643\u0627\u0646"), ("\u8a00\u8449\u4e8c\u5b57", "\u5834\u6240\u4e8c\u5b57")):
        assert s(a).tolist() != s(b).tolist() and len(s(a)) == len(a) + 1
    assert (s("\u0421\u041b\u041e\u0412\u041e") == s("\u0441\u043b\u043e\u0432\u043e")).all()
    assert (s("don\u2019t \u201cgo\u201d") == s("dont go")).all() and (s("one\u2014two") == s("one two")).all()
    assert (s("\u4e00\u4e01\u3002\u4e02") == string_kernel.STOP).tolist() == [False, False, True, False, True] and s("\U000e0041x").tolist() == s("x").tolist()


def test_toxicity_learns_other_scripts(session):
    """Half the documents insult with one Cyrillic word, the others hold another of its length in that place."""
    rows = [(i, f"\u044d\u0442\u043e {'\u0434\u0443\u0440\u0430\u043a' if i % 2 else '\u0433\u043e\u0440\u043e\u0434'} \u043d\u043e\u043c\u0435\u0440 {i}", None) for i in range(200)]
    docs = session.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = docs.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    found = string_kernel.score_documents(docs, labels).collect()
    toxic, clean = ([r.score for r in found if r.held_out and r.doc_id % 2 == k] for k in (1, 0))
    assert min(toxic) > max(clean)


def test_long_texts_are_scored_in_steps(monkeypatch):
    rng = np.random.default_rng(0)
    table = rng.normal(size=1 << string_kernel.TABLE_BITS).astype(np.float32)
    texts = ["", "some words. and more of them\nhere", "lengthy word list " * 300, "x" * 3000, "last"]
    whole = string_kernel.document_values(texts, table)
    monkeypatch.setattr(string_kernel, "STEP", 500)
    parts = string_kernel.document_values(texts, table)
    assert np.allclose(whole[[0, 1, 2, 4]], parts[[0, 1, 2, 4]], atol=1e-4)
    assert [string_kernel.document_values([t], table)[0] for t in texts] == pytest.approx(parts.tolist(), abs=1e-4)


def test_toxicity_held_out(session):
    larger = "/root/testdata/sf0.1"  # the smallest tables have a handful of toxic documents
    found = queries.QUERIES["op8_string_kernel"](session, larger)
    rows = found.join(session.read.parquet(f"{larger}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    better = np.mean([(a > b) + (a == b) / 2 for a in toxic for b in clean])
    assert better > 0.85 and np.mean([r.predicted for r in rows if r.toxic == 0]) < 0.1
    assert all(r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)


def test_toxicity_of_odd_rows(session, odd, none):
    labels = session.createDataFrame([(1, 1), (2, 0), (5, 0), (6, 1), (9, None), (None, 1)], "doc_id bigint, toxic int")
    found = string_kernel.score_documents(odd, labels)
    assert found.columns == ["doc_id", "text", "lang", "held_out", "score", "predicted"] and found.count() == odd.count()
    assert found.filter("score is null or score < 0 or score > 1").count() == 0
    for unlabelled in (labels.limit(0), labels.filter("toxic = 0")):
        assert {r.score for r in string_kernel.score_documents(odd, unlabelled).collect()} == {0.0}
        assert string_kernel.keep_clean(odd, unlabelled).count() == odd.count()
    assert string_kernel.score_documents(none, labels).count() == 0


# ---- quality ---------------------------------------------------------------------------------

def test_ordered_thresholds_recover_grades():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 6)).astype(np.float32)
    latent = x @ np.array([2, -1, 0.5, 0, 0, 0]) + rng.logistic(size=3000)
    grade = np.digitize(latent, [-2, 1, 3]) * 10
    model = ordinal_quality.fit(x, grade)
    assert model.grades == [0, 10, 20, 30] and (np.diff(model.thresholds) > 0).all()
    value = x @ model.weights + model.bias
    tails = 1 / (1 + np.exp(-(value[:, None] - model.thresholds)))
    assert np.abs(tails.mean(axis=0) - [(grade >= g).mean() for g in (10, 20, 30)]).max() < 0.03
    assert np.corrcoef(value, latent)[0, 1] > 0.75


def test_features_and_values_agree(monkeypatch):
    rng = np.random.default_rng(2)
    model = ordinal_quality.Model([0, 1], rng.normal(size=ordinal_quality.BUCKETS + ordinal_quality.FACTS).astype(np.float32), 0.5, np.zeros(1))
    texts = ["a", "Some text, Some text\nTHREE lines\nof it", "x" * 5000]
    expected = [ordinal_quality.features(t) @ model.weights + 0.5 for t in texts]
    assert np.allclose(ordinal_quality.values(texts, model), expected, atol=1e-4)
    monkeypatch.setattr(ordinal_quality, "STEP", 64)
    assert np.allclose(ordinal_quality.values(texts, model), expected, atol=1e-4)


def test_quality_held_out(session):
    found = queries.QUERIES["op10_ordinal_quality"](session, SF)
    assert found.count() == 1000
    rows = found.join(table(session, "labels"), "doc_id").filter("held_out").collect()
    assert np.mean([r.selected for r in rows if r.quality == 1 and r.toxic == 0]) > 0.93
    assert np.mean([r.selected for r in rows if r.quality == 0]) < 0.2


def test_quality_of_odd_rows(session, odd, none):
    ratings = session.createDataFrame([(1, 2), (2, 1), (5, 0), (6, 0), (9, None), (None, 1)], "doc_id bigint, grade int")
    found = {r.text: r for r in ordinal_quality.rate_documents(odd, ratings).collect()}
    assert all(found[t].tail == 0 and not found[t].selected for t in (None, "", " \n\t "))
    assert all(0 <= r.tail <= 1 and 0 <= r.expected_grade <= 2 for r in found.values())
    assert ordinal_quality.keep_good(odd, ratings).columns == odd.columns
    assert ordinal_quality.keep_good(odd, ratings.limit(0)).count() == odd.count()
    assert ordinal_quality.rate_documents(none, ratings).count() == 0


# ---- licenses --------------------------------------------------------------------------------

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_license(text: str | None, containment: float, width: int):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, base = [], set()
    for label, phrase in license_join.PHRASES.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        starts += at
        base |= {label} if at else set()
    best, labels = 0.0, set(base)
    for b in range(max(1, -(-len(words) // (width // 2)))):
        block = set(words[b * (width // 2):b * (width // 2) + width])
        for label, template in license_join.TEMPLATES:
            t = set(template.split())
            if len(block & t) / len(t) >= containment:
                labels.add(label)
                best = max(best, len(block & t) / len(t))
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(labels)), 1.0 if starts else best)


def test_licenses_equal_brute_force(session, odd):
    made = []
    for k, (_, template) in enumerate(license_join.TEMPLATES):
        words = template.upper().split()
        made += [" ".join(words), "x " * 50 + ", ".join(words[1:]) + " y" * 70, "\n".join(words[:len(words) // 2]), " ".join(words[::-1])]
    rows = [(1000 + i, t) for i, t in enumerate(made)]
    docs = session.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text") \
        .union(session.createDataFrame(rows, "doc_id bigint, text string")).union(odd.select("doc_id", "text"))
    found = license_join.scan_documents(docs)
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    expected = sorted((repr((r.doc_id, *brute_license(r.text, 0.8, 64))) for r in docs.collect()))
    assert sorted(repr(tuple(r)) for r in found.select("doc_id", *names).collect()) == expected
    assert license_join.scan_documents(odd.limit(0)).count() == 0


def test_phrases_count_every_place(session):
    text = "MIT license; mit-license (the GNU General Public LICENSE) mit éa license mit license"
    r = license_join.scan_documents(session.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == (14, 4, 0, 12, "gpl,mit")


def test_templates_longer_than_a_block(session):
    """A template of more different words than a block holds is found wherever it starts."""
    template = " ".join(f"term{i}" for i in range(150))
    texts = ["filler " * k + template + " more" * (k % 5) for k in (0, 1, 31, 32, 63, 100, 149, 150, 299)] + ["filler " * 400, " ".join(f"term{i}" for i in range(100))]
    docs = session.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r.doc_id: (r.labels, r.score) for r in license_join.scan_documents(docs, [("long", template), ("mit", "short words here")]).collect()}
    assert found == {i: ("long", 1.0) if i < 9 else ("", 0.0) for i in range(11)}
