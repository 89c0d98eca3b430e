"""Toxicity by a support vector machine on a subsequence string kernel with Nyström landmarks.

Two words share as much as their common subsequences of ``LENGTH`` letters weigh: each occurrence counts
``DECAY`` to the power of the letters it spans, up to ``SPAN``, so that gaps and inserted letters only
weaken a match. A word's kernel is divided by the norm of its length; a sentence's is the sum over its
words. Landmarks are words of labelled documents: those that tell toxic documents apart, and common ones.
In the space that the landmarks span (Nyström), a linear machine with squared hinge loss separates
labelled sentences; a second round keeps, of a toxic document, only the sentences that it finds toxic, and
adds sentences with an inserted letter in the landmarks that it finds toxic. A document scores as its worst sentence, turned into a probability by a logistic fit.

The decision is linear in the kernel, so the landmarks fold into one weight per subsequence, and a text
is scored in one pass over its letters. Signs within a word are skipped, and three or more single letters
in a row are one word.

Fitted on about ``TOXIC_DOCS`` and ``CLEAN_DOCS`` labelled documents, chosen by a hash of the id, with
whole texts; scoring reads whole texts of all rows. Null and empty texts score as a sentence without
words. Where no sentences with words of both labels are given every score is 0. Repeated rows are each scored; an empty table gives
no rows; extra columns stay.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.common import fit_in_task
from rostrum.llm.ppm_langid import held_out

LENGTH, SPAN, DECAY = 4, 6, 0.75
PATTERNS = [(0, *rest) for size in range(LENGTH, SPAN + 1) for rest in combinations(range(1, size), LENGTH - 1) if rest[-1] == size - 1]
TABLE_BITS = 20
LANDMARKS = 128
TOXIC_DOCS, CLEAN_DOCS = 800, 1600
#: Words of a sentence at most; longer ones are cut.
SENTENCE_WORDS = 12
THRESHOLD = 0.3
#: Weight of the added sentences against all others.
ADDED_SHARE = 0.15
GAP, STOP = 62, 63  # symbols for the ends of words and of sentences
STEP = 1 << 20  # letters scored at once
SPELLED = re.compile(r"(?<!\w)\w(?:[ .*_-]\w(?!\w)){2,}")


#: Code points told apart; the planes above hold no letters in use.
POINTS = 0x32400


def _symbols() -> np.ndarray:
    """Symbol of each code point; 255 for signs that are skipped. Letters beyond a to z share 36 symbols by their value, so
    those of an alphabet, which stand side by side, mostly differ. Dashes part words, full stops of any script sentences."""
    table = np.full(POINTS + 1, 255, np.uint8)  # the last: everything above
    for c in range(POINTS):
        if chr(c).isalpha():
            table[c] = c - 97 if 97 <= c < 123 else 26 + c % 36
        elif chr(c).isspace() or 0x2013 <= c <= 0x2015:
            table[c] = GAP
    # Full stops, exclamation and question marks of Latin, Arabic, Devanagari and Chinese texts.
    table[[ord(c) for c in ".!?\n\u2026\u061f\u06d4\u0964\u3002\uff01\uff0e\uff1f"]] = STOP
    return table


SYMBOLS = _symbols()


def letters(text: str) -> np.ndarray:
    """A text as symbols; ends with ``STOP``. Signs between two letters are skipped, full stops too."""
    text = SPELLED.sub(lambda m: re.sub(r"\W", "", m.group()), text.lower())
    points = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4"), POINTS)
    found = SYMBOLS[points]
    if len(found) > 2:  # an ASCII stop between letters is a sign like any other
        inner = np.flatnonzero((found[1:-1] == STOP) & (found[:-2] < GAP) & (found[2:] < GAP) & (points[1:-1] != 10) & (points[1:-1] < 128)) + 1
        found[inner] = 255
    found = np.append(found[found != 255], np.uint8(STOP))
    ends = np.flatnonzero((found >= GAP) & np.append(found[1:] < GAP, True))  # the last of several in a row
    stops = np.flatnonzero(found[ends] == STOP)
    since = np.arange(len(ends)) - np.concatenate([[0], stops[:-1] + 1])[np.searchsorted(stops, np.arange(len(ends)))]
    found[ends[since % SENTENCE_WORDS == SENTENCE_WORDS - 1]] = STOP
    return found


def _rooms(s: np.ndarray) -> np.ndarray:
    """Letters from each place to the end of its word, that place included; 0 at ends."""
    ends = np.flatnonzero(s >= GAP)
    return ends[np.searchsorted(ends, np.arange(len(s)))] - np.arange(len(s))


def _codes(s: np.ndarray, pattern: tuple[int, ...]) -> np.ndarray:
    """Table place of the subsequence that starts at each letter."""
    n = len(s) - SPAN + 1
    code = s[:n].astype(np.uint32)
    for at in pattern[1:]:
        code = (code << np.uint32(6)) | s[at:at + n]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS)


def _norms(length: np.ndarray) -> np.ndarray:
    total = sum(np.maximum(0, length - p[-1]) * DECAY ** (2 * (p[-1] + 1)) for p in PATTERNS)
    return np.sqrt(np.maximum(total, DECAY ** (2 * LENGTH)))


def word_values(s: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of words in ``s`` and the sum of ``table`` over each word's subsequences, by its norm."""
    ends = np.flatnonzero(s >= GAP)
    padded = np.concatenate([s, np.full(SPAN - 1, STOP, np.uint8)])
    room, value = _rooms(s), np.zeros(len(s), np.float32)
    for p in PATTERNS:
        value += np.where(room > p[-1], table[_codes(padded, p)], 0) * np.float32(DECAY ** (p[-1] + 1))
    starts = np.concatenate([[0], ends[:-1] + 1])
    return ends, np.add.reduceat(value, starts) / _norms(ends - starts)


@dataclass
class Model:
    table: np.ndarray  # weight of each subsequence
    bias: float
    slope: float  # of the logistic fit
    offset: float


def document_values(texts: list[str], table: np.ndarray) -> np.ndarray:
    """The largest sentence value of each text."""
    best = np.full(len(texts), -np.inf)
    held: list[np.ndarray] = []
    owner: list[int] = []
    size = 0

    def flush() -> None:
        nonlocal size
        if held:
            s = np.concatenate(held)
            ends, value = word_values(s, table)
            stops = np.flatnonzero(s[ends] == STOP)
            sentence = np.add.reduceat(value, np.concatenate([[0], stops[:-1] + 1]))
            limits = np.searchsorted(ends[stops], np.cumsum([0, *map(len, held[:-1])]))
            np.maximum.at(best, owner, np.maximum.reduceat(sentence, limits))
        held.clear()
        owner.clear()
        size = 0

    for k, text in enumerate(texts):
        s = letters(text)
        at = 0
        while at < len(s):  # a long text is cut at ends of sentences, or else of words
            to = min(len(s), at + STEP)
            if to < len(s):
                for end in (STOP, GAP):
                    found = np.flatnonzero(s[at:to] == end)
                    if len(found):
                        to = at + int(found[-1]) + 1
                        break
            part = s[at:to]
            held.append(part if part[-1] == STOP else np.append(part, np.uint8(STOP)))
            owner.append(k)
            size += len(part)
            at = to
            if size >= STEP:
                flush()
    flush()
    return best


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, cost: float = 1.0, rounds: int = 200) -> tuple[np.ndarray, float]:
    """Weights and bias of a linear machine with squared hinge loss (accelerated gradient steps)."""
    x = np.column_stack([x, np.ones(len(x))]).astype(np.float32)
    y, weight = y.astype(np.float32), (weight / weight.sum() * cost).astype(np.float32)
    v = np.random.default_rng(0).normal(size=x.shape[1]).astype(np.float32)
    for _ in range(20):  # largest curvature
        v = x.T @ (weight * (x @ (v / np.linalg.norm(v))))
    step = np.float32(1 / (2 * np.linalg.norm(v) + 1e-4))
    w = ahead = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        miss = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - step * (np.float32(1e-4) * ahead - 2 * (x.T @ (weight * y * miss)))
        ahead, w = new + np.float32(k / (k + 3)) * (new - w), new
    return w[:-1], float(w[-1])


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    a = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        grad = a.T @ (weight * (p - y)) + 1e-2 * np.array([w[0], 0])
        hess = (a.T * (weight * p * (1 - p))) @ a + 1e-2 * np.eye(2)
        w = w - np.linalg.solve(hess, grad)
    return float(w[0]), float(w[1])


def inserted(word: bytes) -> list[bytes]:
    """A word with one more letter at each of its inner places."""
    return [word[:i] + bytes([(7 * i + word[i]) % 26]) + word[i:] for i in range(1, len(word))]


def fit(texts: list[str], toxic: np.ndarray, weight: np.ndarray, landmarks: int = LANDMARKS) -> Model | None:
    """Fits on whole labelled texts; ``weight``: of each text in the logistic fit."""
    if not len(texts) or toxic.min() == toxic.max():
        return None
    streams = [letters(t) for t in texts]
    words: dict[bytes, int] = {}
    sentences: list[list[int]] = []
    source: list[int] = []
    in_docs: tuple[Counter, Counter] = (Counter(), Counter())
    for k, s in enumerate(streams):
        seen: set[int] = set()
        for part in s.tobytes().split(bytes([STOP])):
            own = [words.setdefault(w, len(words)) for w in part.split(bytes([GAP])) if len(w) >= LENGTH]
            if own:
                sentences.append(own)
                source.append(k)
                seen.update(own)
        in_docs[int(toxic[k])].update(seen)
    if len({int(toxic[k]) for k in source}) < 2:
        return None
    names, source = list(words), np.array(source)
    n = [max(1, int((toxic == c).sum())) for c in (0, 1)]
    share = np.array([[in_docs[c][i] / n[c] for i in range(len(names))] for c in (0, 1)])
    odds = (share[1] - share[0]) / np.sqrt(share.mean(axis=0) + 5 / sum(n))
    chosen = np.argsort(-odds, kind="stable")[:landmarks // 2].tolist()
    common = np.argsort(-share[0], kind="stable").tolist()
    chosen += [i for i in common if i not in set(chosen)][:landmarks - len(chosen)]

    variants = [[words.setdefault(v, len(words)) for v in inserted(names[i])] for i in chosen]
    names = list(words)
    joined = np.frombuffer(b"".join(w + bytes([GAP]) for w in names) + bytes([STOP] * SPAN), np.uint8)
    ends = np.flatnonzero(joined == GAP)
    starts = np.concatenate([[0], ends[:-1] + 1])
    norm, word_of = _norms(ends - starts), np.searchsorted(ends, np.arange(ends[-1] + 1))
    room = ends[word_of] - np.arange(len(word_of))
    picked = np.full(len(names), -1)
    picked[chosen] = np.arange(len(chosen))
    place, rows = np.full(1 << TABLE_BITS, -1), []
    all_codes = [(_codes(joined, p)[:len(word_of)], room > p[-1], DECAY ** (p[-1] + 1)) for p in PATTERNS]
    for code, valid, _ in all_codes:
        rows.append(code[valid & (picked[word_of] >= 0)])
    used = np.unique(np.concatenate(rows))
    place[used] = np.arange(len(used))
    maps = np.zeros((len(used), len(chosen)), np.float32)  # of the landmarks
    for code, valid, decay in all_codes:
        at = np.flatnonzero(valid & (picked[word_of] >= 0))
        np.add.at(maps, (place[code[at]], picked[word_of[at]]), decay)
    maps /= norm[chosen]
    kernel = np.zeros((len(names), len(chosen)), np.float32)
    for code, valid, decay in all_codes:
        at = np.flatnonzero(valid & (place[code] >= 0))
        for some in np.array_split(at, len(at) // 100_000 + 1):
            if len(some):
                own, first = np.unique(word_of[some], return_index=True)
                kernel[own] += np.add.reduceat(maps[place[code[some]]], first, axis=0) * decay
    kernel /= norm[:, None]
    values, vectors = np.linalg.eigh(kernel[chosen].astype(np.float64))
    root = (vectors / np.sqrt(np.maximum(values, 1e-3 * values.max()))) @ vectors.T
    mapped = (kernel @ root).astype(np.float32)
    x = np.zeros((len(sentences), len(chosen)), np.float32)
    for k, own in enumerate(sentences):
        x[k] = mapped[own].sum(axis=0)
    y = np.where(toxic[source] > 0, 1.0, -1.0)
    w, bias = _svm(x, y, np.ones(len(y)))
    value, best = x @ w + bias, np.full(len(texts), -np.inf)
    np.maximum.at(best, source, value)
    kept = np.flatnonzero((y < 0) | (value >= 0) | (value >= best[source]))
    around = x[y < 0]
    added = [mapped[v] + around[(97 * k + 31 * j) % len(around)] for j, (i, own) in enumerate(zip(chosen, variants))
             if mapped[i] @ w + bias > 0 for k, v in enumerate(own)]
    x, y = np.concatenate([x[kept], np.reshape(added, (-1, x.shape[1])).astype(np.float32)]), np.concatenate([y[kept], np.ones(len(added))])
    weights = np.ones(len(y))
    weights[len(kept):] = ADDED_SHARE * len(kept) / max(1, len(added))
    w, bias = _svm(x, y, weights)
    table = np.zeros(1 << TABLE_BITS, np.float32)
    table[used] = maps @ (root @ w)
    found = document_values(texts, table) + bias
    return Model(table, bias, *_logistic(found, toxic.astype(float), weight))


def train(docs: DataFrame, labels: DataFrame, toxic_docs: int = TOXIC_DOCS, clean_docs: int = CLEAN_DOCS) -> Model | None:
    """Learns from ``doc_id, text`` and ``doc_id, toxic``, up to the sample's bounds."""
    labels = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).filter("toxic in (0, 1) and doc_id is not null")
    number = dict(labels.groupBy("toxic").count().collect())
    if len(number) < 2:
        return None
    rate = {0: min(1.0, clean_docs / number[0]), 1: min(1.0, toxic_docs / number[1])}
    limit = F.when(F.col("toxic") == 1, rate[1]).otherwise(rate[0]) * (1 << 20)
    sample = labels.filter(F.pmod(F.xxhash64("doc_id", F.lit("toxic")), F.lit(1 << 20)) < limit)
    found = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")

    def fitted(rows: pa.Table) -> Model | None:
        rows = rows.sort_by([("toxic", "ascending"), ("text", "ascending")])
        toxic = rows["toxic"].to_numpy()
        return fit(rows["text"].to_pylist(), toxic, np.where(toxic > 0, 1 / rate[1], 1 / rate[0]))

    return fit_in_task(found.select("text", "toxic"), fitted)


def toxicity(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """Probability (double) that a text is toxic."""
    if model is None:
        return F.lit(0.0)
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        m = shared.value
        value = document_values(texts.to_pylist(), m.table) + m.bias
        return pa.array(1 / (1 + np.exp(-np.clip(m.slope * value + m.offset, -30, 30))))

    return score(F.coalesce(text, F.lit("")))


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Trains on labelled rows that are not held out and scores all; adds ``held_out, score, predicted``."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    found = docs.withColumn("_llm_score", toxicity(F.col("text"), model, docs.sparkSession))
    return found.select(*[f"`{c}`" for c in docs.columns if c not in ("held_out", "score", "predicted")],
                        held_out(F.col("doc_id")).alias("held_out"), F.col("_llm_score").alias("score"),
                        (F.col("_llm_score") >= threshold).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score is below the threshold, with all columns."""
    model = train(docs, labels.filter(~held_out(F.col("doc_id"))))
    found = docs.withColumn("_llm_score", toxicity(F.col("text"), model, docs.sparkSession))
    return found.filter(F.col("_llm_score") < threshold).select(*[f"`{c}`" for c in docs.columns])
