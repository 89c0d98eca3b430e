"""Quality by ordinal regression: one weight per hashed piece of text, ordered thresholds between grades.

The log-odds of a grade of at least k are the text's value minus threshold k; all grades share the
weights. A text's value is the mean weight of its byte trigrams, hashed to ``BUCKETS``, plus the weights
of a few hashed facts about its words (share of repeats, of capitals, of signs, and so on). From it come
the expected grade and the tail probability by which texts are selected.

Fitted on about ``RATED_DOCS`` rated documents, chosen by a hash of the id, with whole texts (only their
hashed features leave the tasks). Scoring reads whole texts of all rows. Texts without a word, null ones
included, have the lowest grade for certain. Without ratings of two grades every text has the highest
one. Ratings may be any integers; null ratings teach nothing. Repeated rows are each scored; an empty
table gives no rows; extra columns stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm.common import fit_in_task
from rostrum.llm.ppm_langid import held_out

BUCKETS = 4096
FACTS = 8
RATED_DOCS = 4000
#: Least tail probability of the second grade for a text to be selected.
LEAST_TAIL = 0.35
STEP = 1 << 20


def buckets(raw: np.ndarray) -> np.ndarray:
    """Bucket of the trigram that starts at each byte but the last two."""
    raw = raw.astype(np.uint32)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return (code * np.uint32(0x9E3779B1)) >> np.uint32(20)


def facts(text: str) -> list[float]:
    """Facts about the words, each from 0 to 1 or little more."""
    words, n = text.split(), max(1, len(text))
    m = max(1, len(words))
    kinds = len(set(words))
    lines = text.split("\n")
    return [sum(map(eq, words, words[1:])) / m, kinds / m, kinds / m ** 0.7, sum(map(str.isupper, words)) / m,
            sum(map(str.isalpha, words)) / m, len(set(lines)) / len(lines), min(1.0, n / m / 16), min(1.0, np.log10(1 + m) / 4)]


def features(text: str) -> np.ndarray:
    """Share of each bucket, then the facts."""
    raw = np.frombuffer(text.encode("utf-8", "replace") + b"\n\n", np.uint8)
    counts = np.zeros(BUCKETS)
    for at in range(0, len(raw) - 2, STEP):
        counts += np.bincount(buckets(raw[at:at + STEP + 2]), minlength=BUCKETS)
    return np.concatenate([counts / counts.sum(), facts(text)]).astype(np.float32)


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray  # of buckets, then of facts
    bias: float
    thresholds: np.ndarray


def fit(x: np.ndarray, grade: np.ndarray, rounds: int = 400, decay: float = 3e-3) -> Model | None:
    """Cumulative-link fit by gradient steps with momentum and adapted lengths."""
    grades = np.unique(grade)
    if len(grades) < 2:
        return None
    y = np.searchsorted(grades, grade)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-6
    x = np.clip((x - mean) / scale, -5, 5).astype(np.float32)
    above = [(y >= k).mean() for k in range(1, len(grades))]
    cuts = -np.log(np.array(above) / (1 - np.array(above)))
    params = np.concatenate([np.zeros(x.shape[1]), cuts[:1], np.log(np.maximum(1e-3, np.diff(cuts)))]).astype(np.float32)
    d, first, second = x.shape[1], np.zeros_like(params), np.zeros_like(params)
    edge = np.float32(30)

    def limits(p: np.ndarray) -> np.ndarray:
        return np.concatenate([p[d:d + 1], p[d] + np.cumsum(np.exp(p[d + 1:]))])

    for t in range(1, rounds + 1):
        cut = np.concatenate([[-edge], limits(params), [edge]])
        value = x @ params[:d]
        low, high = (1 / (1 + np.exp(-np.clip(cut[y + s] - value, -edge, edge))) for s in (0, 1))
        inside = np.maximum(high - low, 1e-6)
        d_low, d_high = low * (1 - low) / inside, high * (1 - high) / inside
        by_value = (d_high - d_low) / len(y)  # of minus the log-likelihood
        by_cut = np.array([(d_low[y == k].sum() - d_high[y == k - 1].sum()) / len(y) for k in range(1, len(grades))])
        grad = np.concatenate([x.T @ by_value.astype(np.float32) + decay * params[:d],
                               [by_cut.sum()], np.exp(params[d + 1:]) * np.cumsum(by_cut[::-1])[::-1][1:]])
        first, second = 0.9 * first + 0.1 * grad, 0.99 * second + 0.01 * grad ** 2
        params = (params - 0.02 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-8)).astype(np.float32)
    weights = params[:d] / scale
    return Model(grades.tolist(), weights.astype(np.float32), float(-(weights * mean).sum()), limits(params))


def values(texts: list[str], model: Model) -> np.ndarray:
    """Each text's value on the scale of the thresholds."""
    own, hashed = model.weights[BUCKETS:], model.weights[:BUCKETS]
    out = np.empty(len(texts))
    for k, text in enumerate(texts):
        raw = np.frombuffer(text.encode("utf-8", "replace") + b"\n\n", np.uint8)
        total = sum(float(hashed[buckets(raw[at:at + STEP + 2])].sum()) for at in range(0, len(raw) - 2, STEP))
        out[k] = total / max(1, len(raw) - 2) + own @ facts(text) + model.bias
    return out


def train(docs: DataFrame, ratings: DataFrame, rated_docs: int = RATED_DOCS) -> Model | None:
    """Learns from ``doc_id, text`` and ``doc_id, grade``, up to the sample's bound."""
    ratings = ratings.select("doc_id", F.col("grade").cast("int").alias("grade")).dropna()
    limit = min(1.0, rated_docs / max(1, ratings.count())) * (1 << 20)
    sample = ratings.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < limit)

    @F.arrow_udf("binary")
    def shares(texts: pa.Array) -> pa.Array:
        return pa.array([features(t).astype(np.float16).tobytes() for t in texts.to_pylist()], pa.binary())

    found = docs.select("doc_id", "text").filter(F.col("text").isNotNull()).join(F.broadcast(sample), "doc_id")

    def fitted(rows: pa.Table) -> Model | None:
        rows = rows.sort_by([("grade", "ascending"), ("x", "ascending")])
        x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float16).reshape(rows.num_rows, -1).astype(np.float32)
        return fit(x, rows["grade"].to_numpy())

    return fit_in_task(found.select("grade", shares("text").alias("x")), fitted)


def quality(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """``struct<expected_grade: double, tail: double, grade: int>``; ``tail`` of the second grade."""
    kind = "struct<expected_grade:double,tail:double,grade:int>"
    if model is None:
        return F.struct(F.lit(1.0).alias("expected_grade"), F.lit(1.0).alias("tail"), F.lit(1).alias("grade")).cast(kind)
    shared = spark.sparkContext.broadcast(model)
    lowest = F.struct(F.lit(float(model.grades[0])), F.lit(0.0), F.lit(model.grades[0])).cast(kind)

    @F.arrow_udf(kind)
    def rate(texts: pa.Array) -> pa.Array:
        m = shared.value
        value = values(texts.to_pylist(), m)
        tails = 1 / (1 + np.exp(-np.clip(value[:, None] - m.thresholds, -30, 30)))
        expected = m.grades[0] + tails @ np.diff(m.grades)
        grade = np.array(m.grades, np.int32)[(tails >= 0.5).sum(axis=1)]
        return pa.StructArray.from_arrays([pa.array(expected), pa.array(tails[:, 0]), pa.array(grade)], ["expected_grade", "tail", "grade"])

    return F.when(text.rlike(r"\S"), rate(F.coalesce(text, F.lit("")))).otherwise(lowest)


def graded(labels: DataFrame) -> DataFrame:
    """Grades from the label table: 0 low quality, 1 good but toxic, 2 good."""
    grade = F.when(F.col("quality") == 0, 0).when((F.col("quality") == 1) & (F.col("toxic") == 1), 1).when(F.col("quality") == 1, 2)
    return labels.select("doc_id", grade.alias("grade"))


def _rated(docs: DataFrame, ratings: DataFrame) -> DataFrame:
    model = train(docs, ratings.filter(~held_out(F.col("doc_id"))))
    return docs.withColumn("_llm_rate", quality(F.col("text"), model, docs.sparkSession))


def rate_documents(docs: DataFrame, ratings: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """Trains on rated rows that are not held out; adds ``held_out, expected_grade, tail, grade, selected``."""
    new = ("held_out", "expected_grade", "tail", "grade", "selected")
    return _rated(docs, ratings).select(
        *[f"`{c}`" for c in docs.columns if c not in new], held_out(F.col("doc_id")).alias("held_out"), "_llm_rate.*",
        (F.col("_llm_rate.tail") >= least_tail).alias("selected"))


def keep_good(docs: DataFrame, ratings: DataFrame, least_tail: float = LEAST_TAIL) -> DataFrame:
    """The rows of ``docs`` that are selected, with all columns."""
    return _rated(docs, ratings).filter(F.col("_llm_rate.tail") >= least_tail).select(*[f"`{c}`" for c in docs.columns])
