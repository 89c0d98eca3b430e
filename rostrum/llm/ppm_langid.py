"""Language identification by partial matching: byte context trees with escape probabilities.

For every language the counts of what follows each context of up to three bytes are frozen after
training, all of them, as sorted arrays of the byte strings and contexts that the sample holds. A byte costs -log2 of its probability: where its context has seen it, its share (method C: the
count over counts and different successors together); else the escape's share and the cost under the
next shorter context, down to 1/256 for every byte. A text's code length is exact under the frozen
counts; the language with the shortest code is predicted, the score is its posterior probability with
equal priors.

The classifier is fitted on whole texts of about ``DOCS_PER_LANGUAGE`` documents per language, chosen
by a hash of the id; that is the bound of its sample and so of its trees, each of which is built in a task
of its own. Predictions read all bytes of all texts.

Null texts, texts without a letter, and all texts where nothing was learned are ``und`` with score 0.
Null languages teach nothing. Equal code lengths go to the smaller name. Repeated rows are each
predicted; an empty table gives no rows; extra columns stay, but those named as a result
(``held_out``, ``lang_pred``, ``score``) give way to it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER = 3
DOCS_PER_LANGUAGE = 2000
LEAD = b"\n" * ORDER  # what stands before a text
STEP = 1 << 22  # bytes priced at once


@dataclass
class Tree:
    """The frozen tree of a language; byte strings are numbers with the last byte lowest."""
    grams: list[np.ndarray]  # sorted byte strings of one to ``ORDER + 1`` bytes, by length
    bits: list[np.ndarray]  # of the last byte of each, where its context has seen it
    contexts: list[np.ndarray]  # sorted contexts of none to ``ORDER`` bytes, by length
    escape: list[np.ndarray]  # bits of leaving each for the next shorter one


@dataclass
class Model:
    languages: list[str]
    trees: list[Tree]


def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of the byte strings of one to ``ORDER + 1`` bytes that end at each byte of a text."""
    for batch in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            by_lang.setdefault(lang, []).append(LEAD + text.as_buffer().to_pybytes())
        for lang, texts in by_lang.items():
            joined = np.frombuffer(b"".join(texts), np.uint8).astype(np.uint32)
            own = np.ones(len(joined), bool)
            starts = np.cumsum([0, *map(len, texts[:-1])])
            for k in range(ORDER):
                own[starts + k] = False
            at, code = np.flatnonzero(own), np.zeros(int(own.sum()), np.uint32)
            for size in range(1, ORDER + 2):
                code = code + (joined[at - size + 1] << np.uint32(8 * (size - 1)))
                found, n = np.unique(code, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), pa.string()), pa.array(np.full(len(found), size, np.int32)),
                     pa.array(found.astype(np.int64)), pa.array(n)], ["lang", "size", "gram", "n"])


def tree(size: np.ndarray, gram: np.ndarray, n: np.ndarray) -> Tree:
    """A language's tree from the counts of its byte strings."""
    found = Tree([], [], [], [])
    for length in range(1, ORDER + 2):
        order = np.flatnonzero(size == length)
        order = order[np.argsort(gram[order])]
        codes, counts = gram[order], n[order].astype(np.float64)
        contexts, where = np.unique(codes >> 8, return_inverse=True)
        kinds = np.bincount(where)
        whole = np.log2(np.bincount(where, counts) + kinds)
        found.grams.append(codes.astype(np.uint32))
        found.bits.append(whole[where] - np.log2(counts))
        found.contexts.append(contexts.astype(np.uint32))
        found.escape.append(whole - np.log2(kinds))
    return found


def _look_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each is among the sorted ``keys``, and its value, else 0."""
    place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    known = keys[place] == wanted
    return known, np.where(known, values[place], 0.0)


def costs(code: np.ndarray, tree: Tree) -> np.ndarray:
    """Bits of the last byte of each string of ``ORDER + 1`` bytes."""
    total = np.zeros(len(code))
    left = np.arange(len(code))
    for length in range(ORDER, -1, -1):
        wanted = code[left] & np.uint32((1 << 8 * (length + 1)) - 1)
        known, bits = _look_up(tree.grams[length], tree.bits[length], wanted)
        total[left] += bits
        left, wanted = left[~known], wanted[~known]
        total[left] += _look_up(tree.contexts[length], tree.escape[length], wanted >> np.uint32(8))[1]
    total[left] += 8.0
    return total


def train(docs: DataFrame, docs_per_language: int = DOCS_PER_LANGUAGE) -> Model | None:
    """Learns from ``text`` and ``lang`` of all rows given, up to the sample's bound."""
    docs = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    per_lang = dict(docs.groupBy("lang").count().collect())
    if not per_lang:
        return None
    share = F.create_map(*[F.lit(x) for lang, n in per_lang.items() for x in (lang, min(1.0, docs_per_language / n))])
    chosen = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < F.element_at(share, F.col("lang")) * (1 << 20)
    found = docs.filter(chosen).select("lang", "text").mapInArrow(grams, "lang string, size int, gram bigint, n bigint")
    found = found.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))

    def grown(counted: pa.Table) -> pa.Table:
        made = tree(*(counted[c].to_numpy() for c in ("size", "gram", "n")))
        return pa.table({"lang": counted["lang"][:1], "tree": pa.array([pickle.dumps(made)], pa.binary())})

    trees = found.groupBy("lang").applyInArrow(grown, "lang string, tree binary").collect()
    trees = sorted((r["lang"], pickle.loads(r["tree"])) for r in trees)
    return Model([lang for lang, _ in trees], [made for _, made in trees]) if trees else None


def code_lengths(texts: list[bytes], model: Model) -> np.ndarray:
    """Bits of every text (rows) under every language (columns). A step's different byte strings are priced once each."""
    starts = np.cumsum([0, *(len(t) + ORDER for t in texts)])
    raw = np.frombuffer(b"".join([x for t in texts for x in (LEAD, t)]), np.uint8)
    total = np.zeros((len(texts), len(model.languages)))
    for p in range(0, len(raw), STEP):
        q = min(len(raw), p + STEP)
        s = raw[max(0, p - ORDER):q].astype(np.uint32)
        s = s if p else np.concatenate([np.zeros(ORDER, s.dtype), s])
        code = s[3:] | s[2:-1] << np.uint32(8) | s[1:-2] << np.uint32(16) | s[:-3] << np.uint32(24)
        which, different = pd.factorize(code)
        first = int(np.searchsorted(starts, p, "right")) - 1
        last = int(np.searchsorted(starts, q, "left"))
        lead = (starts[first:last, None] + np.arange(ORDER) - p).ravel()  # what stands before a text is not coded
        lead = lead[(lead >= 0) & (lead < q - p)]
        bounds = np.maximum(starts[first:last] - p, 0)
        for k, tree in enumerate(model.trees):
            cost = costs(different, tree)[which]
            cost[lead] = 0
            total[first:last, k] += np.add.reduceat(cost, bounds)
    return total


def language(text: Column, model: Model | None, spark: SparkSession) -> Column:
    """``struct<lang_pred: string, score: double>`` of a text."""
    none = F.struct(F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    if model is None:
        return none
    shared = spark.sparkContext.broadcast(model)

    @F.arrow_udf("struct<lang_pred:string,score:double>")
    def predict(texts: pa.Array) -> pa.Array:
        model = shared.value
        bits = code_lengths([t.as_buffer().to_pybytes() for t in texts], model)
        best = bits.argmin(axis=1)
        score = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
        return pa.StructArray.from_arrays(
            [pa.array(np.array(model.languages, dtype=object)[best], pa.string()), pa.array(score)], ["lang_pred", "score"])

    return F.when(text.rlike(r"\p{L}"), predict(F.coalesce(text, F.lit("")))).otherwise(none)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def predict_languages(docs: DataFrame) -> DataFrame:
    """Trains on the rows that are not held out and predicts all; adds ``held_out, lang_pred, score``."""
    model = train(docs.filter(~held_out(F.col("doc_id"))))
    found = docs.withColumn("_llm_found", language(F.col("text"), model, docs.sparkSession))
    return found.select(*[f"`{c}`" for c in docs.columns if c not in ("held_out", "lang_pred", "score")],
                        held_out(F.col("doc_id")).alias("held_out"), "_llm_found.*")
