"""License scan: an exact set-similarity join of text blocks with license templates.

Blocks are runs of ``BLOCK_WORDS`` words (more for long templates), each half overlapping the next, so every run of half as many
words lies in one block. A block matches a template when it contains at least ``CONTAINMENT`` of the
template's different words. Template words are ordered by the number of documents that have them, over
all documents, the rarest first. A match needs one of a template's first words in that order (prefix
filter), as many template words as the threshold asks for (length filter), and enough words after the
last shared first word (positional filter); what is left is counted in full, so no match is missed.

Beside the join, phrases are counted where their words stand consecutively. Null texts are empty: no
words, no labels, score 0. Repeated rows each get their result; null ids are kept; an empty table gives
no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import KEY, with_key
from rostrum.sources.sinks import stored

BLOCK_WORDS = 64
CONTAINMENT = 0.8
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
#: Label and words of each template.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
]
#: Letters A-Z are lowered before; other ASCII signs part words, all beyond ASCII belongs to them.
PARTING = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCANNED = ("struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:array<string>,"
           "blocks:array<struct<block:int,ranks:array<int>>>>")


def words_of(text: bytes) -> list[bytes]:
    return text.lower().translate(PARTING).split()


def word_documents(docs: DataFrame, vocabulary: set[bytes]) -> dict[bytes, int]:
    """In how many documents each word of the (bounded) vocabulary stands."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = dict.fromkeys(vocabulary, 0)
        for batch in batches:
            for t in batch.column(0):
                for w in vocabulary.intersection(words_of(t.as_buffer().to_pybytes())):
                    number[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in number]), pa.array(list(number.values()), pa.int64())], ["word", "n"])

    found = docs.select(F.coalesce("text", F.lit("")).alias("text")).mapInArrow(counted, "word string, n bigint")
    return {r["word"].encode(): r["n"] for r in found.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def scan(text: Column, rank: Mapping[bytes, int], first: frozenset[int], phrases: Mapping[str, str], block_words: int) -> Column:
    """Words and phrase places of a text, and the ranks in each block that has one of ``first``."""
    needles = [(label, b" %b " % phrase.encode(), phrase.split()[-1].encode()) for label, phrase in phrases.items()]
    half = block_words // 2

    @F.arrow_udf(SCANNED)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = []
        for t in texts:
            words = words_of(raw := t.as_buffer().to_pybytes())
            low, starts, labels = raw.lower(), [], []
            joined = b" %b " % b" ".join(words) if any(last in low for _, _, last in needles) else b""
            for label, needle, _ in needles:
                at = joined.find(needle)
                labels += [label] * (at >= 0)
                while at >= 0:
                    starts.append(joined.count(b" ", 0, at))
                    at = joined.find(needle, at + 1)
            blocks: dict[int, set[int]] = {}
            hits = [(i, rank[w]) for i, w in enumerate(words) if w in rank]
            if any(r in first for _, r in hits):
                for i, r in hits:
                    for b in {i // half, max(0, i // half - 1)}:
                        blocks.setdefault(b, set()).add(r)
            rows.append({
                "n_words": len(words), "n_base": len(starts), "first_word": min(starts, default=None),
                "last_word": max(starts, default=None), "base_labels": labels,
                "blocks": [{"block": b, "ranks": sorted(r)} for b, r in sorted(blocks.items()) if not first.isdisjoint(r)]})
        kind = pa.struct([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                          ("base_labels", pa.list_(pa.string())),
                          ("blocks", pa.list_(pa.struct([("block", pa.int32()), ("ranks", pa.list_(pa.int32()))])))])
        return pa.array(rows, kind)

    return scanned(F.coalesce(text, F.lit("")))


def matches(blocks: DataFrame, templates: list[tuple[str, list[int], int]]) -> DataFrame:
    """Blocks (``KEY, block, ranks``) with the templates (label, sorted ranks, least overlap) that they contain."""
    spark = blocks.sparkSession
    index = spark.createDataFrame(
        [(r, t, j) for t, (_, ranks, least) in enumerate(templates) for j, r in enumerate(ranks[:len(ranks) - least + 1])],
        "rank int, template int, j int")
    facts = spark.createDataFrame([(t, label, ranks, least) for t, (label, ranks, least) in enumerate(templates)],
                                  "template int, label string, wanted array<int>, least int")
    at = blocks.select(*KEY, "block", "ranks", F.posexplode("ranks").alias("i", "rank"))
    shared = at.join(F.broadcast(index), "rank").groupBy(*KEY, "block", "template").agg(
        F.first("ranks").alias("ranks"), F.count("*").alias("seen"), F.max("i").alias("i"), F.max("j").alias("j"))
    left = F.least(F.size("ranks") - F.col("i"), F.size("wanted") - F.col("j")) - 1
    near = shared.join(F.broadcast(facts), "template").filter(
        (F.size("ranks") >= F.col("least")) & (F.col("seen") + left >= F.col("least")))
    both = F.size(F.array_intersect("ranks", "wanted"))
    return near.withColumn("overlap", both).filter(F.col("overlap") >= F.col("least")).select(
        *KEY, "block", "label", (F.col("overlap") / F.size("wanted")).alias("containment"))


def scan_documents(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
                   containment: float = CONTAINMENT, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document with its phrase places, labels and the best containment.

    Blocks have ``block_words`` words, or twice those of the longest template, so that each template fits half a block.
    """
    block_words = max([block_words, *(2 * len(words_of(text.encode())) for _, text in templates)])
    sets = [(label, set(words_of(text.encode()))) for label, text in templates]
    number = word_documents(docs, set().union(*(s for _, s in sets)))
    order = sorted(set().union(*(s for _, s in sets)), key=lambda w: (number.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    ranked = [(label, sorted(rank[w] for w in s), math.ceil(round(containment * len(s), 9))) for label, s in sets]
    first = frozenset(r for _, ranks, least in ranked for r in ranks[:len(ranks) - least + 1])
    rows = with_key(docs.select("doc_id", "text")).select("doc_id", *KEY, scan(F.col("text"), rank, first, phrases, block_words).alias("s"))
    rows = stored(rows.select("doc_id", *KEY, "s.*"), "scanned")
    blocks = rows.filter(F.size("blocks") > 0).select(*KEY, F.explode("blocks").alias("b")).select(*KEY, "b.*").distinct()
    found = matches(blocks, ranked).groupBy(*KEY).agg(F.collect_set("label").alias("more"), F.max("containment").alias("best"))
    text = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    none = F.array().cast("array<string>")
    return rows.drop("blocks").join(found, KEY, "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", text("base_labels").alias("base_labels"),
        text(F.concat("base_labels", F.coalesce("more", none))).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"))
