"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the one before kept. All but the last
return the columns of ``docs``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rostrum.llm import ordinal_quality, simhash_pivot, ss_pack, string_kernel, tree_dedup
from rostrum.llm.common import ship
from rostrum.sources.sinks import stored


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the graded ratings select."""
    return ordinal_quality.keep_good(docs, ordinal_quality.graded(_table(spark, sf_dir, "labels")))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    return string_kernel.keep_clean(docs, _table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts, that with the largest id."""
    return tree_dedup.keep_one(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked fingerprints (three words, two bits), that with the smallest id."""
    ship(spark)
    return simhash_pivot.keep_one(docs, radius=simhash_pivot.RADIUS, shingle=simhash_pivot.SHINGLE)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences."""
    ship(spark)
    return ss_pack.pack(docs)


STAGES = [
    ("quality classifier", quality),
    ("toxicity", toxicity),
    ("exact dedup", exact_dedup),
    ("near dedup", near_dedup),
    ("best-fit packing", packing),
]

#: Classifiers and packing have no SQL form; tests compare the stages with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next reads it."""
    docs = _table(spark, sf_dir, "documents")
    *filters, (_, last) = STAGES
    for name, stage in filters:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
