"""Landed raw documents: one row per page, with its address."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.schemas import DOCUMENT


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(DOCUMENT).parquet(path)


def read_document_files(spark: SparkSession, path: str) -> DataFrame:
    """One document per file; the file name stands in for the address."""
    files = spark.read.text(path, wholetext=True)
    url = F.input_file_name()
    return files.select(F.xxhash64(url).alias("doc_id"), url.alias("url"), F.col("value").alias("body"))
