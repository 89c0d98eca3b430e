"""Row keys and filters that several operators share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rostrum.session import ship  # noqa: F401, operators take it from here

#: Stands for a null id in row keys.
NULL_ID = -(1 << 63)
#: Names of the columns that ``with_key`` adds; no table has such names.
KEY = ["_llm_id", "_llm_hash"]


def with_key(docs: DataFrame) -> DataFrame:
    """Adds a key that equal ids with equal texts share. Null texts count as empty."""
    return docs.withColumns({
        KEY[0]: F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NULL_ID)),
        KEY[1]: F.xxhash64(F.coalesce("text", F.lit("")))})


def keep_keys(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """One row of ``docs`` for each of ``keys`` (``KEY``), all columns; one shuffle of the documents."""
    found = with_key(docs).join(keys.select(*KEY), KEY, "left_semi")
    one = found.withColumn("_llm_nth", F.row_number().over(Window.partitionBy(*KEY).orderBy(KEY[1])))
    return one.filter(F.col("_llm_nth") == 1).select(*[f"`{c}`" for c in docs.columns])


def fit_in_task(sample: DataFrame, fit: Callable[[pa.Table], Any]) -> Any:
    """``fit`` of a sample of bounded size, in one task: the driver only receives the fitted model."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = list(batches)
        model = fit(pa.Table.from_batches(found)) if found else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])

    fitted = sample.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(fitted["model"]) if fitted else None
