"""Error files, staged results and micro-batch sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.operators import errors
from rostrum.operators.project import filter_keys, make_strings, restore_raw
from rostrum.schemas import ERROR_COLUMNS
from rostrum.session import shared_dir
from rostrum.sources.feeds import CSV_WRITE


def error_record(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feed columns and diagnostics, all text; columns a feed never had are empty."""
    raw = restore_raw(df)
    full = [*columns, *ERROR_COLUMNS]
    texts = make_strings(filter_keys(raw, [c for c in full if c in raw.columns]))
    return texts.select(*[
        F.col(c) if c in texts.columns else F.lit("").alias(c) for c in full
    ])


def write_error_csv(df: DataFrame, columns: Sequence[str], path: str, mode: str = "append") -> None:
    """As many files as there are partitions, each with a header."""
    error_record(df, columns).write.mode(mode).options(**CSV_WRITE).csv(path)


def stage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write a resolved feed once and read it back, for branches that would each compute it again.

    Clean and failed rows go to separate partitions, so every branch reads its own only. The folder
    is shared, so the result outlives any executor. A given ``path`` is replaced.
    """
    path = path or shared_dir(df.sparkSession, label)
    df = errors.with_errors(df).withColumn("failed", errors.has_errors())
    df.write.mode("overwrite").partitionBy("failed").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table that is costly to compute and read back from now on: measuring it, aggregating
    it and joining to it then cost a scan each."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def staged_branches(staged: DataFrame, script: str) -> errors.Branches:
    clean = staged.filter(~F.col("failed")).drop("failed", errors.ERRORS)
    failed = errors.error_rows(staged.filter(F.col("failed")), script).drop("failed")
    return errors.Branches(clean, failed)


def write_topic_files(batch: DataFrame, topics: Mapping[str, Sequence[str]], root: str,
                      batch_id: int | None = None, staging: str | None = None, run_id: str = "") -> None:
    """Error records of several feeds, each topic to files of its own with that feed's columns.

    Records carry an ``attributes`` map with the topic under ``topic_name``. Records of topics that
    are not declared go to ``other`` as text. A batch of a run has its own folder, which a retry replaces.
    The batch is staged once, by topic, so no topic reads the records of another.
    """
    path = staging or shared_dir(batch.sparkSession, "topics")
    name = F.col("attributes")["topic_name"]
    topic = F.when(name.isin(list(topics)), name).otherwise(F.lit("other"))
    batch.select("attributes", topic.alias("topic")) \
        .write.mode("overwrite").partitionBy("topic").parquet(path)
    staged = batch.sparkSession.read.schema(
        "attributes map<string,string>, topic string").parquet(path)
    suffix = "" if batch_id is None else f"/run_id={run_id}/batch_id={batch_id}"
    mode = "append" if batch_id is None else "overwrite"

    def write(rows: DataFrame, to: str) -> None:
        rows.write.mode(mode).options(**CSV_WRITE).csv(f"{root}/{to}{suffix}")

    for kind, columns in topics.items():
        write(staged.filter(F.col("topic") == kind)
              .select(*[F.col("attributes")[c].alias(c) for c in columns]), kind)
    write(staged.filter(F.col("topic") == "other")
          .select(name.alias("topic_name"), F.to_json("attributes").alias("record")), "other")


def topic_values(attributes):
    """The record without its routing key: a map without ``topic_name``."""
    return F.map_filter(attributes, lambda k, _: k != "topic_name")
