"""Streaming runs of the feeds and of the error handler.

Every micro-batch goes through the batch plans. Dimensions are read per batch, so politicians added
by one batch are known to the next. Results go to one folder per run and batch; a retry of a batch
replaces its own folder, so no row is written twice, and no run replaces another's. A run is known by
the id that its checkpoint keeps.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming.query import StreamingQuery

from rostrum.plans.feeds import TARGETS, Dimensions, outputs
from rostrum.session import shared_dir
from rostrum.sources.feeds import CSV_WRITE
from rostrum.sources.messages import isolate_attributes
from rostrum.sources.sinks import error_record, write_topic_files
from rostrum.sources.tables import BATCH, RUN, write_batch_rows

def run_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote to the checkpoint when the run first started."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def write_batch(rows: Mapping[str, DataFrame], failed: DataFrame, columns: Sequence[str], root: str, run: str,
                batch_id: int, tables: Mapping[str, str] | None = None) -> None:
    """Everything one batch of a run writes; writing it again changes nothing. ``tables`` names the
    catalog tables (partitioned by run and batch) that take rows instead of folders."""
    for table, branch in rows.items():
        if table in (tables or {}):
            write_batch_rows(branch, tables[table], run, batch_id)
            continue
        branch.write.mode("overwrite").parquet(f"{root}/{table}/{RUN}={run}/{BATCH}={batch_id}")
    error_record(failed, columns).write.mode("overwrite").options(**CSV_WRITE) \
        .csv(f"{root}/errors/{RUN}={run}/{BATCH}={batch_id}")


def count_rows(spark: SparkSession, counts: Observation) -> DataFrame:
    """``step, n`` of an observation that is complete: a row for each of its few counts."""
    return spark.createDataFrame(list(counts.get.items()), "step string, n bigint")


def message_records(messages: DataFrame, columns: Sequence[str]) -> DataFrame:
    return isolate_attributes(messages, columns)


def stream_feed(stream: DataFrame, feed: str, dims: Callable[[], Dimensions], root: str,
                checkpoint: str, run_date: date | str | None = None,
                add_politicians: bool = True, trigger: Mapping | None = None,
                tables: Mapping[str, str] | None = None, counted: bool = False) -> StreamingQuery:
    """Start a feed: rows of each table under ``root/table`` or in the catalog table that ``tables``
    gives for it, failed rows under ``root/errors``; where ``counted``, the rows that each step of a batch
    failed under ``root/counts``.

    Batches are staged in two folders in turn, so staging does not grow with the stream.
    """
    staging = shared_dir(stream.sparkSession, f"staged-{feed}")

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = Observation() if counted else None
        rows, failed = outputs(feed, batch, dims(), run_date, add_politicians, f"{staging}/{batch_id % 2}", counts)
        run = run_id(batch.sparkSession, checkpoint)
        write_batch(rows, failed, TARGETS[feed][1], root, run, batch_id, tables)
        if counts is not None:
            count_rows(batch.sparkSession, counts).coalesce(1).write.mode("overwrite") \
                .parquet(f"{root}/counts/{RUN}={run}/{BATCH}={batch_id}")

    return (
        stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def stream_errors(messages: DataFrame, topics: Mapping[str, Sequence[str]], root: str,
                  checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """The error handler: messages of all feeds to one set of files per topic."""
    staging = shared_dir(messages.sparkSession, "staged-topics")

    def write(batch: DataFrame, batch_id: int) -> None:
        write_topic_files(batch, topics, root, batch_id, f"{staging}/{batch_id % 2}",
                          run_id(batch.sparkSession, checkpoint))

    return (
        messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )
