"""Messages: a payload and a map of text attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from rostrum.operators import errors
from rostrum.schemas import MESSAGE


def read_message_stream(spark: SparkSession, path: str, file_format: str = "parquet",
                        files_per_batch: int = 1000) -> DataFrame:
    """A stream of messages from files; any other source with these two columns will do."""
    return (
        spark.readStream.schema(MESSAGE).format(file_format)
        .option("maxFilesPerTrigger", files_per_batch).load(path)
    )


#: Attributes that tell a message from others, and when it was sent first.
MESSAGE_ID, PUBLISHED = "message_id", "publish_time"


def first_deliveries(stream: DataFrame, delay: str = "1 hour", id_attribute: str = MESSAGE_ID,
                     time_attribute: str = PUBLISHED) -> DataFrame:
    """A stream's messages without redeliveries: of messages with one id, the first to arrive.

    Ids are kept, by id over all tasks, until ``delay`` after their message was published, by the latest time
    seen; the state does not grow beyond that. A message that arrives later still is dropped and
    counted (:func:`late_messages`). Messages without an id or a readable time cannot be told apart: all of them stay.
    """
    time = F.try_to_timestamp(F.col("attributes")[time_attribute])
    known = F.col("attributes")[id_attribute].isNotNull() & time.isNotNull()
    rows = stream.withColumns({"message__id": F.col("attributes")[id_attribute], "message__time": time}).filter(known)
    first = rows.withWatermark("message__time", delay).dropDuplicatesWithinWatermark(["message__id"])
    return first.select(*stream.columns).unionByName(stream.filter(~known))


def late_messages(query: StreamingQuery) -> int:
    """How many messages a run has dropped for coming after their delay, as far as its progress reaches back."""
    return sum(int(operator.numRowsDroppedByWatermark) for progress in query.recentProgress for operator in progress.stateOperators)


def isolate_attributes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attributes as columns; a message without attributes is flagged."""
    df = errors.flag(df, F.col("attributes").isNull(), "message has no attributes", errors.ISOLATE)
    return df.select(*[F.col("attributes")[k].alias(k) for k in keys], errors.ERRORS)


def to_messages(df: DataFrame, payload: str = "No message provided.") -> DataFrame:
    """Each row as a message: columns become attributes, all as text."""
    names = F.array(*[F.lit(c) for c in df.columns])
    values = F.array(*[F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in df.columns])
    return df.select(F.lit(payload).cast("binary").alias("data"),
                     F.map_from_arrays(names, values).alias("attributes"))
