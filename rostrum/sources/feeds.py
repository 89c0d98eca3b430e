"""Landed CSV feeds: reading, line parsing and landing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.operators import errors
from rostrum.operators.project import filter_keys
from rostrum.schemas import CORRUPT, FEEDS, INDEX, csv_schema
from rostrum.session import shared_dir
from rostrum.sources.records import read_records

_OPTIONS = {
    "header": "true",
    "mode": "PERMISSIVE",
    "escape": '"',
    "columnNameOfCorruptRecord": CORRUPT,
    # with pruned columns the reader would no longer notice lines of a wrong length
    "columnPruning": "false",
}


#: How feeds and error files are written: spaces at the ends of values belong to them.
CSV_WRITE = {"header": "true", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _split(df: DataFrame, feed: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Lines with the wrong number of fields are flagged; empty fields are empty text, not NULL."""
    broken = F.col(CORRUPT).isNotNull()
    message = F.concat(F.lit("wrong number of fields in record "), F.coalesce(INDEX, F.lit("?")),
                       F.lit(": "), F.col(CORRUPT))
    df = errors.flag(df, broken, message, errors.SPLIT)
    return df.select(*keep, *[F.coalesce(F.col(c), F.lit("")).alias(c) for c in FEEDS[feed]],
                     errors.ERRORS)


def house_feed_name(spark: SparkSession, path: str) -> str:
    """Which of the two house layouts lies at ``path``, by the header of its first file."""
    columns = spark.read.option("header", True).csv(path).columns
    return "house_members_dated" if "date" in columns else "house_members"


def read_feed(spark: SparkSession, path: str, feed: str, multi_line: bool = True) -> DataFrame:
    """Values may hold line breaks, for which a file is read by one task; landed feeds have many files, and
    :func:`read_split_feed` splits large ones.
    Without ``multi_line`` a file is split, and its values must lie on one line."""
    reader = spark.read.schema(csv_schema(feed)).options(**_OPTIONS).option("multiLine", multi_line)
    return _split(reader.csv(path), feed)


def read_split_feed(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """The rows of :func:`read_feed`, with line breaks in values, from files of any size: every file is read by many tasks."""
    return split_lines(read_records(spark, path), F.col("record"), feed)


def read_members(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """House members of both layouts, file by file; ``date`` is NULL where the file has none."""
    short, wide = "house_members", "house_members_dated"
    reader = spark.read.schema(csv_schema(wide)).options(**_OPTIONS).option("multiLine", multi_line)
    df = reader.csv(path)
    schema = csv_schema(short)
    options = {k: v for k, v in _OPTIONS.items() if k not in ("header", "columnPruning")}
    line = F.from_csv(F.col(CORRUPT), F.lit(schema.simpleString()[len("struct<"):-1].replace(":", " ")), options)
    df = df.withColumn("short", F.when(F.col(CORRUPT).isNotNull(), line))
    fits = F.col("short").isNotNull() & F.col(f"short.{CORRUPT}").isNull()
    df = df.withColumns({c: F.when(fits, F.col(f"short.{c}")).otherwise(F.col(c)) for c in FEEDS[short]})
    df = df.withColumns({"date": F.when(~fits, F.col("date")), CORRUPT: F.when(~fits, F.col(CORRUPT))}).drop("short")
    return _split(df, wide)


def read_feed_stream(spark: SparkSession, path: str, feed: str, multi_line: bool = True) -> DataFrame:
    reader = spark.readStream.schema(csv_schema(feed)).options(**_OPTIONS).option("multiLine", multi_line)
    return _split(reader.csv(path), feed)


def split_lines(df: DataFrame, line: Column, feed: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same for lines that are already loaded as a text column."""
    schema = csv_schema(feed)
    options = {k: v for k, v in _OPTIONS.items() if k not in ("header", "columnPruning")}
    parsed = F.from_csv(line, F.lit(schema.simpleString()[len("struct<"):-1].replace(":", " ")), options)
    return _split(df.select(*keep, parsed.alias("r")).select(*keep, "r.*"), feed, keep)


def numbered(df: DataFrame, order_by: Sequence[str], name: str = INDEX) -> DataFrame:
    """Running numbers from 0 in the given order, counted in parallel.

    The rows are written once in sorted ranges; a row's number is its place in its range plus the
    rows of earlier ranges, of which only one count per range is needed. The range of a row is
    stored with it, since a second range partitioning could draw other bounds. Rows that are alike
    in all order columns are ranked by their other values and by task, so that they spread as well.
    """
    part, place = "numbered__part", "numbered__place"
    rest = [F.xxhash64(*df.columns), F.spark_partition_id()]
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = {"numbered__tie0": rest[0], "numbered__tie1": rest[1]}
    order = [*order_by, *keys]
    path = shared_dir(df.sparkSession, "numbered")
    df.withColumns(keys).repartitionByRange(parts, *order) \
        .withColumn(part, F.spark_partition_id()).write.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    counts = stored.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    # one row per range: at most the number of shuffle partitions
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(part, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy(part).orderBy(*order)
    placed = stored.withColumn(place, F.row_number().over(within) - 1)
    return placed.join(F.broadcast(offsets), part) \
        .withColumn(name, F.col("offset") + F.col(place)).select(name, *df.columns)


def land_feed(df: DataFrame, feed: str, path: str, order_by: Sequence[str] = ()) -> None:
    """Write a feed as CSV files with a leading index field, replacing what was there.

    The index carries no information for the readers, which drop it: it is empty unless an order is
    given.
    """
    columns = filter_keys(df, FEEDS[feed])
    if order_by:
        landed = numbered(columns, order_by)
    else:
        landed = columns.select(F.lit(None).cast("string").alias(INDEX), *FEEDS[feed])
    landed.write.mode("overwrite").options(**CSV_WRITE).csv(path)


def belongs_to(keys: Column, columns: tuple[str, ...]) -> Column:
    """A record belongs to a feed when the feed knows all of its keys."""
    return F.size(F.array_except(keys, F.array(*[F.lit(c) for c in columns]))) == 0


def route_records(df: DataFrame, record: Column, feed: str) -> DataFrame:
    """Records of one feed out of a mixed map column, as columns."""
    kept = df.filter(belongs_to(F.map_keys(record), FEEDS[feed]))
    return kept.select(*[record[c].alias(c) for c in FEEDS[feed]])
