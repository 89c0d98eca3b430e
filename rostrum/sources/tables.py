"""Stored tables: reading dimensions, appending, updating."""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.operators.lookup import BROADCAST_LIMIT, first_nickname


def dimension(df: DataFrame) -> DataFrame:
    """All columns as text. NULL stays NULL."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def read_dimension(spark: SparkSession, table: str) -> DataFrame:
    return dimension(spark.table(table))


def name_listing(df: DataFrame, ordered: bool = True) -> DataFrame:
    """``id, first_name, last_name`` of a stored table, by id where asked."""
    listing = df.select("id", "first_name", "last_name")
    return listing.orderBy("id") if ordered else listing


def append_to_table(df: DataFrame, table: str) -> None:
    """Append by column name to a table that must exist; absent columns are NULL."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    present = set(df.columns)
    fields = spark.table(table).schema.fields
    df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in fields
    ]).write.mode("append").insertInto(table)


#: Partition columns of tables that streams write to: the run and its batch. Batch loads leave them NULL.
RUN, BATCH = "run_id", "batch_id"


def write_batch_rows(df: DataFrame, table: str, run: str, batch_id: int) -> None:
    """A micro-batch's rows into a table partitioned by run and batch: writing them again replaces them."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        raise ValueError(f"table {table} does not exist")
    present = set(df.columns)
    *fields, last_but_one, last = spark.table(table).schema.fields
    if [last_but_one.name, last.name] != [RUN, BATCH]:
        raise ValueError(f"table {table} is not partitioned by {RUN}, {BATCH}")
    rows = df.select(*[
        (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])
    spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({RUN} = :run, {BATCH} = :batch) SELECT * FROM {{rows}}",
              args={"run": run, "batch": batch_id}, rows=rows)


def publish(spark: SparkSession, manifest: str, run: str) -> None:
    """Make a load's rows visible, in all tables at once: one small file, which a repetition replaces."""
    spark.range(1).select(F.lit(run).alias("published")).coalesce(1) \
        .write.mode("overwrite").parquet(f"{manifest}/load={quote(run, safe='')}")


def is_published(spark: SparkSession, manifest: str, run: str) -> bool:
    return path_exists(spark, f"{manifest}/load={quote(run, safe='')}/_SUCCESS")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file is there, in whatever store Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_published(spark: SparkSession, table: str, manifest: str) -> DataFrame:
    """A table's rows of published loads, and those that belong to no load."""
    rows = spark.table(table)
    if not path_exists(spark, manifest):
        return rows.filter(F.col(RUN).isNull())
    loads = spark.read.schema("published string").parquet(manifest).select(F.col("published").alias(RUN)).distinct()
    return rows.filter(F.col(RUN).isNull()).unionByName(rows.join(loads, RUN, "left_semi"))


def revise_names(politicians: DataFrame, nicknames: DataFrame,
                 broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The stored politicians with nicknames replaced; every other row and column as it was."""
    columns = politicians.columns
    revised = first_nickname(politicians, nicknames, broadcast_limit)
    return revised.select(*columns, *(["nickname"] if "nickname" not in columns else []))


def rewrite_table(df: DataFrame, path: str) -> None:
    """Write a revised table as a new version; a version that is being read is never replaced."""
    df.write.mode("errorifexists").parquet(path)
