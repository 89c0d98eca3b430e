"""Tables in buckets and versions: an update writes only the buckets in which a row changes.

``root/data/version=v/bucket=b`` holds the rows that version ``v`` wrote for bucket ``b``, and
``root/manifest/version=v`` one row that says where each bucket of that version lies. Files are never changed: a
reader takes one manifest and sees one version, whatever is written meanwhile. An update that fails before its
manifest is there leaves nothing to see, and repeating it replaces what it had written. One writer at a time.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rostrum.sources.tables import path_exists

BUCKETS = 256
_BUCKET, _BEFORE = "versions__bucket", "versions__before"


def versions(spark: SparkSession, root: str) -> list[int]:
    """Versions that can be read, oldest first."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/manifest/version=*/_SUCCESS")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(int(f.getPath().getParent().getName().partition("=")[2]) for f in found)


def _manifest(spark: SparkSession, root: str, version: int):
    """Schema, key, number of buckets, and the version that wrote each bucket; a row of a size set by the buckets."""
    return spark.read.parquet(f"{root}/manifest/version={version}").first()


def _publish(spark: SparkSession, root: str, version: int, schema: str, keys: Sequence[str], buckets: int, parts: dict[int, int]) -> None:
    row = spark.createDataFrame([(schema, list(keys), buckets, parts)], "schema string, keys array<string>, buckets int, parts map<int,int>")
    row.coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/version={version}")


def _write(rows: DataFrame, root: str, version: int) -> None:
    rows.repartition(_BUCKET).withColumnRenamed(_BUCKET, "bucket").write.mode("overwrite") \
        .partitionBy("bucket").parquet(f"{root}/data/version={version}")


def _bucket(keys: Sequence[str], buckets: int):
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _filled(spark: SparkSession, root: str, version: int, buckets: Sequence[int]) -> list[int]:
    return [b for b in buckets if path_exists(spark, f"{root}/data/version={version}/bucket={b}")]


def create_table(df: DataFrame, root: str, keys: Sequence[str], buckets: int = BUCKETS) -> int:
    """Version 1 of a table; ``keys`` deal the rows to buckets and need not be unique or present."""
    if versions(df.sparkSession, root):
        raise ValueError(f"{root} has versions already")
    if "bucket" in df.columns:
        raise ValueError("a column named bucket cannot be stored")
    spark = df.sparkSession
    _write(df.withColumn(_BUCKET, _bucket(keys, buckets)), root, 1)
    _publish(spark, root, 1, df.schema.json(), keys, buckets, {b: 1 for b in _filled(spark, root, 1, range(buckets))})
    return 1


def read_version(spark: SparkSession, root: str, version: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
    """A version's rows, the latest by default, of all buckets or of ``only`` some."""
    known = versions(spark, root)
    if not known or version is not None and version not in known:
        raise ValueError(f"{root} has no version {version or ''}")
    entry = _manifest(spark, root, version or known[-1])
    schema = StructType.fromJson(json.loads(entry["schema"]))
    paths = [f"{root}/data/version={v}/bucket={b}" for b, v in sorted(entry["parts"].items()) if only is None or b in only]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def update_touched(spark: SparkSession, root: str, revise: Callable[[DataFrame], DataFrame]) -> list[int]:
    """Apply ``revise`` to the table and write the buckets in which it changes a row, as the next version; gives these buckets.

    ``revise`` changes values row by row, keeps the number of rows and every other column. It must not change a key:
    rows stay in their buckets. Where no row changes there is no new version. The first pass reads the table and collects the
    numbers of buckets only; the second reads and writes the touched buckets.
    """
    latest = versions(spark, root)[-1]
    entry = _manifest(spark, root, latest)
    keys, buckets = entry["keys"], entry["buckets"]
    table = read_version(spark, root, latest)
    columns = table.columns

    def revised(rows: DataFrame) -> DataFrame:
        found = revise(rows.withColumns({_BUCKET: _bucket(keys, buckets), _BEFORE: F.struct(*columns)}))
        missing = {*columns, _BUCKET, _BEFORE} ^ set(found.columns)
        if missing:
            raise ValueError(f"the update must keep the table's columns: {sorted(missing)}")
        return found

    changed = revised(table).filter(~F.col(_BEFORE).eqNullSafe(F.struct(*columns)))
    touched = sorted(r[0] for r in changed.select(_BUCKET).distinct().collect())
    if not touched:
        return []
    parts = {b: v for b, v in entry["parts"].items()} | {b: latest + 1 for b in touched}
    _write(revised(read_version(spark, root, latest, touched)).select(*columns, _BUCKET), root, latest + 1)
    _publish(spark, root, latest + 1, entry["schema"], keys, buckets, parts)
    return touched
