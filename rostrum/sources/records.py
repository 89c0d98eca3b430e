"""CSV records of files that are split, with line breaks in quoted values.

A file is read in lines by as many tasks as it has blocks. A line with an odd number of quotes opens or
closes a quoted value, so the sum of quotes before a line says whether it continues a record: within the block
by a running sum, before the block by the sums of earlier blocks, of which there is one number each. These are
counted first and broadcast; then every block's lines are put together where they are read, in their order, so no line
is shuffled or sorted. Of records that lie in several blocks, each block has two pieces at most, its first
lines and its last record, and only these meet those of other blocks.

Quotes within a value are doubled, and stand in quoted values only, as landed feeds write them; a single quote
elsewhere would be taken for the start of a value. Lines end with LF or CRLF, as the file's first one does; in
files of the second kind a CRLF within a value becomes LF. Empty lines between records are skipped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rostrum.session import ship

_BLOCK = ["file", "block"]
_PIECE = "file string, block bigint, nth int, first boolean, crlf boolean, record string"


def _in_order():
    pieces = F.sort_array(F.collect_list(F.struct("block", "nth", "record")))
    return F.array_join(F.transform(pieces, lambda p: p["record"]), "\n")


def _runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The lines of each block."""
    blocks, files = np.asarray(batch["block"]), np.asarray(batch["file"].dictionary_encode().indices)
    cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(files) != 0)) + 1
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
        yield batch.slice(start, stop - start)


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """Records from their lines; ``starts`` are their first lines, and the end."""
    return pc.binary_join(pa.LargeListArray.from_arrays(pa.array(starts, pa.int64()), lines), "\n").cast(lines.type)


def _cutter(whole: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cuts lines, block by block and in their order, into records. Gives the ``whole`` ones, or else the pieces of
    the others: a block's lines before its first record (``nth`` 0) and its last record (1) if that goes on."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None  # file, number, CRLF
        opened, begun, held, nth, first = 0, False, [], 0, False

        def rows(records: pa.Array, nth: int, first: bool) -> pa.RecordBatch:
            n = len(records)
            firsts = np.zeros(n, bool)
            firsts[:1] = first
            text, number, crlf = block
            return pa.RecordBatch.from_arrays(
                [pa.repeat(text, n), pa.repeat(number, n), pa.array(np.full(n, nth, np.int32)), pa.array(firsts), pa.repeat(crlf, n), records],
                ["file", "block", "nth", "first", "crlf", "record"])

        def held_rows() -> pa.RecordBatch:
            lines = pa.concat_arrays(held)
            return rows(_joined(lines, np.array([0, len(lines)])), nth, first)

        for run in (run for batch in batches if batch.num_rows for run in _runs(batch)):
            at = (run["file"][0], run["block"][0], run["crlf"][0])
            if block is None or at[:2] != block[:2]:
                if held and not whole:
                    yield held_rows()
                block, opened, begun, held, nth, first = at, run["opened"][0].as_py() % 2, False, [], 0, False
            lines, odd = run["line"], np.asarray(run["odd"])
            after = (opened + np.cumsum(odd)) % 2
            starts = np.flatnonzero((after + odd) % 2 == 0)
            lead = starts[0] if len(starts) else len(lines)
            if lead:
                held.append(lines.slice(0, lead))
            if held and (len(starts) or after[-1] == 0):
                if whole == (nth == 1):
                    yield held_rows()
                held = []
            opened = int(after[-1])
            if not len(starts):
                continue
            first = not begun and block[1].as_py() == 0
            ends = starts if opened else np.append(starts, len(lines))
            if whole and len(ends) > 1:
                yield rows(_joined(lines, ends), 1, first)
            first, begun = first and len(ends) == 1, True
            if opened:
                held, nth = [lines.slice(starts[-1])], 1
        if held and not whole:
            yield held_rows()

    return cut


def read_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``file, record``: every record of the files as one text; ``header`` leaves out each file's first one."""
    ship(spark)
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))
    lines = lines.withColumn("odd", (F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))) % 2)
    lines = lines.withColumn("odd", F.col("odd").cast("byte"))

    # one number per block
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy(*_BLOCK).agg(F.sum("odd").alias("odds"), F.min_by(F.col("line").endswith("\r"), "at").alias("crlf"))
    opened = blocks.select(*_BLOCK, F.coalesce(F.sum("odds").over(earlier), F.lit(0)).alias("opened"),
                           F.first("crlf").over(Window.partitionBy("file").orderBy("block")).alias("crlf"))

    # each block's lines, in the task that reads the block
    lines = lines.drop("at").join(F.broadcast(opened), _BLOCK)
    columns = ["file", "first", "record", "crlf"]
    whole = lines.mapInArrow(_cutter(True), _PIECE).select(*columns)

    # what blocks share: their first lines and their last records, two pieces a block at most
    so_far = Window.partitionBy("file").orderBy("block", "nth")
    parts = lines.mapInArrow(_cutter(False), _PIECE).withColumn("opener", F.sum("nth").over(so_far))
    joined = parts.groupBy("file", "opener").agg(F.max("first").alias("first"), _in_order().alias("record"), F.first("crlf").alias("crlf"))
    records = whole.unionByName(joined.select(*columns))
    plain = F.regexp_replace(F.replace("record", F.lit("\r\n"), F.lit("\n")), r"\r$", "")
    records = records.withColumn("record", F.when(F.col("crlf"), plain).otherwise(F.col("record")))
    if header:
        records = records.filter(~F.col("first"))
    return records.filter(F.trim("record") != "").select("file", "record")
