"""Exact duplicates by a tree merge of sorted digest runs, in DataFrame operations only.

A row is dealt to a node by its id, and a node's rows form a run sorted by digest. In each round the
nodes that differ in one digit exchange: every node sends each digest to the one whose digit is the
digest's, receives as many sorted runs as the digit has values, and merges them: Spark sorts what the runs
bring by node and digest, and an aggregation that walks the sorted rows keeps for a text the id that stays and
the number of rows, which leaves the node a sorted run again. After the last digit a digest is on one node
only. What a hot text sends shrinks to one row per node in the first round.

Texts are equal when SHA-256, length in bytes and XXH64 all agree; every merge compares all three. The
texts themselves are not moved.

Null texts are empty. A null id stays only where no other id is in the group; equal rows count each,
and one of them stays. An empty table gives no rows. Extra columns are ignored (``groups``) or kept
(``keep_one``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.llm.common import KEY, keep_keys, with_key
from rostrum.sources.sinks import stored

#: Binary digits that a round settles: a merge takes 2 ** ROUND_BITS runs.
ROUND_BITS = 3
TEXT = ["digest", "bytes", KEY[1]]


def merge_runs(runs: DataFrame, keep: str = "largest", node_bits: int | None = None, round_bits: int = ROUND_BITS) -> DataFrame:
    """One row per text, ``keep_id`` and ``group_size``, from ``doc_id, copies`` and ``TEXT``."""
    pick = F.max if keep == "largest" else F.min
    if node_bits is None:
        node_bits = max(1, (int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())
    nodes = 1 << node_bits
    runs = runs.select(
        *TEXT, F.col("doc_id").alias("keep_id"), F.col("copies").alias("group_size"),
        F.pmod(F.xxhash64("doc_id"), F.lit(nodes)).cast("int").alias("node"),
        F.pmod(F.xxhash64("digest"), F.lit(nodes)).cast("int").alias("home"))
    # a null id comes last either way; a struct is aggregated over sorted rows, never in a hash table
    known = F.col("keep_id").isNotNull() if keep == "largest" else F.col("keep_id").isNull()
    ranked = F.struct(known.alias("known"), F.col("keep_id").alias("keep_id"))
    for low in range(0, node_bits, round_bits):
        digit = ((1 << min(round_bits, node_bits - low)) - 1) << low
        target = F.col("node").bitwiseAND(F.lit(nodes - 1 - digit)).bitwiseOR(F.col("home").bitwiseAND(F.lit(digit)))
        sent = runs.withColumn("node", target).repartitionById(nodes, "node")
        merged = sent.groupBy("node", *TEXT, "home").agg(pick(ranked).alias("kept"), F.sum("group_size").alias("group_size"))
        runs = merged.select("node", *TEXT, "home", F.col("kept.keep_id").alias("keep_id"), "group_size")
    return runs.select(*TEXT, "keep_id", "group_size")


def _members(docs: DataFrame, keep: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    base = with_key(docs).select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("bytes"), *KEY)
    base = stored(base.groupBy("doc_id", *TEXT, KEY[0]).agg(F.count("*").alias("copies")), "digests")
    shared = merge_runs(base, keep).filter("group_size > 1")
    return base.join(shared, TEXT, "left").withColumns({
        "keep_id": F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")),
        "group_size": F.coalesce("group_size", F.lit(1).cast("bigint"))})


def groups(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """A row for each row of ``docs``: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    members = _members(docs, keep).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))))
    return members.select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("nth") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def keep_one(docs: DataFrame, keep: str = "largest") -> DataFrame:
    """The rows of ``docs`` that stay, with all columns."""
    return keep_keys(docs, _members(docs, keep).filter(F.col("doc_id").eqNullSafe(F.col("keep_id"))))
