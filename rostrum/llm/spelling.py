"""Spelling variants: words one edit apart, found by walking tries with joins.

The trie is a table: a row per way on from a node, which is a prefix that several words share, by a letter and
the ``STRIDE`` after it. A way that one word only goes carries the rest of that word. In sorted order
neighbours tell how far a word's path is shared, so only such nodes are made. The frontier holds states (word, position in
it, node). A state without an edit is on its own word's path, so these are known for all depths at once; they are joined to the
ways with the word's own letters behind another first one, which replaces the word's letter or is put before it. A state
with one edit follows its word's letters, one way a round; most come to a word's end in the first. What gets there is
a neighbour, and a longer one has its word as neighbour in turn. Two words one edit apart agree on a prefix, or on a suffix,
of half their length at least, so there are two tries, of the words and of the words reversed, and edits are
made in a word's second half, where few words share a node; a pair is found in one of the two.

The tries hold words of up to ``LONG`` code points, which bounds the rounds. Pairs with a
longer word are found through the digests of the word without each of its code points, in one join.

A null text has no words; a null id counts as empty in the hash. Repeated rows count as often as they
occur. Ties of the commonest near word go to the smallest in code-point order. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import pairwise
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.sources.sinks import stored

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST = 7
OCCURRENCES = 2
SLIP = 31
FACTOR = 10
LONG = 64
#: Letters of a way behind its first.
STRIDE = 4
#: A form occurs ``FACTOR`` times as often as its word, so 64-bit counts allow fewer steps than 2 ** this.
ROUNDS = 5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def letter(text: Column, at: Column) -> Column:
    """The code point at a place (from 0); empty beyond the end."""
    return F.substring(text, at + 1, F.lit(1))


def after(text: Column, at: Column) -> Column:
    return F.substring(text, at + 1, F.length(text))


def words(docs: DataFrame) -> DataFrame:
    """``word, n``: runs of letters, some with a letter left out by a hash of document and run; see the module's bounds."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(LETTERS + "{%d,}" % LEAST), F.lit(0))
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    run = F.col("run")
    lower = F.when(run.rlike("[A-Z]"), F.translate(run, _UPPER, _LOWER)).otherwise(run)
    rows = rows.select("id", lower.alias("run"))
    rows = rows.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substring("run", F.lit(1), at), after(run, at + 1))
    rows = rows.select(F.when(F.col("h") % SLIP == 0, slipped).otherwise(run).alias("word")).filter(F.length("word") >= LEAST)
    return rows.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= OCCURRENCES)


# ---- the tries -------------------------------------------------------------------------------

def sided(listed: DataFrame) -> DataFrame:
    """Every word forwards (``path`` begins with 0) and backwards (1), with the number of code points it shares with
    another path, ``most``, and the depth from which its nodes are held, ``half``; the mark counts as one."""
    both = F.explode(F.array(F.concat(F.lit("0"), "word"), F.concat(F.lit("1"), F.reverse("word"))))
    paths = listed.select(both.alias("path"), "n").repartitionByRange("path").sortWithinPartitions("path")

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """In order, a path shares most with the one before or after; the ends of a batch count as shared whole."""
        for batch in batches:
            alike = [len(commonprefix(two)) for two in pairwise(batch.column(0).to_pylist())]
            most = [max(x, y) for x, y in zip([LONG + 1, *alike], [*alike, LONG + 1])]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(most, pa.int32())], ["path", "n", "most"])

    paths = paths.mapInArrow(shared, "path string, n bigint, most int")
    most = F.least("most", F.length("path"))
    return paths.select("path", "n", most.alias("most"), half(F.length("path") - 1).alias("half")).filter("half <= most")


def half(size: Column) -> Column:
    """Of a path of ``size`` letters: from here on its letters are replaced; letters are inserted from the half of a path one longer.
    A place in a word's middle belongs to one of its two paths."""
    return F.floor((size + F.substring("path", F.lit(1), F.lit(1)).cast("int")) / 2).cast("int") + 1


def ways(paths: DataFrame, least: int) -> DataFrame:
    """``node, first, next``: the ways on from nodes of ``least`` code points or more that several words share, by a letter and
    the ``STRIDE`` after it, empty or fewer at a word's end. A way's ``tail`` is the rest of the only word that goes
    this way, and ``n`` its count, else NULL. ``key`` stands for node and next, by which ways are looked up."""
    path, at = F.col("path"), F.col("at")
    node, next_ = F.substring(path, F.lit(1), at), F.substring(path, at + 2, F.lit(STRIDE))
    rows = paths.filter(F.col("most") >= least).select("path", "n", F.explode(F.sequence(F.greatest("half", F.lit(least)), "most")).alias("at"))
    rows = rows.select(F.xxhash64(node, next_).alias("key"), "path", "n", "at").repartition("key", node, next_)
    rows = rows.select("key", node.alias("node"), letter(path, at).alias("first"), next_.alias("next"), after(path, at + 1 + STRIDE).alias("tail"), "n")
    held = rows.groupBy("key", "node", "next", "first").agg(F.count("*").alias("words"), F.min("tail").alias("tail"), F.min("n").alias("n"))
    only = F.col("words") == 1
    return held.select("key", "node", "next", "first", F.when(only, F.col("tail")).alias("tail"), F.when(only, F.col("n")).alias("n"))


def fresh(paths: DataFrame) -> DataFrame:
    """``path, own, at, on, node``: states without an edit at the nodes of each word's path, ``node`` NULL. ``on`` is the place from
    which the word goes on behind another letter, which replaces the one at ``at`` or is put before it."""
    size = F.length("path")

    def states(low: Column, high: Column, on: int) -> DataFrame:
        rows = paths.filter(low <= high).select("path", F.col("n").alias("own"), F.explode(F.sequence(low, high)).alias("at"))
        return rows.select("path", "own", "at", (F.col("at") + on).alias("on"), F.lit(None).cast("string").alias("node"))

    return states(F.col("half"), F.least("most", size - 1), 1).unionAll(states(half(size), F.col("most"), 0))


def steps(frontier: DataFrame, held: DataFrame) -> DataFrame:
    """What becomes of states: ``path, own, at, node`` with an edit and, at a word's end, the neighbour's remaining letters and count
    (``tail, n``), else NULL."""
    path, at, on, first = F.col("path"), F.col("at"), F.col("on"), F.col("first")
    node, next_ = F.coalesce("state", F.substring(path, F.lit(1), at)), F.substring(path, on + 1, F.lit(STRIDE))
    frontier = frontier.withColumnRenamed("node", "state").withColumn("key", F.xxhash64(node, next_))
    joined = frontier.join(held, (frontier["key"] == held["key"]) & (node == held["node"]) & (next_ == held["next"]))
    c = letter(path, at)
    # a letter put into a run of itself stands at the run's end on either path: the first path has it if it can
    size = F.length(path) - 1
    run = at - F.length(F.rtrim("node", first))
    late = (on > at) | path.startswith("0") | (letter(path, at - 1) != first) | (size - at + 1 + run < F.floor((size + 1) / 2))
    fits = F.when(F.col("state").isNull(), (first != "") & (first != c) & late).otherwise(first == c)
    joined = joined.filter(fits & (F.col("tail").isNull() | (F.col("tail") == after(path, on + STRIDE))))
    return joined.select("path", "own", (on + STRIDE).alias("at"), F.concat("node", "first", "next").alias("node"), "tail", "n")


def trie_neighbours(listed: DataFrame) -> list[DataFrame]:
    """``word, other, n`` of near pairs, ``n`` the other's count, each pair once each way; one table per round."""
    paths = stored(sided(listed), "paths")
    least = (LEAST // 2) + 1
    frontier, found = fresh(paths), []
    while True:
        made = stored(steps(frontier, ways(paths, least)), "states")
        found.append(made.filter("tail IS NOT NULL"))
        frontier = made.filter("tail IS NULL").select("path", "own", "at", (F.col("at") + 1).alias("on"), "node")
        if not frontier.take(1):
            break
        least += 1 + STRIDE
    bare = lambda c: F.when(F.col("path").startswith("0"), after(c, F.lit(1))).otherwise(F.reverse(after(c, F.lit(1))))
    # letters are only put in: a longer neighbour stands for the pair both ways
    there, back = F.struct("word", "other", "n"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("own").alias("n"))
    both = F.when(F.length("other") > F.length("word"), F.array(there, back)).otherwise(F.array(there))
    return [f.select(bare(F.col("path")).alias("word"), bare(F.concat("node", "tail")).alias("other"), "n", "own", "path")
            .select(F.explode(both).alias("pair")).select("pair.*") for f in found]


# ---- words beyond the tries ------------------------------------------------------------------

_PRIMES = ((1 << 61) - 1, (1 << 59) - 55)


def lacking(word: str) -> list[list[int]]:
    """By two moduli: the digest of a word and, after it, of the word without each code point in turn, each in one step."""
    out, codes = [], [ord(c) for c in word]
    for prime, base in zip(_PRIMES, (1_000_003, 16_777_619)):
        ahead, power = [0], [1]
        for code in codes:
            ahead.append((ahead[-1] * base + code) % prime)
            power.append(power[-1] * base % prime)
        whole, n = ahead[-1], len(codes)
        rest = [(whole - ahead[i + 1] * power[n - i - 1]) % prime for i in range(n)]
        out.append([whole, *[(ahead[i] * power[n - i - 1] + rest[i]) % prime for i in range(n)]])
    return out


def long_neighbours(listed: DataFrame) -> DataFrame:
    """``word, other, n`` of near pairs with a word of more than ``LONG`` code points."""
    key = F.xxhash64("word").alias("key")
    long = listed.filter(F.length("word") >= LONG).select(key, "word", "n")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, word in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                one, two = np.array(lacking(word), np.int64)
                places = np.arange(-1, len(word))
                columns = [np.full(len(one), key), np.full(len(one), len(word)), places, one, two]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "size", "place", "one", "two"])

    rows = long.select("key", "word").mapInArrow(digests, "key bigint, size bigint, place bigint, one bigint, two bigint")
    rows = stored(rows, "digests")
    a, b = (rows.select(*[F.col(c).alias(f"{c}_{x}") for c in rows.columns]) for x in "ab")
    same = (F.col("one_a") == F.col("one_b")) & (F.col("two_a") == F.col("two_b"))
    lacks = rows.filter("place >= 0").select(*[F.col(c).alias(f"{c}_b") for c in rows.columns])
    replaced = a.filter("place_a >= 0").join(lacks, same & (F.col("place_a") == F.col("place_b")) & (F.col("size_a") == F.col("size_b")) & (F.col("key_a") != F.col("key_b")))
    longer = a.filter("place_a = -1").join(lacks, same & (F.col("size_a") == F.col("size_b") - 1))
    pair = lambda df, x, y: df.select(F.col(f"key_{x}").alias("key"), F.col(f"key_{y}").alias("other_key"))
    pairs = pair(replaced, "a", "b").unionAll(pair(longer, "a", "b")).unionAll(pair(longer, "b", "a")).distinct()
    others = long.select(F.col("key").alias("other_key"), F.col("word").alias("other"), "n")
    found = pairs.join(long.select("key", "word"), "key").join(others, "other_key").select("word", "other", "n")
    return found.filter((F.length("word") > LONG) | (F.length("other") > LONG))


# ---- forms -----------------------------------------------------------------------------------

def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a form: where following forms ends. Steps double each round."""
    at = stored(forms.select("word", F.col("form").alias("root")), "roots")
    for _ in range(ROUNDS):
        next_ = at.select(F.col("word").alias("root"), F.col("root").alias("further"))
        at = stored(at.join(next_, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("went")), "roots")
        if not at.filter("went").take(1):
            break
        at = at.drop("went")
    return at.select("word", "root")


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the documents."""
    listed = stored(words(docs), "words")
    pairs = [*trie_neighbours(listed.filter(F.length("word") <= LONG)), long_neighbours(listed)]
    pairs = reduce(DataFrame.unionAll, pairs).repartition("word")
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("other").alias("form")))
    near = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    given = form_n >= FACTOR * F.col("n")
    rows = stored(listed.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(given, F.col("best.form")).alias("form"), F.when(given, form_n).alias("form_n")), "forms")
    ends = roots(rows.filter(F.col("form").isNotNull()))
    return rows.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
