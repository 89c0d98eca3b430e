"""SentencePiece encoding as relations: substrings join the piece table, edges group by word, a fold decides.

A text is cut into words (white space belongs to the word after it), and a word where no piece of the
vocabulary spans two neighbouring characters, which leaves the best segmentation as it is. Every
different part is encoded once: its substrings, none longer than the longest piece, join the table of
pieces; the edges that are found are grouped by part; and ``aggregate`` folds over them by their ends,
keeping for each end the best sum of scores and the ids that reach it
(equal sums: the longer last piece). Characters without a piece become their bytes' pieces. Each block of
documents then looks its parts up in the part of the result that it needs.

The vocabulary is read as a unigram model: scores are those in the file, added up; sums are doubles.
A part's work grows with the square of its length, so unbroken words of thousands of letters are slow.
Null and empty texts have no ids. Repeated rows are each encoded, null ids kept; an empty table gives no
rows; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from rostrum.llm.common import KEY, with_key

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
#: Documents of a block on average.
BLOCK_DOCS = 6144
#: Words that are cut, and texts whose ids are gathered, at a time.
WORDS_AT_ONCE, TEXTS_AT_ONCE = 65_536, 256
UNKNOWN_PENALTY = 10.0
WORDS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """What the vocabulary file says."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.texts = [model.id_to_piece(i) for i in range(size)]
        self.first_byte = self.texts.index("<0x00>")
        self.rows = [(self.texts[i], i, float(model.get_score(i))) for i in range(size)
                     if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.scores = [float(model.get_score(i)) for i in range(size)]
        self.longest = max(len(t) for t, _, _ in self.rows)
        assert self.longest < 256, "edges have eight bits for a piece's length"
        self.unknown = min(s for _, _, s in self.rows) - UNKNOWN_PENALTY
        self.spanned = {t[i:i + 2] for t, _, _ in self.rows for i in range(len(t) - 1)}

    def raw(self, i: int) -> bytes:
        """Bytes that an id stands for; control ids stand for none."""
        if self.first_byte <= i < self.first_byte + 256:
            return bytes([i - self.first_byte])
        return self.texts[i].encode() if i >= self.first_byte + 256 else b""


def words(text: str) -> list[str]:
    """The text's words, each without the first white space before it (the text's first word gets one)."""
    if not text:
        return []
    if text[0] == " " or "  " in text or SPACE in text:
        return [w[1:] for w in WORDS.findall(SPACE + text.replace(" ", SPACE))]
    return text.split(" ")


def numbered_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Different words, each text's words as numbers of these, and where each text's words end."""
    odd = pc.or_(pc.starts_with(texts, " "), pc.or_(pc.match_substring(texts, "  "), pc.or_(
        pc.match_substring(texts, SPACE), pc.equal(texts, ""))))
    if pc.any(odd).as_py():
        lists = pa.array([words(t) for t in texts.to_pylist()], pa.list_(pa.string()))
    else:
        lists = pc.split_pattern(texts, " ")
    encoded = lists.flatten().dictionary_encode()
    return encoded.dictionary, encoded.indices.to_numpy(zero_copy_only=False), np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))


class Cutter:
    """Cuts words between characters that no piece holds next to each other."""

    def __init__(self, spanned: set[str]):
        size = max((ord(c) for pair in spanned for c in pair), default=0) + 2  # the last stands for all beyond
        self.rows, self.columns = np.zeros(size, np.int32), np.zeros(size, np.int32)
        for numbers, side in ((self.rows, 0), (self.columns, 1)):
            used = sorted({ord(pair[side]) for pair in spanned})
            numbers[used] = np.arange(1, len(used) + 1)
        self.together = np.zeros((self.rows.max() + 1, self.columns.max() + 1), bool)
        for first, second in spanned:
            self.together[self.rows[ord(first)], self.columns[ord(second)]] = True

    def parts(self, some: list[str]) -> tuple[pa.Array, np.ndarray]:
        """Parts of all words in order, and for each word the number of parts up to its end."""
        joined = (SPACE + SPACE.join(some)) if some else ""
        codes = np.frombuffer(joined.encode("utf-32-le"), "<u4")
        known = np.minimum(codes, len(self.rows) - 1)
        ends = np.cumsum([len(w) + 1 for w in some], dtype=np.int64)
        cut = np.ones(len(codes) + 1, bool)
        cut[1:-1] = ~self.together[self.rows[known[:-1]], self.columns[known[1:]]]
        cut[ends] = True
        octets = 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)
        bounds = np.concatenate([[0], np.cumsum(octets)])[cut]
        parts = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), pa.py_buffer(joined.encode()))
        return parts, np.cumsum(cut)[ends] - 1

    def numbered_parts(self, some: list[str]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Different parts in order, each word's parts as numbers of these, and where each word's parts end."""
        found = [self.parts(some[at:at + WORDS_AT_ONCE]) for at in range(0, len(some), WORDS_AT_ONCE)]
        parts = pa.chunked_array([f[0] for f in found], pa.large_string()).combine_chunks().dictionary_encode()
        ends = np.cumsum(np.concatenate([[0], *(np.diff(f[1], prepend=0) for f in found)]))[1:]
        order = pc.sort_indices(parts.dictionary)
        place = np.empty(len(order), np.int32)
        place[order.to_numpy()] = np.arange(len(order))
        return parts.dictionary.take(order), place[parts.indices.to_numpy(zero_copy_only=False)], ends


def gathered(lists: tuple[np.ndarray, np.ndarray], numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbered lists one after another; lists are their values and their bounds."""
    values, bounds = lists
    sizes = np.diff(bounds)[numbers]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return values[np.repeat(bounds[:-1][numbers] - ends[:-1], sizes) + np.arange(ends[-1])], ends


def lattice(parts: DataFrame, pieces: Pieces) -> DataFrame:
    """``part, first, ids`` of different ``part``s with a value ``first`` each."""
    spark = parts.sparkSession
    table = spark.createDataFrame([r[:2] for r in pieces.rows], "piece string, id int")  # as large as the vocabulary file
    starts = parts.select("part", "first", F.explode(F.sequence(F.lit(0), F.char_length("part") - 1)).alias("a"))
    spans = starts.select("part", "first", "a", F.explode(F.sequence(
        F.col("a") + 1, F.least(F.col("a") + pieces.longest, F.char_length("part")))).alias("b"))
    edges = spans.withColumn("piece", F.substring("part", F.col("a") + 1, F.col("b") - F.col("a")))
    edges = edges.join(F.broadcast(table), "piece", "left").filter(F.col("id").isNotNull() | (F.col("b") - F.col("a") == 1))
    # an edge is one number, ordered by end and then by start: end, 255 - length, id + 1 (0: a character without a piece)
    edges = edges.select("part", "first", (
        F.shiftleft(F.col("b").cast("bigint"), 39) + F.shiftleft(255 - (F.col("b") - F.col("a")).cast("bigint"), 31)
        + F.coalesce(F.col("id") + 1, F.lit(0))).alias("edge"))
    grouped = edges.groupBy("part", "first").agg(F.sort_array(F.collect_list("edge")).alias("edges"))
    scores = F.split(F.lit(",".join(map(repr, [pieces.unknown, *pieces.scores]))), ",").cast("array<double>")  # folded to one constant
    reached = "array<struct<score:double,ids:array<int>>>"
    start = F.array(F.struct(F.lit(0.0).alias("score"), F.array().cast("array<int>").alias("ids"))).cast(reached)

    def octets(at: Column) -> Column:
        code = F.encode(F.substring("part", at, F.lit(1)), "utf-8")
        return F.transform(F.sequence(F.lit(1), F.octet_length(code)), lambda i: F.conv(
            F.hex(F.substring(code, i, F.lit(1))), 16, 10).cast("int") + pieces.first_byte)

    def step(state: Column, edge: Column) -> Column:
        """``state`` holds the best way to each end so far."""
        end = F.shiftright(edge, 39).cast("int")
        piece = edge.bitwiseAND((1 << 31) - 1).cast("int")
        before = F.get(state, end - 255 + F.shiftright(edge, 31).bitwiseAND(255).cast("int"))
        score = before["score"] + F.get(scores, piece)
        way = F.array(F.struct(score.alias("score"), F.concat(
            before["ids"], F.when(piece > 0, F.array(piece - 1)).otherwise(octets(end))).alias("ids")))
        return (F.when(F.size(state) == end, F.concat(state, way))
                .when(score > F.get(state, end)["score"], F.concat(F.slice(state, F.lit(1), end), way))
                .otherwise(state))

    return grouped.select("part", "first", F.aggregate("edges", start, step, lambda s: F.element_at(s, -1)["ids"]).alias("ids"))


@F.arrow_udf(BinaryType())
def zipped(texts: pa.Array) -> pa.Array:
    """Texts as they are dealt to blocks: two thirds of what the shuffle's own compression leaves."""
    zip_one = zstandard.ZstdCompressor().compress
    return pa.array([zip_one(t.as_buffer()) for t in texts], pa.binary())


def unzipped(texts: pa.Array | pa.ChunkedArray) -> pa.Array:
    unzip = zstandard.ZstdDecompressor().decompress
    return pa.array([unzip(t.as_buffer()) for t in texts], pa.binary()).cast(pa.string())


def encode_documents(docs: DataFrame, path: str | None = None, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``doc_id, text, ids`` of every document."""
    pieces = Pieces(path or public_tokenizers.path(VOCABULARY))
    cutter = Cutter(pieces.spanned)
    blocks = -(-docs.count() // block_docs) or 1
    dealt = with_key(docs.select("doc_id", "text")).select(
        "doc_id", zipped(F.coalesce("text", F.lit(""))).alias("text"), F.pmod(F.xxhash64(*KEY), F.lit(blocks)).cast("int").alias("block"))
    dealt = dealt.repartition("block")

    def different(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's different parts, numbered in their order."""
        def out(block: int, own: set[str]) -> Iterator[pa.RecordBatch]:
            parts = cutter.numbered_parts(list(own))[0].cast(pa.string())
            for at in range(0, len(parts), 50_000):
                some = parts[at:at + 50_000]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(some), block, np.int32)), pa.array(np.arange(at, at + len(some), dtype=np.int32)), some],
                    ["block", "number", "part"])

        current, own = -1, set()
        for batch in batches:
            blocks = batch.column("block").to_numpy()
            starts = np.flatnonzero(np.diff(blocks, prepend=-1))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(blocks)]):
                if blocks[a] != current:
                    yield from out(current, own)
                    current, own = int(blocks[a]), set()
                    pa.default_memory_pool().release_unused()
                own.update(numbered_words(unzipped(batch.column("text")[a:b]))[0].to_pylist())
        yield from out(current, own)

    def looked_up(texts: pa.Table, found: pa.Table) -> pa.Table:
        """The block's parts again, each with the ids that came with its number."""
        text = unzipped(texts["text"])
        own, word_of, text_ends = numbered_words(text)
        _, part_of, word_ends = cutter.numbered_parts(own.to_pylist())
        ids = found["ids"].combine_chunks()
        by_row = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy().astype(np.int64)
        row_of = np.empty(len(found), np.int64)
        row_of[found["number"].to_numpy()] = np.arange(len(found))
        part_ids, part_ends = gathered(by_row, row_of[part_of])
        by_word = part_ids, part_ends[np.concatenate([[0], word_ends])]
        bounds, lists = np.concatenate([[0], text_ends]), []
        for at in range(0, len(text), TEXTS_AT_ONCE):
            own_bounds = bounds[at:at + TEXTS_AT_ONCE + 1]
            all_ids, ends = gathered(by_word, word_of[own_bounds[0]:own_bounds[-1]])
            lists.append(pa.ListArray.from_arrays(pa.array(ends[own_bounds - own_bounds[0]], pa.int32()), pa.array(all_ids, pa.int32())))
        pa.default_memory_pool().release_unused()
        return pa.table({"doc_id": texts["doc_id"], "text": text, "ids": pa.chunked_array(lists, pa.list_(pa.int32()))})

    parts = dealt.sortWithinPartitions("block").mapInArrow(different, "block int, number int, part string")
    parts = parts.select("part", (F.shiftleft(F.col("block").cast("bigint"), 32) + F.col("number")).alias("home"))
    parts = parts.filter("home is not null").repartition("part")
    # the first home goes along (no home is before it), so that both sides of the join need the same columns
    # and read one exchange; sorted parts leave the edges in the order in which they are grouped
    once = parts.groupBy("part").agg(F.min("home").alias("first")).sortWithinPartitions("part")
    ids = lattice(once, pieces)
    found = parts.join(ids, "part").filter("home >= first").select(
        F.shiftright("home", 32).cast("int").alias("block"), F.col("home").bitwiseAND((1 << 32) - 1).cast("int").alias("number"),
        F.col("ids").cast("array<smallint>" if len(pieces.texts) <= 1 << 15 else "array<int>").alias("ids"))
    return dealt.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(looked_up, "doc_id bigint, text string, ids array<int>")


def decode(ids: Column, path: str | None = None) -> Column:
    """The text of a list of ids."""
    pieces = Pieces(path or public_tokenizers.path(VOCABULARY))
    codes = F.split(F.lit(",".join(pieces.raw(i).hex() for i in range(len(pieces.texts)))), ",")  # folded to one constant
    text = F.decode(F.unhex(F.array_join(F.transform(ids, lambda i: F.get(codes, i)), "")), "utf-8")
    return F.substring(F.replace(text, F.lit(SPACE), F.lit(" ")), 2, (1 << 31) - 1)
