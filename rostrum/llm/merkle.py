"""Document fingerprints: a Merkle tree over sections and paragraphs, in DataFrame operations only.

A paragraph is a line with its line break, a section a run of up to 16 paragraphs that ends at a blank
line at the latest. Each paragraph's SHA-256 is a leaf, a section's node hashes its paragraphs' digests,
and the root the sections'. Roots are equal for equal texts; where they differ, following the branches
that differ leads to the edited paragraphs. Under each paragraph's leaf lie hashes of its spans: every run
of five units, overlapping, so that an edit changes the spans around it only. A unit is a word; in words of more than
``WORD`` code points, and in those with signs of scripts that do not part words, each code point is one. The
likeness of two trees is the Dice coefficient of their spans, each as often as it occurs. A paragraph of fewer than five units is one
span; white space only counts where it parts units.

Null texts are empty: one section with one empty paragraph. Likeness is 1 for equal texts, else 0 where
either has no span. ``with_next`` orders by id (null first), then by text hash; equal rows follow each
other. An empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.llm.common import KEY, with_key

SECTION_PARAGRAPHS = 16
SPAN_UNITS = 5
WORD = 24
#: Thai to Lao, Myanmar, Khmer, CJK and kana, compatibility forms, ideographs of the higher planes.
UNPARTED = r"\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u2E80-\u9FFF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
UNIT = r"(?<!\S)[^\s%s]{1,%d}+(?!\S)|\S" % (UNPARTED, WORD)


def tree(text: Column) -> Column:
    """``struct<sections: array<struct<node, paragraphs: array<digest>, spans: array<array<int>>>>>``."""
    def cut(block: Column) -> Column:
        lines = F.split(block, r"(?<=\n)(?!\z)")
        steps = F.sequence(F.lit(1), F.size(lines), F.lit(SECTION_PARAGRAPHS))
        return F.transform(steps, lambda at: F.slice(lines, at, F.lit(SECTION_PARAGRAPHS)))

    sections = F.flatten(F.transform(F.split(text, r"(?<=\n\n)(?!\z)"), cut))
    def spans(units: Column) -> Column:
        firsts = F.slice(units, F.lit(1), F.greatest(F.size(units) - (SPAN_UNITS - 1), F.lit(1)))
        return F.transform(firsts, lambda u, i: F.hash(u, *[F.get(units, i + k) for k in range(1, SPAN_UNITS)]))

    units = lambda p: F.transform(F.regexp_extract_all(p, F.lit(UNIT), F.lit(0)), lambda u: F.hash(u))
    leaves = F.transform(sections, lambda s: F.struct(
        F.transform(s, lambda p: F.sha2(p, 256)).alias("paragraphs"), F.transform(F.transform(s, units), spans).alias("spans")))
    return F.struct(F.transform(leaves, lambda s: F.struct(
        F.sha2(F.array_join(s["paragraphs"], ""), 256).alias("node"), s["paragraphs"].alias("paragraphs"), s["spans"].alias("spans"))).alias("sections"))


def root(tree: Column) -> Column:
    """The fingerprint: 64 hexadecimal digits."""
    return F.sha2(F.array_join(F.transform(tree["sections"], lambda s: s["node"]), ""), 256)


def spans(tree: Column) -> Column:
    """The spans under all leaves, repeated ones numbered: the place in a run of equals is searched by halves."""
    every = F.sort_array(F.flatten(F.flatten(F.transform(tree["sections"], lambda s: s["spans"]))))
    steps = F.array(*[F.lit(1 << k) for k in range(23, -1, -1)])

    def numbered(every: Column) -> Column:
        def one(x: Column, i: Column) -> Column:
            nth = F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(every, i - n - step) == x, n + step).otherwise(n))
            return F.when(F.get(every, i - 1) == x, F.hash(x, nth)).otherwise(x)

        return F.transform(every, one)

    return F.get(F.transform(F.array(every), numbered), F.lit(0))


def dice(a: Column, b: Column) -> Column:
    """Dice coefficient of two arrays from ``spans``."""
    both = F.size(F.array_intersect(a, b))
    return F.when(both > 0, 2.0 * both / (F.size(a) + F.size(b))).otherwise(F.lit(0.0))


def likeness(a: Column, b: Column) -> Column:
    """Dice coefficient of two trees' spans."""
    return dice(spans(a), spans(b))


def differing(a: Column, b: Column) -> Column:
    """Places (from 0) where two arrays of digests differ, those in one only included."""
    longest = F.greatest(F.size(a), F.size(b))
    places = F.when(longest > 0, F.sequence(F.lit(0), longest - 1)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: ~F.get(a, i).eqNullSafe(F.get(b, i)))


def edits(a: Column, b: Column) -> Column:
    """``array<struct<section, paragraph>>``: the leaves under differing branches of two trees."""
    sections = differing(F.transform(a["sections"], lambda s: s["node"]), F.transform(b["sections"], lambda s: s["node"]))
    none = F.array().cast("array<string>")

    def below(i: Column) -> Column:
        own, other = (F.coalesce(F.get(t["sections"], i)["paragraphs"], none) for t in (a, b))
        return F.transform(differing(own, other), lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    return F.flatten(F.transform(sections, below))


def with_next(docs: DataFrame, partitions: int | None = None) -> DataFrame:
    """``doc_id, text`` and ``next_text`` of the next document by ascending id (after the last: the first).

    Ids are dealt to ranges by quantiles; the first documents of a range also visit the range before
    it, so each task sees its neighbours and the texts move once. ``docs`` is read twice, for the ranges
    and for the rows, and must give the same rows both times, as a table does; rows that do not fit the
    ranges, and rows that find none after them, are an error. All rows of one id go to one range, and to
    the one before as well where the range begins with that id.
    """
    docs = with_key(docs.select("doc_id", "text")).withColumn("text", F.coalesce("text", F.lit("")))
    partitions = partitions or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / partitions for i in range(1, partitions)] or [0.5]
    least, cuts = docs.agg(F.min(KEY[0]), F.percentile_approx(KEY[0], shares, 10 * max(1000, partitions))).first()
    bounds = sorted({least, *(cuts or [])}) if least is not None else [0]
    width = max(1, round(len(bounds) ** 0.5))
    every, coarse = F.lit(bounds), F.lit(bounds[::width])
    from_block = F.size(F.filter(coarse, lambda b: b <= F.col(KEY[0]))) - 1
    place = F.size(F.filter(F.slice(every, from_block * width + 1, F.lit(width)), lambda b: b <= F.col(KEY[0]))) + from_block * width - 1
    moved = F.raise_error(F.lit("the documents were not the same at the second reading"))
    place = F.when(F.col(KEY[0]) < bounds[0], moved).otherwise(place)
    before = F.pmod(F.col("range") - 1, F.lit(len(bounds)))
    visits = F.when(F.get(every, F.col("range")) == F.col(KEY[0]), F.array(
        F.struct(F.col("range"), F.lit(False).alias("guest")), F.struct(before.alias("range"), F.lit(True).alias("guest")))
    ).otherwise(F.array(F.struct(F.col("range"), F.lit(False).alias("guest"))))
    dealt = docs.withColumn("range", place).withColumn("visit", F.explode(visits)).select("doc_id", *KEY, "text", "visit.*")
    order = Window.partitionBy("range").orderBy("guest", *KEY)
    dealt = dealt.repartitionById(len(bounds), "range").withColumn("tree", tree(F.col("text")))
    following = F.lead(F.struct("text", "tree")).over(order)
    return dealt.withColumn("next", following).filter(~F.col("guest")).withColumn("next", F.coalesce("next", moved)).select("doc_id", "text", "tree", "next")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last quarter (in code points) replaced by as many of ``other``'s first."""
    n = F.char_length(text)
    k = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - k), F.substring(other, F.lit(1), k))


def fingerprints(docs: DataFrame) -> DataFrame:
    """Every document and its edited text side by side."""
    rows = with_next(docs).withColumn("edited", edited(F.col("text"), F.col("next.text")))
    rows = rows.withColumn("edited_tree", tree(F.col("edited")))
    own, changed, following = F.col("tree"), F.col("edited_tree"), F.col("next.tree")
    rows = rows.withColumns({"own_spans": spans(own), "edited_spans": spans(changed), "next_spans": spans(following)})
    rows = rows.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        root(own).alias("fingerprint"), root(changed).alias("edited_fingerprint"), dice(F.col("own_spans"), F.col("edited_spans")).alias("near_edited"),
        dice(F.col("own_spans"), F.col("next_spans")).alias("near_next"), root(following).alias("next_fingerprint"), edits(own, changed).alias("edits"))
    same = lambda other, near: F.when(F.col("fingerprint") == F.col(other), 1.0).otherwise(F.col(near))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        same("edited_fingerprint", "near_edited").alias("near_edited"), same("next_fingerprint", "near_next").alias("near_next"),
        F.size("edits").alias("n_edits"), F.get("edits", 0)["section"].alias("first_edit_section"),
        F.get("edits", 0)["paragraph"].alias("first_edit_paragraph"))
