"""The registered queries of this package, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostrum.llm import bfd_pack, hard_negatives, license_join, merkle, ordinal_quality, ppm_langid, simhash_pivot, sp_lattice, spelling, ss_pack, string_kernel, tree_dedup, url_templates
from rostrum.llm.common import ship

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@query
def op1_simhash_pivot(spark, sf):
    """Every document's fingerprint and component."""
    return simhash_pivot.classes(table(spark, sf, "documents"))


@query
def op2_merkle(spark, sf):
    """Every document's tree next to that of its edited text."""
    return merkle.fingerprints(table(spark, sf, "documents"))


@query
def op3_ppm_langid(spark, sf):
    """Every document's predicted language."""
    return ppm_langid.predict_languages(table(spark, sf, "documents").select("doc_id", "text", "lang")).drop("text", "lang")


@query
def op4_tree_dedup(spark, sf):
    """Every document with the one that stays of its equals."""
    return tree_dedup.groups(table(spark, sf, "documents"))


ORACLE["op4_tree_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""


@query
def op5_bfd_pack(spark, sf):
    """Packed id rows of all documents."""
    return bfd_pack.pack_ids(table(spark, sf, "documents"))


@query
def op6_ss_pack(spark, sf):
    """The place of every piece of all documents."""
    return ss_pack.pack(table(spark, sf, "documents"))


@query
def op7_license_join(spark, sf):
    """Every document's license phrases and templates."""
    return license_join.scan_documents(table(spark, sf, "documents"))


@query
def op8_string_kernel(spark, sf):
    """Every document's toxicity."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return string_kernel.score_documents(docs, table(spark, sf, "labels")).drop("text")


@query
def op9_sp_lattice(spark, sf):
    """Every document's piece ids, and whether they decode to its text."""
    found = sp_lattice.encode_documents(table(spark, sf, "documents"))
    same = sp_lattice.decode(F.col("ids")) == F.replace(F.coalesce("text", F.lit("")), F.lit(sp_lattice.SPACE), F.lit(" "))
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_ids"), "ids", same.alias("decodes"))


@query
def op10_ordinal_quality(spark, sf):
    """Every document's expected grade, tail probability and selection."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return ordinal_quality.rate_documents(docs, ordinal_quality.graded(table(spark, sf, "labels"))).drop("text")


@query
def op11_spelling(spark, sf):
    """Every word's near words, form and root."""
    return spelling.variants(table(spark, sf, "documents"))


ORACLE["op11_spelling"] = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda c, i:
        CASE WHEN (c & 1) = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b)) AS steps),
runs AS (
    SELECT run, id || ':' || run AS key, count(*) AS k FROM (
        SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (
    SELECT run, k, xor(4294967295, list_reduce(flatten(list_transform(string_split(key, ''), lambda c:
        CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [195, CAST(unicode(c) - 64 AS BIGINT)] END)), lambda h, byte:
        xor(steps[1 + (xor(h, byte) & 255)], h >> 8), 4294967295)) AS h
    FROM runs, crc),
words AS MATERIALIZED (
    SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, h % length(run)) || substring(run, h % length(run) + 2) ELSE run END AS word,
           CAST(sum(k) AS BIGINT) AS n
    FROM hashed GROUP BY word HAVING length(word) >= 7 AND sum(k) >= 2),
lacking AS MATERIALIZED (
    SELECT word, n, length(word) AS size, place, substring(word, 1, place - 1) || substring(word, place + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS place FROM words)),
pairs AS (
    SELECT a.word, b.word AS other, b.n FROM lacking a JOIN lacking b
        ON a.rest = b.rest AND a.place = b.place AND a.size = b.size AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM words a JOIN lacking b ON a.word = b.rest
    UNION SELECT b.word, a.word, a.n FROM words a JOIN lacking b ON a.word = b.rest),
forms AS MATERIALIZED (
    SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best.n >= 10 * w.n THEN best.other END AS form,
           CASE WHEN best.n >= 10 * w.n THEN best.n END AS form_n
    FROM words w LEFT JOIN (
        SELECT word, count(*) AS n_near, first({'n': n, 'other': other} ORDER BY n DESC, other) AS best FROM pairs GROUP BY word) USING (word)),
ends AS (
    SELECT word, word AS root, form AS further FROM forms
    UNION ALL SELECT ends.word, forms.word, forms.form FROM ends JOIN forms ON forms.word = ends.further)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN (SELECT word, root FROM ends WHERE further IS NULL) USING (word)
"""


@query
def op12_hard_negatives(spark, sf):
    """Every anchor's positives, each with its hardest negatives."""
    anchor = F.col("vec_id") % 50 == 0
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf, "embeddings"), "embedding", label, anchor)


ORACLE["op12_hard_negatives"] = """
WITH vectors AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
           CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM vectors a, vectors b
    WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""


#: The rules of this query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


@query
def op13_url_templates(spark, sf):
    """Every page's host, path, rule and verdict."""
    return url_templates.judge(table(spark, sf, "pages"), RULES)


ORACLE["op13_url_templates"] = url_templates.sql(RULES)
