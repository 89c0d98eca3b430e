"""URL filter by path-template trees, in DataFrame operations only.

Rules ``host/path`` decide the URLs they fit: those of the host and its subdomains whose path starts with
the rule's; the longest rule wins (of equally long ones a block, then the smaller text). All other URLs go
by templates, which the decided ones label.

Every host has a tree of the paths' segments (empty ones are left out), and all hosts together have one
more. It grows level by level from distinct paths with their counts. Below a node a segment of digits,
or one seen fewer than ``SUPPORT`` times, is variable and becomes a wildcard of its form: ``{n}`` digits,
``{x}`` eight or more hexadecimal digits or hyphens, ``{s}`` others, with a file's extension kept. The
other branches are compared with all of them pooled, by chi-square tests (``CRITICAL``) of two
distributions: blocked, allowed and undecided URLs; and what follows (nothing, a digit, something else).
Branches that neither test tells from the pool merge into ``{~}``; a branch alone keeps its name. Segments
beyond ``LEVELS`` are not told apart (``**``).

A template's share of blocked among decided URLs is smoothed by that of the URL's template in the tree of all
hosts, and this by the share in all URLs, each with a weight of ``STRENGTH`` URLs. A URL is blocked when its
smoothed share reaches ``THRESHOLD``.

Null URLs, and those without ``://``, have an empty host and path and are judged by these. Repeated URLs
count and return as often as they occur, null ids too. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.sources.sinks import stored

ALLOW, BLOCK = "allow", "block"
LEVELS = 8
SUPPORT = 8
#: Of chi-square with two degrees of freedom, one in a thousand.
CRITICAL = 13.82
STRENGTH = 10.0
THRESHOLD = 0.7
MERGED = "{~}"
#: The tree of all hosts; a host's own is its name after a slash, which no host holds.
ALL = "*"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    url = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def ruled(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict; NULL where none fits. ``rules`` are (verdict, host/path)."""
    rule = verdict = F.lit(None).cast("string")
    for what, text in sorted(rules, key=lambda r: (len(r[1]), r[0] == BLOCK, tuple(-ord(c) for c in r[1]))):
        of, slash, rest = text.partition("/")
        fits = ((host == of) | host.endswith("." + of)) & path.startswith(slash + rest)
        rule, verdict = (F.when(fits, F.lit(new)).otherwise(old) for new, old in ((text, rule), (what, verdict)))
    return rule, verdict


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/", -1), lambda s: s != "")


def form(segment: Column) -> Column:
    """The wildcard of a variable segment."""
    extension = F.regexp_extract(segment, r"(\.[A-Za-z0-9]{1,5})$", 1)
    return F.when(segment.rlike(r"^[0-9]+$"), "{n}") \
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z0-9]{1,5}$"), F.concat(F.lit("{n}"), extension)) \
        .when(segment.rlike(r"^[0-9A-Fa-f-]{8,}$"), "{x}") \
        .otherwise(F.concat(F.lit("{s}"), extension))


def differs(own: Sequence[Column], n: Column, pool: Sequence[Column], total: Column) -> Column:
    """Whether a branch's counts are unlikely to be drawn from the pool's."""
    n, total = n.cast("double"), total.cast("double")

    def term(o: Column, p: Column) -> Column:
        gap = o * total - n * p
        return F.when(p > 0, gap * gap / (total * n * p)).otherwise(0.0)

    first, second, third = (term(o.cast("double"), p.cast("double")) for o, p in zip(own, pool))
    return first + second + third > CRITICAL


def grown(walk: DataFrame, level: int) -> DataFrame:
    """Paths one level further down their trees."""
    segment, following = F.get("segments", F.lit(level)), F.get("segments", F.lit(level + 1))
    branches = walk.filter(F.size("segments") > level).groupBy("tree", "node", segment.alias("segment")).agg(
        *[F.sum(c).alias(c) for c in ("n", "blocked", "allowed")],
        F.sum(F.when(following.isNull(), F.col("n")).otherwise(0)).alias("ending"),
        F.sum(F.when(following.rlike("^[0-9]"), F.col("n")).otherwise(0)).alias("numbered"))
    branches = stored(branches.filter((F.col("n") >= SUPPORT) & ~F.col("segment").rlike("^[0-9]+$")), "branches")
    counts = ("n", "blocked", "allowed", "ending", "numbered")
    pool = branches.groupBy("tree", "node").agg(*[F.sum(c).alias(f"all_{c}") for c in counts])
    n, total = F.col("n"), F.col("all_n")

    def apart(a: str, b: str) -> Column:
        parts = lambda at, of: (F.col(at + a), F.col(at + b), of - F.col(at + a) - F.col(at + b))
        return differs(parts("", n), n, parts("all_", total), total)

    stays = (n == total) | apart("blocked", "allowed") | apart("ending", "numbered")
    named = branches.join(pool, ["tree", "node"]).select(
        "tree", "node", "segment", F.when(stays, F.col("segment")).otherwise(MERGED).alias("name"))
    step = F.concat(F.col("node"), F.lit("/"), F.coalesce("name", form(F.col("segment"))))
    return walk.withColumn("segment", segment).join(named, ["tree", "node", "segment"], "left").select(
        "tree", "segments", "n", "blocked", "allowed", F.when(F.col("segment").isNull(), F.col("node")).otherwise(step).alias("node"))


def templates(urls: DataFrame) -> DataFrame:
    """``tree, segments, template, n, blocked, allowed`` of every path in its host's tree and in that of all hosts.

    ``urls`` have ``host``, ``segments`` and the ``verdict`` of a rule, or NULL.
    """
    trees = F.explode(F.array(F.concat(F.lit("/"), F.col("host")), F.lit(ALL)))
    walk = urls.withColumn("tree", trees).groupBy("tree", "segments").agg(
        F.count("*").alias("n"), F.count_if(F.col("verdict") == BLOCK).alias("blocked"), F.count_if(F.col("verdict") == ALLOW).alias("allowed"))
    walk = stored(walk.withColumn("node", F.lit("")), "walk")
    deepest = walk.agg(F.max(F.size("segments"))).first()[0] or 0
    for level in range(min(LEVELS, deepest)):
        walk = stored(grown(walk, level), "walk")
    rest = F.when(F.size("segments") > LEVELS, "/**").otherwise("")
    return walk.withColumn("template", F.concat("node", rest)).drop("node")


def smoothed(blocked: Column, allowed: Column, prior: Column) -> Column:
    return (blocked + STRENGTH * prior) / (blocked + allowed + STRENGTH)


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict, template, blocked_share`` of every page."""
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = ruled(rules, F.col("host"), F.col("path"))
    urls = stored(urls.withColumns({"segments": segments(F.col("path")), "rule": rule, "verdict": verdict}), "urls")

    paths = stored(templates(urls), "templates")
    counts = paths.groupBy("tree", "template").agg(F.sum("blocked").alias("blocked"), F.sum("allowed").alias("allowed"))
    counted = paths.select("tree", "segments", "template").join(counts, ["tree", "template"])
    everywhere = counted.filter(F.col("tree") == ALL)
    blocked, allowed = counts.filter(F.col("tree") == ALL).agg(F.sum("blocked"), F.sum("allowed")).first()
    base = F.lit(blocked / (blocked + allowed) if blocked else 0.0)
    everywhere = everywhere.select("segments", smoothed(F.col("blocked"), F.col("allowed"), base).alias("prior"))
    own = counted.filter(F.col("tree") != ALL).join(everywhere, "segments").select(
        F.substring("tree", F.lit(2), F.length("tree")).alias("host"), "segments", "template",
        smoothed(F.col("blocked"), F.col("allowed"), F.col("prior")).alias("blocked_share"))
    judged = F.coalesce("verdict", F.when(F.col("blocked_share") >= threshold, BLOCK).otherwise(ALLOW))
    return urls.join(own, ["host", "segments"]).select(
        "page_id", "host", "path", "rule", judged.alias("verdict"), "template", "blocked_share")


def sql(rules: Sequence[tuple[str, str]], threshold: float = THRESHOLD, pages: str = "pages") -> str:
    """The same in SQL, all levels written out."""
    def chosen(at: int) -> str:
        cases = sorted(rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1]))
        tests = []
        for rule in cases:
            of, slash, rest = rule[1].partition("/")
            tests.append(f"WHEN (host = '{of}' OR ends_with(host, '.{of}')) AND starts_with(path, '{slash}{rest}') THEN '{rule[at]}'")
        return f"CASE {' '.join(tests)} END"

    def apart(a: str, b: str) -> str:
        def term(o: str, p: str) -> str:
            o, p = f"CAST({o} AS DOUBLE)", f"CAST({p} AS DOUBLE)"
            return f"CASE WHEN {p} > 0 THEN ({o} * total - size * {p}) * ({o} * total - size * {p}) / (total * size * {p}) ELSE 0.0 END"
        return " + ".join(term(o, f"all_{o}") for o in (a, b)) + " + " + term(f"(n - {a} - {b})", f"(all_n - all_{a} - all_{b})")

    form_of = r"""CASE WHEN regexp_matches(segment, '^[0-9]+$') THEN '{n}'
        WHEN regexp_matches(segment, '^[0-9]+\.[A-Za-z0-9]{1,5}$') THEN '{n}' || regexp_extract(segment, '(\.[A-Za-z0-9]{1,5})$', 1)
        WHEN regexp_matches(segment, '^[0-9A-Fa-f-]{8,}$') THEN '{x}'
        ELSE '{s}' || regexp_extract(segment, '(\.[A-Za-z0-9]{1,5})$', 1) END"""
    levels = ""
    for k in range(LEVELS):
        levels += f"""
c{k} AS MATERIALIZED (
    SELECT tree, node, segments[{k + 1}] AS segment, sum(n) AS n, sum(blocked) AS blocked, sum(allowed) AS allowed,
           sum(CASE WHEN segments[{k + 2}] IS NULL THEN n ELSE 0 END) AS ending,
           sum(CASE WHEN regexp_matches(segments[{k + 2}], '^[0-9]') THEN n ELSE 0 END) AS numbered
    FROM w{k} WHERE len(segments) > {k} GROUP BY tree, node, segment
    HAVING sum(n) >= {SUPPORT} AND NOT regexp_full_match(segment, '[0-9]+')),
p{k} AS (
    SELECT *, CAST(n AS DOUBLE) AS size, CAST(all_n AS DOUBLE) AS total FROM c{k} JOIN (
        SELECT tree, node, sum(n) AS all_n, sum(blocked) AS all_blocked, sum(allowed) AS all_allowed,
               sum(ending) AS all_ending, sum(numbered) AS all_numbered FROM c{k} GROUP BY tree, node) USING (tree, node)),
n{k} AS (
    SELECT tree, node, segment, CASE WHEN n = all_n OR {apart('blocked', 'allowed')} > {CRITICAL}
           OR {apart('ending', 'numbered')} > {CRITICAL} THEN segment ELSE '{MERGED}' END AS name FROM p{k}),
w{k + 1} AS MATERIALIZED (
    SELECT w.tree, segments, n, blocked, allowed,
           CASE WHEN w.segment IS NULL THEN w.node ELSE w.node || '/' || coalesce(name, {form_of.replace('segment', 'w.segment')}) END AS node
    FROM (SELECT *, segments[{k + 1}] AS segment FROM w{k}) w
    LEFT JOIN n{k} ON n{k}.tree = w.tree AND n{k}.node = w.node AND n{k}.segment = w.segment),"""
    share = lambda prior: f"(blocked + {STRENGTH} * {prior}) / (blocked + allowed + {STRENGTH})"
    return f"""
WITH cut AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path FROM {pages}),
urls AS MATERIALIZED (
    SELECT *, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments, {chosen(1)} AS rule, {chosen(0)} AS decided FROM cut),
w0 AS MATERIALIZED (
    SELECT tree, segments, count(*) AS n, count(*) FILTER (decided = '{BLOCK}') AS blocked,
           count(*) FILTER (decided = '{ALLOW}') AS allowed, '' AS node
    FROM (SELECT *, unnest(['/' || host, '{ALL}']) AS tree FROM urls) GROUP BY tree, segments),{levels}
paths AS MATERIALIZED (
    SELECT *, node || CASE WHEN len(segments) > {LEVELS} THEN '/**' ELSE '' END AS template FROM w{LEVELS}),
counted AS MATERIALIZED (
    SELECT p.tree, segments, p.template, k.blocked, k.allowed FROM paths p JOIN (
        SELECT tree, template, CAST(sum(blocked) AS BIGINT) AS blocked, CAST(sum(allowed) AS BIGINT) AS allowed
        FROM paths GROUP BY tree, template) k ON p.tree = k.tree AND p.template = k.template),
base AS (
    SELECT coalesce(CAST(sum(blocked) AS DOUBLE) / nullif(sum(blocked) + sum(allowed), 0), 0.0) AS share FROM paths WHERE tree = '{ALL}'),
own AS (
    SELECT o.tree, o.segments, o.template, {share('prior').replace('blocked', 'o.blocked').replace('allowed', 'o.allowed')} AS blocked_share
    FROM counted o JOIN (
        SELECT segments, {share('share')} AS prior FROM counted, base WHERE tree = '{ALL}') e ON o.segments = e.segments
    WHERE o.tree <> '{ALL}')
SELECT page_id, host, path, rule,
       coalesce(decided, CASE WHEN blocked_share >= {threshold} THEN '{BLOCK}' ELSE '{ALLOW}' END) AS verdict, template, blocked_share
FROM urls JOIN own ON own.tree = '/' || urls.host AND own.segments = urls.segments
"""
