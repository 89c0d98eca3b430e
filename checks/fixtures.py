"""Feeds, dimensions and documents derived from the driver tables.

The tables hold no legislators, so every feed is a projection of a whole table: no join, no
grouping, one derived row (or document) per row. The SQL is valid in Spark and in DuckDB; table
names stand in braces. ``DOCUMENTS`` is Spark only, since the documents exist to be parsed back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RUN_DATE = "2018-10-24"

FEEDS: dict[str, str] = {
    "members": """
SELECT c_custkey AS member_id,
  CASE c_custkey % 8 WHEN 0 THEN 'Joe' WHEN 1 THEN 'Carol M.' WHEN 2 THEN 'William "Bill" H.'
    WHEN 3 THEN 'J. R. Q.' WHEN 4 THEN 'Hank (Hal)' WHEN 5 THEN 'None' WHEN 6 THEN 'Al, Jr.'
    ELSE 'Kim' END AS first_name,
  'Member' || CAST(c_custkey % 400 AS STRING) ||
    CASE c_custkey % 5 WHEN 0 THEN ' IV' WHEN 1 THEN ' Sr.' WHEN 2 THEN ' Jr' WHEN 3 THEN ' X. III'
    ELSE '' END AS last_name,
  CASE c_custkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'R' ELSE 'I' END AS party,
  'NATION_' || CAST(c_nationkey AS STRING) AS state,
  c_mktsegment AS district
FROM {customer}""",

    "foreign_names": """
SELECT c_custkey AS member_id, CASE c_custkey % 8 WHEN 0 THEN 'Щукин Илья' WHEN 1 THEN 'Παπαδόπουλος' WHEN 2 THEN 'שלום'
    WHEN 3 THEN 'خالد بن شاكر' WHEN 4 THEN 'きょうとっしょ カッター' WHEN 5 THEN '한국 김' WHEN 6 THEN 'Łukasz Ægir' ELSE 'Плохой Ёж 中' END ||
  ' ' || CAST(c_custkey AS STRING) AS name
FROM {customer}""",

    "votes": """
SELECT l_orderkey * 10 + l_linenumber AS vote_id,
  'HR' || CAST(l_partkey AS STRING) AS bill_id,
  CASE WHEN l_linenumber = 1 THEN 'None' ELSE 'SAMDT' || CAST(l_linenumber AS STRING) END AS amdt_id,
  CASE l_orderkey % 6 WHEN 0 THEN 'Joe' WHEN 1 THEN 'Carol M.' WHEN 2 THEN 'None'
    WHEN 3 THEN 'Kim "K" Q.' ELSE '' END AS first_name,
  'Member' || CAST(l_suppkey AS STRING) || CASE WHEN l_linenumber < 3 THEN ' Jr.' ELSE '' END AS last_name,
  CASE l_linestatus WHEN 'F' THEN 'D' ELSE 'R' END AS party,
  'S' || CAST(l_suppkey % 25 AS STRING) AS state,
  CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '0' ELSE 'None' END AS vote_cast,
  CAST(CAST(l_shipdate AS DATE) AS STRING) AS vote_date,
  'HR' AS chamber, 'US' AS chamber_state
FROM {lineitem}""",

    "house": """
SELECT 'F' || CAST(l_partkey AS STRING) AS first_name,
  'Member' || CAST(l_suppkey AS STRING) || CASE WHEN l_linenumber < 3 THEN ' Jr.' ELSE '' END ||
    CASE WHEN l_returnflag = 'R' THEN ' Elsewhere' ELSE '' END AS last_name,
  CASE l_linestatus WHEN 'F' THEN 'D' ELSE 'R' END AS party,
  'S' || CAST(l_suppkey % 25 AS STRING) AS state,
  'D' || CAST(l_linenumber AS STRING) AS district,
  CAST(l_shipdate AS DATE) AS date
FROM {lineitem}""",

    "bills": """
SELECT o_orderkey AS bill_key,
  'HR' || CAST(o_orderkey AS STRING) AS bill_id, 'None' AS amdt_id,
  o_orderpriority || ' Act' AS bill_title,
  CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE 'Summary, of ' || o_orderpriority END AS bill_summary,
  CASE o_custkey % 5 WHEN 0 THEN 'Caroline M.' WHEN 1 THEN 'Joe' WHEN 2 THEN 'Al'
    WHEN 3 THEN 'William "Bill" H.' END AS sponsor_fn,
  CASE o_custkey % 7 WHEN 0 THEN 'Brantley IV' WHEN 1 THEN 'O Jr, X'
    ELSE 'Member' || CAST(o_custkey AS STRING) END AS sponsor_ln,
  CASE o_custkey % 11 WHEN 0 THEN 'D' WHEN 1 THEN 'I' ELSE 'R' END AS sponsor_party,
  CASE WHEN o_custkey % 13 <> 0 THEN 'S' || CAST(o_custkey % 25 AS STRING) END AS sponsor_state,
  'https://www.congress.gov/bill/115/hr/' || CAST(o_orderkey AS STRING) AS bill_url
FROM {orders}""",

    "cosponsors": """
SELECT o_orderkey AS bill_key,
  'HR' || CAST(o_custkey AS STRING) AS bill_id,
  CASE WHEN o_orderstatus = 'P' THEN 'None' ELSE 'SAMDT' || CAST(o_custkey AS STRING) END AS amdt_id,
  CASE o_custkey % 4 WHEN 0 THEN 'Caroline M.' WHEN 1 THEN 'Joe' WHEN 2 THEN 'Hank (Hal)' END AS cosponsor_fn,
  CASE WHEN o_custkey % 9 <> 0 THEN 'Brantley ' || CAST(o_custkey AS STRING) || ' IV' END AS cosponsor_ln,
  CASE WHEN o_custkey % 5 <> 0 THEN 'R' END AS cosponsor_party,
  CASE WHEN o_custkey % 13 <> 0 THEN 'S' || CAST(o_custkey % 25 AS STRING) END AS cosponsor_state
FROM {orders}""",

    "raw_bills": """
SELECT p_partkey AS bill_key,
  CASE WHEN p_partkey % 4 = 0 THEN 'S.Amdt.' || CAST(p_partkey AS STRING) || ' to H.R.' || CAST(p_size AS STRING)
    WHEN p_partkey % 11 = 0 THEN 'No number here'
    ELSE 'H.R. ' || CAST(p_partkey AS STRING) || ' - ' || p_name || ' Act - ' || p_type END AS raw_title,
  CASE p_partkey % 3 WHEN 0 THEN 'Rep. Last' || CAST(p_size AS STRING) || ', Jo A. [D-TX-5]'
    WHEN 1 THEN 'Sen. Van Last, Al [R-MA]' ELSE 'Rep. Nobody' END AS raw_sponsor,
  p_type AS subtitle
FROM {part}""",

    "nicknames": """
SELECT CAST(column_a AS STRING) AS nickname, CAST(column_b AS STRING) AS full_name
FROM (VALUES ('Joe', 'Joseph'), ('Carol', 'Caroline'), ('Al', 'Alan'), ('Al', 'Albert'))
  AS t(column_a, column_b)""",

    "states": """
SELECT n_name || CASE WHEN n_nationkey = 7 THEN ' (old)' ELSE '' END AS state,
  'S' || CAST(n_nationkey AS STRING) AS initials FROM {nation}
UNION ALL SELECT n_name AS state, 'DUP' AS initials FROM {nation} WHERE n_nationkey = 3""",

    # stored under the bare names and initials that cleaning arrives at
    "politicians": """
SELECT c_custkey AS id, CASE c_custkey % 8 WHEN 0 THEN 'Joseph' WHEN 7 THEN 'Kim' ELSE 'Al' END AS first_name,
  'Member' || CAST(c_custkey % 400 AS STRING) ||
    CASE WHEN c_mktsegment = 'MACHINERY' THEN ' Elsewhere' ELSE '' END AS last_name,
  CASE c_custkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'R' ELSE 'I' END AS party,
  'S' || CAST(c_nationkey AS STRING) AS state,
  CAST(NULL AS STRING) AS suffix,
  CASE c_custkey % 8 WHEN 0 THEN 'Joe' END AS nickname
FROM {customer}""",
}

# One document per row. ``seq`` repeats entries within a document.
DOCUMENTS: dict[str, str] = {
    "senate_roster": """
SELECT o_orderkey AS doc_id, 'https://www.senate.gov/' || o_orderkey AS url,
  CASE WHEN o_orderstatus = 'P' AND o_custkey % 7 = 0 THEN '<contact_information><member>'
  ELSE '<?xml version="1.0"?>\\n<contact_information>' || array_join(transform(
    sequence(1, 1 + CAST(o_orderkey % 3 AS INT)), i ->
    '\\n<member><member_full>x</member_full><last_name>Member' || o_custkey || '&amp;' || i ||
    '</last_name><first_name>Ann ' || i || '</first_name><party>D</party><state>S' ||
    (o_custkey % 25) || '</state></member>'), '') || '</contact_information>' END AS body
FROM {orders}""",

    "senate_votes": """
SELECT o_orderkey AS doc_id, 'https://www.senate.gov/legislative/' || o_orderkey AS url,
  '<roll_call_vote><vote_date>' || date_format(o_orderdate, 'MMMM d, yyyy') || ',  02:30 PM</vote_date>' ||
  CASE WHEN o_custkey % 3 = 0 THEN '<document><document_name/></document><amendment><amendment_number>S.Amdt. '
      || o_custkey || '</amendment_number><amendment_to_document_number>s. ' || o_orderkey ||
      '</amendment_to_document_number></amendment>'
    WHEN o_custkey % 50 = 1 THEN ''
    ELSE '<document><document_name>h.r. ' || o_orderkey || '</document_name></document>' ||
      '<amendment><amendment_number/></amendment>' END || '<members>' ||
  array_join(transform(sequence(1, 1 + CAST(o_orderkey % 3 AS INT)), i ->
    '<member><member_full>x</member_full><last_name>Member' || o_custkey || '</last_name><first_name>Ann' || i ||
    '</first_name><party>R</party><state>S' || (o_custkey % 25) || '</state><vote_cast>' ||
    CASE (o_orderkey + i) % 3 WHEN 0 THEN 'Yea' WHEN 1 THEN 'Nay' ELSE 'Not Voting' END ||
    '</vote_cast></member>'), '') || '</members></roll_call_vote>' AS body
FROM {orders}""",

    "house_votes": """
SELECT o_orderkey AS doc_id,
  'http://clerk.house.gov/cgi-bin/vote.asp?year=1998&rollnumber=' || o_orderkey AS url,
  '<rollcall-vote><vote-metadata><legis-num>H R ' || o_custkey || '</legis-num>' ||
  CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE '<amendment-num>' || (o_orderkey % 7) || '</amendment-num>' END ||
  '<action-date>' || date_format(o_orderdate, 'd-MMM-yyyy') || '</action-date></vote-metadata><vote-data>' ||
  array_join(transform(sequence(1, 1 + CAST(o_orderkey % 3 AS INT)), i ->
    '<recorded-vote><legislator name-id="A1" unaccented-name="Member' || o_custkey || '" party="R" state="S' || i ||
    '" role="legislator">Membér</legislator><vote>' ||
    CASE (o_orderkey + i) % 5 WHEN 0 THEN 'Aye' WHEN 1 THEN 'No' WHEN 2 THEN 'Yea' WHEN 3 THEN 'Nay' ELSE 'Present' END ||
    '</vote></recorded-vote>'), '') || '</vote-data></rollcall-vote>' AS body
FROM {orders}""",

    # a page of the roll index: header, one row of the order itself
    "roll_index": """
SELECT o_orderkey AS doc_id, 'http://clerk.house.gov/evs/1998/ROLL_' || o_orderkey || '.asp' AS url,
  year(o_orderdate) AS year,
  '<table border="0"><tr><th>Roll</th><th>Date</th></tr><tr><td align="center">' ||
  '<a href="http://clerk.house.gov/cgi-bin/vote.asp?year=1998&amp;rollnumber=' || o_orderkey || '">' || o_orderkey ||
  '</a></td>\\n<td><font face="Arial">' || date_format(o_orderdate, 'd-MMM') ||
  '</font></td>\\n<td><a href="https://www.congress.gov/bill/115/hr/' || o_custkey || '">H R ' || o_custkey ||
  '</a></td></tr></table>' AS body
FROM {orders}""",

    "vote_menu": """
SELECT o_orderkey AS doc_id, 'https://www.senate.gov/legislative/LIS/roll_call_lists/vote_menu_115_2.htm' AS url,
  year(o_orderdate) AS year,
  '<table><tr><th>Vote</th></tr><tr><td><a href="/legislative/LIS/roll_call_lists/roll_call_vote_cfm.cfm?congress=115&amp;vote=' ||
  o_orderkey || '">' || o_orderkey || '</a></td><td>x</td><td>' || date_format(o_orderdate, 'MMM') || '&nbsp;' ||
  date_format(o_orderdate, 'dd') || '</td></tr></table>' AS body
FROM {orders}""",

    "house_roster": """
SELECT c_custkey AS doc_id, 'https://www.house.gov/representatives' AS url,
  CASE WHEN c_custkey % 40 = 9 THEN '<p>moved</p>' ELSE
  '<h1>x</h1><table class="table"><caption id="by-name">A</caption><tbody><tr><td>no</td><td><a>No, No</a></td><td>X</td></tr></tbody></table>' ||
  '\\n<table class="table">\\n<caption id="state-' || c_nationkey || '">\\n NATION_' || c_nationkey || ' </caption>' ||
  '<thead><tr><th>District</th></tr></thead><tbody>' || array_join(transform(
    sequence(1, 1 + CAST(c_custkey % 3 AS INT)), i ->
    '<tr><td> ' || i || 'st </td><td> <a href="https://m' || c_custkey || '.house.gov/">' ||
    CASE WHEN i = 2 THEN 'Member' || c_custkey || ' Al' ELSE 'O&#39;Member' || c_custkey || ', Kim, Dr.' END ||
    '</a> </td><td> ' || CASE c_custkey % 3 WHEN 0 THEN 'D' WHEN 1 THEN 'R' ELSE 'I' END || ' </td><td>1 LHOB</td></tr>'),
    '\\n') || '</tbody></table>' END AS body
FROM {customer}""",

    "bill_search": """
SELECT p_partkey AS doc_id, 'https://www.congress.gov/search?q=x' AS url,
  '<ol><li class="expanded"><span class="result-heading"><a href="https://www.congress.gov/bill/115th-congress/house-bill/' ||
  p_partkey || '?q=%7B%7D&amp;r=1">H.R.' || p_partkey || '</a></span><span class="result-item"><strong>Sponsor:</strong> <a href="/member/x">Rep. X</a>' ||
  CASE WHEN p_size % 2 = 0 THEN ' (Introduced ' || lpad(CAST(p_size % 12 + 1 AS STRING), 2, '0') || '/03/2018) ' ELSE ' (Submitted later) ' END ||
  '</span></li></ol><div class="pagination">' ||
  CASE WHEN p_size % 3 = 0 THEN '<a class="next" href="/search?q=x&amp;page=2">Next</a>' ELSE '' END || '</div>' AS body
FROM {part}""",

    "bill_pages": """
SELECT bill_key AS doc_id, 'https://www.congress.gov/bill/115th-congress/house-bill/' || bill_key AS url,
  '<h1 class="legDetail">' || raw_title || '<span>115th Congress (2017-2018)</span></h1>' ||
  '<table class="standard01"><tr><th>Sponsor:</th><td><a href="/member/x">' || raw_sponsor || '</a>' || subtitle ||
  ' (Introduced 01/03/2018)</td></tr></table><a href="/bill/115th-congress/house-bill/' || bill_key ||
  '/cosponsors?r=1&amp;s=2">Cosponsors (2)</a><div id="bill-summary"><h3>Summary</h3>\\n<p>About ' ||
  subtitle || ' &amp; more.</p><p>Second.</p></div>' AS body
FROM ({raw_bills})""",

    "cosponsor_pages": """
SELECT bill_key AS doc_id, 'https://www.congress.gov/bill/115th-congress/house-bill/' || bill_key || '/cosponsors' AS url,
  '<h1 class="legDetail">' || raw_title || '<span>x</span></h1><table class="item_table"><thead><tr><th>Cosponsor</th></tr></thead><tbody>' ||
  array_join(transform(sequence(1, 1 + CAST(bill_key % 3 AS INT)), i ->
    '<tr><td class="date"><a href="/member/x">' || CASE WHEN i = 3 THEN raw_sponsor ELSE 'Rep. Last' || i || ', Jo ' || bill_key || ' [D-TX-5]' END ||
    '</a></td><td>01/03/2018</td></tr>'), '') || '</tbody></table>' AS body
FROM ({raw_bills})""",

    # two pages of three amendments for the bill of every customer key
    "amendments": """
SELECT c_custkey AS doc_id, 'https://www.congress.gov/bill/115/hr/' || c_custkey || '/amendments?pageSort=asc' ||
  CASE WHEN page > 1 THEN '&page=' || page ELSE '' END AS url,
  '<ol class="basic-search-results-lists expanded-view">' || array_join(transform(sequence(1, 3), i ->
    '<li class="expanded"><span class="result-heading amendment-heading"><a href="/amendment/x">H.Amdt. ' ||
    (c_custkey * 10 + (page - 1) * 3 + i) || '</a></span></li>'), '') || '</ol>' AS body
FROM {customer} LATERAL VIEW explode(array(1, 2)) t AS page""",
}


# The same pages as the outside sites may write them: laid out in a table, with tables in cells, lists in items,
# cells, rows, items and paragraphs whose end tags are left out, comments, and foreign links and paragraphs.
_LAYOUT = ('<table class="layout"><tr><td>menu<td><!-- <table class="table"><tr><td> -->', "</table>")
NESTED: dict[str, tuple[tuple[str, str], ...]] = {
    "house_roster": (("st </td><td>", "st <table><tr><td>x<td><a>No, One</a></table><td>"), ("</td></tr>", ""),
                     ("<td>1 LHOB", '<td>1 LHOB<table class="room"><tbody><tr><td>a<td>b<td>c</tbody></table>')),
    "roll_index": (("</a></td>", "</a>"), ("</font></td>", "</font><table><tr><td>1<tr><td>2</table>")),
    "vote_menu": (("<td>x</td>", "<td>x<table><tr><td>Jan 01</td></tr></table>"), ("</td></tr>", "")),
    "bill_search": (("</span></li></ol>", '</span><ul><li>other<li><span class="result-item">(Introduced never)</span></ul></ol>'),),
    "bill_pages": (("<tr><th>", '<tr><th><table class="standard01"><tr><td>none</table>'), (" (Introduced 01/03/2018)</td>", ' (Introduced 01/03/2018)<table><tr><td><a>[x]</a></table>'),
                   ("<h3>Summary</h3>", "<div><p>Not this.</p></div>"), ("</p><p>Second.</p></div>", "<p>Second.</div><p>Nor this.</p>")),
    "cosponsor_pages": (("</td></tr>", "<table><tr><td><a>Not one</a></table>"), ("</a></td>", "</a>")),
    "amendments": (("</span></li>", '</span><ul><li>read<li>read again</ul>'),),
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "pages", "conversations")


def _names(sf_dir: str, parts: int = 0) -> dict[str, str]:
    """What stands for a table's name; with ``parts``, its rows are dealt over so many tasks."""
    table = f"(SELECT /*+ REPARTITION({parts}) */ * FROM parquet.`%s`)" if parts else "parquet.`%s`"
    names = {t: table % f"{sf_dir}/{t}.parquet" for t in TABLES}
    names["raw_bills"] = FEEDS["raw_bills"].format(**names)
    return names


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.sql(FEEDS[name].format(**_names(sf_dir)))


def documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Documents, one per row. A few MB of a table's rows are read by one task, but parsing their pages takes hours:
    the rows are dealt over the tasks of the cluster while they are short, so that no page is shuffled."""
    parts = max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return spark.sql(DOCUMENTS[name].format(**_names(sf_dir, parts)))


def nested_documents(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Documents with their bodies rewritten; what they say is the same."""
    body = F.col("body")
    for old, new in NESTED[name]:
        body = F.replace(body, F.lit(old), F.lit(new))
    before, after = _LAYOUT
    return documents(spark, sf_dir, name).withColumn("body", F.when(
        F.contains("body", F.lit("moved")), F.col("body")).otherwise(F.concat(F.lit(before), body, F.lit(after))))


def feed_sql(name: str) -> str:
    """The feed as DuckDB reads it, for use inside an oracle."""
    return FEEDS[name].format(**{t: t for t in TABLES})
