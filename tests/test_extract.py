"""Documents that do not fit give error rows, never a failed job or a silent loss."""

from __future__ import annotations

import time

import pytest

from pyspark.sql import functions as F

from rostrum_testing import rows
from checks import fixtures
from rostrum.functions import markup
from rostrum.operators import extract
from rostrum.plans import crawl
from rostrum.schemas import DOCUMENT


def docs(spark, *bodies, url="http://h.org/p"):
    return spark.createDataFrame([(i, url, b) for i, b in enumerate(bodies)], DOCUMENT)


def steps(df):
    return sorted(str(r[0]) for r in df.select("errors.ptransform").collect())


def test_broken_xml(spark):
    df = docs(spark, "<a><b></a>", None, "", "plain")
    for operator in (extract.senate_roster, extract.senate_votes, extract.house_vote_documents):
        found = operator(df)
        assert found.filter("size(errors) > 0").select("doc_id").distinct().count() == 4, operator


def test_single_member_and_accents(spark):
    xml = ("<contact_information><member><first_name>É. A</first_name><last_name>O&amp;B</last_name>"
           "<party>R</party><state>MA</state></member></contact_information>")
    assert rows(extract.senate_roster(docs(spark, xml)), "first_name", "last_name") == [("É. A", "O&B")]


def test_two_amendment_numbers(spark):
    xml = ("<rollcall-vote><vote-metadata><legis-num>H R 1</legis-num><amendment-num>1</amendment-num>"
           "<amendment-num>2</amendment-num><action-date>5-Dec-2018</action-date></vote-metadata>"
           "<vote-data><recorded-vote><legislator unaccented-name='Lee' party='R' state='MA'>Lee</legislator>"
           "<vote>Aye</vote></recorded-vote></vote-data></rollcall-vote>")
    found = extract.house_vote_documents(docs(spark, xml))
    assert found.first().errors[0].error_msg == "no single amendment number"


def test_ordinal_at_the_page_end(spark):
    """The hundredth of a hundred per page is the last of page one."""
    items = [f"<li class='expanded'><span class='result-heading amendment-heading'><a href='x'>A. {i}</a></span></li>"
             for i in range(1, 102)]
    first, second = "".join(items[:100]), "".join(items[100:])
    pages = spark.createDataFrame([(1, "http://c/a?pageSort=asc", first), (2, "http://c/a?pageSort=asc&page=2", second)],
                                  DOCUMENT)
    listing = extract.amendment_listing(pages)
    calls = spark.createDataFrame([(100,), (101,), (102,), (None,)], "amdt_num int") \
        .withColumn("bill_url", F.lit("http://c/a?pageSort=asc"))
    found = crawl.resolve_amendments(calls, listing)
    assert rows(found, "amdt_num", "amdt_id", F.size("errors")) == sorted(
        [(100, "A100", 0), (101, "A101", 0), (102, None, 1), (None, None, 0)], key=repr)


def test_pages_without_tables(spark):
    df = docs(spark, "<p>nothing</p>", None)
    assert steps(extract.house_roster(df, "2018-10-24")) == ["['house_roster']"] * 2
    assert steps(extract.house_roll_index(df, 2018, "2018-10-24")) == ["['house_roll_index']"] * 2
    assert steps(extract.senate_vote_menu(df, 2018, "2018-10-24")) == ["['senate_vote_menu']"] * 2
    assert extract.bill_details(df).filter("size(errors) > 0").count() == 2
    assert extract.cosponsors(df).filter("size(errors) > 0").count() == 2


def test_documents_without_entries(spark):
    """Each gives a row with an error: none is lost."""
    head = '<h1 class="legDetail">H.R.5 - T</h1>'
    cases = [
        (extract.senate_roster, "<contact_information></contact_information>"),
        (extract.senate_roster, "<html><body>moved</body></html>"),
        (extract.senate_votes, "<roll_call_vote><vote_date>October 3, 2018, 02:30 PM</vote_date><document><document_name>"
                               "s. 1</document_name></document><members/></roll_call_vote>"),
        (lambda d: extract.house_vote_rows(extract.house_vote_documents(d)),
         "<rollcall-vote><vote-metadata><legis-num>H R 1</legis-num><action-date>5-Dec-2018</action-date></vote-metadata>"
         "<vote-data/></rollcall-vote>"),
        (lambda d: extract.house_roster(d, "2018-10-24"),
         '<table class="table"><caption id="by-name">A</caption><tbody><tr><td>x</td></tr></tbody></table>'),
        (lambda d: extract.house_roster(d, "2018-10-24"), '<table class="table"><caption id="state-oh">Ohio</caption><tbody></tbody></table>'),
        (extract.cosponsors, head), (extract.roll_index_links, "<p>x</p>"), (extract.xml_edition, "<p>x</p>"),
        (extract.bill_search, "<ol></ol>"), (extract.bill_search, '<ol><li class="expanded">no link</li></ol>'),
        (extract.amendment_listing, "<ol></ol>"),
    ]
    for operator, body in cases:
        found = operator(docs(spark, body))
        assert rows(found, F.size("errors") > 0) == [(True,)], body


def test_foreign_entries_keep_ordinals(spark):
    head = "<li class='expanded'><span class='result-heading amendment-heading'><a href='x'>A. {}</a></span></li>"
    page = head.format(1) + "<li class='expanded'><span>advert</span></li>" + head.format(2)
    assert rows(extract.amendment_listing(docs(spark, page)), "ordinal", "amdt_id") == [(1, "A1"), (2, "A2")]


def test_recency(spark):
    row = '<tr><td><a href="v?vote=1">1</a></td><td>{}</td></tr>'
    page = "<table>" + "".join(row.format(d) for d in ("Oct 22", "Oct 23", "Oct 24")) + "</table>"
    found = extract.senate_vote_menu(docs(spark, page), 2018, "2018-10-24")
    assert rows(found, F.col("bill_date").cast("string")) == [("2018-10-22",), ("2018-10-23",)]
    assert extract.senate_vote_menu(docs(spark, page), 2018, "2018-10-24", mode="only").count() == 1


def test_unreadable_cosponsor(spark):
    page = ('<h1 class="legDetail">H.R.5 - T</h1><table class="item_table"><tbody>'
            '<tr><td><a>Rep. Lee, Al [D-MA]</a></td></tr><tr><td><a>Nobody</a></td></tr></tbody></table>')
    found = extract.cosponsors(docs(spark, page))
    assert rows(found, "bill_id", "cosponsor_ln", F.size("errors")) == sorted(
        [("HR5", "Lee", 0), ("HR5", None, 1)], key=repr)


def test_rows_without_links_or_captions(spark):
    page = "<table><tr><th>h</th></tr><tr><td>1</td><td>5-Dec</td></tr></table>"
    found = extract.house_roll_index(docs(spark, page), 2017, "2018-10-24")
    assert rows(found, "vote_url", "errors.error_msg") == [(None, ["row has no vote link"])]
    page = "<table><tr><td>1</td><td>Dec 05</td></tr></table>"
    found = extract.senate_vote_menu(docs(spark, page), 2017, "2018-10-24")
    assert rows(found, "vote_url", "errors.error_msg") == [(None, ["row has no vote link"])]
    page = "<table class='table'><caption>Ohio</caption><tbody><tr><td>1</td><td><a>A, B</a></td><td>R</td></tr></tbody></table>"
    found = extract.house_roster(docs(spark, page), "2018-10-24")
    assert rows(found, "last_name", "errors.error_msg") == [("A", ["table has no caption id"])]


# ---- nested and unclosed elements ------------------------------------------------------------

def value(spark, html, column):
    return spark.createDataFrame([(html,)], "c string").select(column(F.col("c")).alias("x")).first().x


PAGE = "<table id=1><tr><td>a<table id=2><tr><td>b<td>c</table>after</td><td>d<tr><td>e</table><table><td>z"


def test_elements_reach_to_what_ends_them(spark):
    cell = "a<table id=2><tr><td>b<td>c</table>after"
    cases = [
        (PAGE, "table", False, [f"<tr><td>{cell}</td><td>d<tr><td>e", "<tr><td>b<td>c", "<td>z"]),
        (PAGE, "td", False, [cell, "b", "c", "d", "e", "z"]),
        (PAGE, "tr", False, [f"<td>{cell}</td><td>d", "<td>b<td>c", "<td>e"]),
        (f"<tr><td>{cell}</td><td>d<tr><td>e", "tr", True, [f"<td>{cell}</td><td>d", "<td>e"]),
        (f"<td>{cell}</td><td>d", "td", True, [cell, "d"]),
        ("<ul><li>1<ul><li>x<li>y</ul>2<li>3</ul>", "li", False, ["1<ul><li>x<li>y</ul>2", "x", "y", "3"]),
        ("<ul><li>1<ul><li>x<li>y</ul>2<li>3</ul>", "li", True, []),
        ("<p>one<p>two<div><p>in</p></div>x<p>out", "p", False, ["one", "two", "in", "out"]),
        ("<p>one<p>two<div><p>in</p></div>x<p>out", "p", True, ["one", "two", "out"]),
        ("<div>n<!-- <div> --></div><script>'<div>'</script><div a='x>y'>k</div><div title=5\">z", "div", False, ["n<!-- <div> -->", "k", "z"]),
        ("</div><div>a<div>b</div></div></div><div>c</div>", "div", False, ["a<div>b</div>", "b", "c"]),
        ("<SPAN\nid=1>a<span>b</SPAN >c</span><spanner>d</spanner>", "span", False, ["a<span>b</SPAN >c", "b"]),
        ("no tags", "td", False, []), ("", "td", False, []), (None, "td", False, None),
    ]
    for html, tag, own, expected in cases:
        assert value(spark, html, lambda c: markup.blocks(c, tag, own=own)) == expected, (html, tag)


def test_tree_agrees_with_patterns_on_flat_pages(spark):
    html = "<tr><td class='x'>1</td><TD>2<br></TD ></tr>\n<tr><td class=x>3</td><td></td></tr>"
    for tag, attributes in (("td", ""), ("td", "class="), ("tr", ""), ("th", "")):
        tree = value(spark, html, lambda c: F.transform(markup.elements(c, tag, attributes), lambda e: e["inner"]))
        assert tree == value(spark, html, lambda c: markup.flat_blocks(c, tag, attributes)) == value(spark, html, lambda c: markup.blocks(c, tag, attributes))


def test_own_text_and_outside(spark):
    assert value(spark, "x<b>1<b>2</b>3</b>y", markup.own_text) == "x"
    assert value(spark, "<b>1<b>2</b>3</b>y<br>z", markup.own_text) == "y"
    assert value(spark, "<b>1</b><img src='a'><!-- <i> -->z", markup.own_text) == "z"
    assert value(spark, "<b>1</b>", markup.own_text) is None and value(spark, "", markup.own_text) is None
    assert value(spark, "q<table>1<TABLE>2</table>3</table>y", lambda c: markup.outside(c, "table")) == "qy"
    assert value(spark, "<b>R</b>", markup.cell_text) == "R" and value(spark, "D<table>x</table>", markup.cell_text) == "D"


def test_trees_grow_with_the_page(spark):
    """Thirty thousand unclosed elements and a thousand nested ones: far beyond what work in the square of the number allows."""
    deep = "<div>" * 1_000 + "x" + "</div>" * 1_000
    flat = "<table>" + "<tr><td>a<td>b" * 10_000 + "</table>"
    start = time.perf_counter()
    assert value(spark, deep, lambda c: F.size(F.filter(markup.elements(c, "div"), lambda e: e["depth"] < 0))) == 0
    found = value(spark, flat, lambda c: markup.blocks(c, "td"))
    assert len(found) == 20_000 and set(found) == {"a", "b"} and time.perf_counter() - start < 120


def test_summary_is_bound_to_its_element(spark):
    head = '<h1 class="legDetail">H.R.5 - T</h1><table class="standard01"><tr><td><a>Rep. Lee, Al [D-MA]</a>Sub</table>'
    pages = {'<div id="bill-summary"></div><p>Foreign.</p>': None, '<div id="bill-summary"><div><p>In.</p></div></div><p>Foreign.</p>': None,
             '<div id="bill-summary"><div>x</div><p>Own <i>it</i>.<p>Next.</div><p>Foreign.</p>': "Own ", "": None,
             '<div><div class=a id="bill-summary"><h3>S</h3><p><b>Bold</b> first.</p></div></div>': " first."}
    found = extract.bill_details(docs(spark, *[head + p for p in pages]))
    assert rows(found, "doc_id", "bill_summary", "bill_title") == [(i, s, "TSub") for i, s in enumerate(pages.values())]


def listing_page(numbers, n=1):
    items = "".join(f"<li class='expanded'><span class='result-heading amendment-heading'><a href='x'>A. {i}</a></span></li>" for i in numbers)
    return "http://c/a?pageSort=asc" + (f"&page={n}" if n > 1 else ""), items


def numbered(spark, *pages):
    df = spark.createDataFrame([(i, url, body) for i, (url, body) in enumerate(pages)], DOCUMENT)
    return rows(extract.amendment_listing(df), "amdt_id", "ordinal", F.coalesce(F.get("errors", F.lit(0))["error_msg"], F.lit("")))


def test_ordinals_over_pages_of_any_size(spark):
    assert numbered(spark, listing_page((1, 2)), listing_page((3, 4, 5), 2), listing_page((6,), 3)) == [(f"A{i}", i, "") for i in range(1, 7)]
    # landed twice alike: once
    assert numbered(spark, listing_page((1, 2)), listing_page((1, 2)), listing_page((3,), 2)) == [(f"A{i}", i, "") for i in range(1, 4)]
    missing = "an earlier page is missing"
    assert numbered(spark, listing_page((1,)), listing_page((3,), 3), listing_page((4,), 4)) == sorted(
        [("A1", 1, ""), ("A3", None, missing), ("A4", None, missing)], key=repr)
    assert numbered(spark, listing_page((2,), 2)) == [("A2", None, missing)]
    differ = "page landed with different entries"
    assert numbered(spark, listing_page((1,)), listing_page((2,)), listing_page((3,), 2)) == sorted(
        [("A1", None, differ), ("A2", None, differ), ("A3", None, missing)], key=repr)
    # a page without entries is an error, and what follows has no number
    assert numbered(spark, listing_page(()), listing_page((1,), 2)) == sorted(
        [(None, None, "document has no amendments"), ("A1", None, missing)], key=repr)


def test_index_rows_within_layout_tables(spark):
    row = '<tr><td><a href="vote.asp?rollnumber={0}">{0}</a><td>{0}-Dec<table><tr><td>detail</table>'
    page = "<table><tr><td><a href='/home'>menu</a><td><table><tr><th>Roll" + "".join(map(row.format, (5, 6))) + "</table></table>"
    found = extract.house_roll_index(docs(spark, page), 2017, "2018-10-24")
    assert rows(found, F.col("bill_date").cast("string"), F.size("errors")) == [("2017-12-05", 0), ("2017-12-06", 0)]


def _one_task_tables(spark, path):
    """Driver tables of 256 rows in one file, which one task reads."""
    ids = spark.range(256, numPartitions=1)
    ids.selectExpr("id AS c_custkey", "CAST(id % 25 AS INT) AS c_nationkey").write.parquet(f"{path}/customer.parquet")
    ids.selectExpr("id AS p_partkey", "'p' AS p_name", "'t' AS p_type", "CAST(id % 50 AS INT) AS p_size").write.parquet(f"{path}/part.parquet")
    ids.selectExpr("id AS o_orderkey", "id AS o_custkey", "'O' AS o_orderstatus", "TIMESTAMP'1998-03-02' AS o_orderdate") \
        .write.parquet(f"{path}/orders.parquet")
    return path


@pytest.mark.parametrize("name", sorted(fixtures.DOCUMENTS))
def test_pages_of_one_file_are_parsed_by_many_tasks(spark, tmp_path, name):
    path = _one_task_tables(spark, str(tmp_path))
    docs = (fixtures.nested_documents if name in fixtures.NESTED else fixtures.documents)(spark, path, name)
    pages = docs.groupBy(F.spark_partition_id()).count().collect()
    assert len(pages) > 8 and max(n for _, n in pages) < 256 // 4


def test_unclosed_elements_by_pattern_and_by_tree(spark):
    bodies = ["<td>a<td>b</td>c<th>d<tr><td e='>'>f", "</td</td\n<td>x<td>y", "<td>a\x01b<td>c<table><td>d</table>", "<td>a<!-- <td> -->b", "<td", "", None,
              "\x01<tr><td>\x01</td>\x01"]
    df = docs(spark, *bodies)
    for tag in ("td", "tr", "li", "p", "a"):
        tree = F.transform(markup.elements(F.col("body"), tag), lambda e: e["inner"])
        assert rows(df, "doc_id", markup.blocks(F.col("body"), tag)) == rows(df, "doc_id", tree), tag
    cells = {r[0]: r[1] for r in df.select("doc_id", markup.blocks(F.col("body"), "td")).collect()}
    assert cells[0] == ["a", "b", "f"] and cells[2] == ["a\x01b", "c<table><td>d</table>", "d"] and cells[7] == ["\x01"]
