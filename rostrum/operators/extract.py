"""Rows out of landed documents ``(doc_id, url, body)``.

Every operator works document by document: one projection parses, one ``explode`` makes the rows,
nothing is shuffled. A document or entry that does not fit gives a row with errors.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions import casts, markup
from rostrum.functions.names import parse_bill, parse_politician, split_full_name
from rostrum.functions.text import (blank_to_null, clean_bill, resolve_url, strip, strip_ascii,
                                    strip_query, transliterate)
from rostrum.operators import errors
from rostrum.operators.filters import is_state_table, recent, without_header
from rostrum.operators.project import titled

_KEYS = ("doc_id", "url")

# The parts of the XML documents that are read.
_ROSTER_XML = """member array<struct<first_name:string,last_name:string,party:string,state:string>>,
  _corrupt_record string"""
_SENATE_XML = """vote_date string,
  document struct<document_name:string>,
  amendment struct<amendment_number:string,amendment_to_document_number:string>,
  members struct<member:array<struct<first_name:string,last_name:string,party:string,state:string,
    vote_cast:string>>>,
  _corrupt_record string"""
_HOUSE_XML = """`vote-metadata` struct<`legis-num`:string,`amendment-num`:array<string>,
    `action-date`:string>,
  amendment struct<amendment_to_document_number:string>,
  `vote-data` struct<`recorded-vote`:array<struct<
    legislator:struct<`_unaccented-name`:string,_party:string,_state:string,_VALUE:string>,
    vote:string>>>,
  _corrupt_record string"""


def _xml(schema: str) -> Column:
    parsed = F.from_xml(F.col("body"), " ".join(schema.split()),
                        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return parsed.alias("x")


def _flag_broken(df: DataFrame, step: str) -> DataFrame:
    broken = F.col("body").isNull() | F.col("x").isNull() | F.col("x._corrupt_record").isNotNull()
    return errors.flag(df, broken, "document is not well-formed", step)


def _entries(df: DataFrame, array: Column, name: str, what: str, step: str) -> DataFrame:
    """One row per entry; a document without entries gives one row with an error."""
    none = F.coalesce(F.size(array), F.lit(0)) < 1
    df = errors.flag(df, none & ~errors.has_errors(), f"document has no {what}", step)
    listed = df.withColumn(name, F.explode_outer(array))
    return listed.filter(F.col(name).isNotNull() | errors.has_errors())


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once: no filter or projection above is merged across a generator."""
    made = F.explode(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))).alias("extract__once")
    return df.select("*", made).select(*df.columns, *[F.col(f"extract__once.{name}").alias(name) for name in columns])


def _linked(link: str, name: str | None = None) -> Column:
    """A link as an absolute address; NULL where the page has none."""
    found = F.when(F.col(link).isNotNull(), resolve_url(F.col("url"), F.col(link)))
    return found.alias(name or link)


# ---- XML -------------------------------------------------------------------------------------

def senate_roster(docs: DataFrame) -> DataFrame:
    df = _flag_broken(docs.select(*_KEYS, "body", _xml(_ROSTER_XML)), "senate_roster")
    df = _entries(df, F.col("x.member"), "m", "members", "senate_roster")
    return df.select(*_KEYS, "m.first_name", "m.last_name", "m.party", "m.state", errors.ERRORS)


def senate_votes(docs: DataFrame) -> DataFrame:
    step = "senate_votes"
    df = _flag_broken(docs.select(*_KEYS, "body", _xml(_SENATE_XML)), step)
    number = F.coalesce(blank_to_null(F.col("x.document.document_name")),
                        blank_to_null(F.col("x.amendment.amendment_to_document_number")))
    df = df.select(
        *_KEYS, errors.ERRORS,
        clean_bill(number).alias("bill_id"),
        blank_to_null(clean_bill(F.col("x.amendment.amendment_number"))).alias("amdt_id"),
        casts.parse_date(F.col("x.vote_date"), casts.SENATE_VOTE_DATE).alias("vote_date"),
        F.col("x.members.member").alias("members"),
    )
    df = errors.flag(df, F.col("bill_id").isNull(), "no bill number", step)
    df = errors.flag(df, F.col("vote_date").isNull(), "no vote date", step)
    df = _entries(df, F.col("members"), "m", "votes", step)
    return df.select(
        *_KEYS, "bill_id", "amdt_id", "m.first_name", "m.last_name", "m.party", "m.state",
        casts.recode_vote(F.col("m.vote_cast"), casts.SENATE_VOTES).alias("vote_cast"),
        "vote_date", F.lit("SN").alias("chamber"), F.lit("US").alias("chamber_state"), errors.ERRORS,
    )


def house_vote_documents(docs: DataFrame) -> DataFrame:
    """One row per roll call, votes still in an array: the form to join to other pages."""
    step = "house_votes"
    df = _flag_broken(docs.select(*_KEYS, "body", _xml(_HOUSE_XML)), step)
    head = F.col("x.vote-metadata")
    numbers = F.coalesce(head["amendment-num"], F.array().cast("array<string>"))
    bill = F.coalesce(blank_to_null(head["legis-num"]),
                      blank_to_null(F.col("x.amendment.amendment_to_document_number")))
    df = df.select(
        *_KEYS, errors.ERRORS,
        clean_bill(bill).alias("bill_id"),
        casts.single_int(numbers).alias("amdt_num"),
        F.size(numbers).alias("amdt_nums"),
        casts.parse_date(head["action-date"], casts.HOUSE_VOTE_DATE).alias("vote_date"),
        F.col("x.vote-data.recorded-vote").alias("votes"),
    )
    df = errors.flag(df, F.col("bill_id").isNull(), "no bill number", step)
    df = errors.flag(df, F.col("vote_date").isNull(), "no vote date", step)
    df = errors.flag(df, (F.col("amdt_nums") > 0) & F.col("amdt_num").isNull(),
                     "no single amendment number", step)
    return df.drop("amdt_nums")


def house_vote_rows(documents: DataFrame) -> DataFrame:
    """The votes of roll calls; first names are not in the source and are looked up later."""
    amdt = F.col("amdt_id") if "amdt_id" in documents.columns else F.lit(None).cast("string")
    df = _entries(errors.with_errors(documents), F.col("votes"), "v", "votes", "house_votes")
    return df.select(
        *_KEYS, "bill_id", amdt.alias("amdt_id"), F.lit(None).cast("string").alias("first_name"),
        F.col("v.legislator._unaccented-name").alias("last_name"),
        F.col("v.legislator._party").alias("party"), F.col("v.legislator._state").alias("state"),
        casts.recode_vote(F.col("v.vote"), casts.HOUSE_VOTES).alias("vote_cast"),
        "vote_date", F.lit("HR").alias("chamber"), F.lit("US").alias("chamber_state"), errors.ERRORS,
    )


# ---- HTML ------------------------------------------------------------------------------------

def _linked_rows(body: Column, link: str) -> Column:
    """The rows of the tables, however deep, whose rows hold a link that matches; the outermost rows where none does.

    A row is its markup without the tables in it, so a row that only lays out a page with tables counts
    as little as the rows of a table within a cell.
    """
    bare = lambda r: F.struct(r["depth"].alias("depth"), markup.outside(r["inner"], "table").alias("own"))
    tested = lambda r: r.withField("linked", F.exists(markup.links(r["own"]), lambda v: v.rlike(link)))
    depth, own = (lambda r: r["depth"]), (lambda r: r["own"])

    def chosen(rows: Column) -> Column:
        linked = F.array_distinct(F.transform(F.filter(rows, lambda r: r["linked"]), depth))
        depths = markup.let(linked, lambda d: F.when(F.size(d) > 0, d).otherwise(F.array(F.array_min(F.transform(rows, depth)))))
        return markup.let(depths, lambda at: F.transform(F.filter(rows, lambda r: F.array_contains(at, r["depth"])), own))

    found = markup.let(F.transform(F.transform(markup.elements(body, "tr"), bare), tested), chosen)
    return F.when(markup.is_flat(body, "table") & markup.is_flat(body, "tr"), markup.flat_blocks(body, "tr")).otherwise(found)


def house_roster(docs: DataFrame, run_date: date | str | None = None) -> DataFrame:
    """Tables with a state caption; cells are district, name and party."""
    step = "house_roster"
    day = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    tables = F.coalesce(markup.blocks(F.col("body"), "table", r"class=[\"']table[\"']"),
                        F.array().cast("array<string>"))
    tables = F.transform(tables, lambda t: F.struct(t.alias("inner"), markup.own_element(t, "caption").alias("caption")))
    df = _once(docs.select(*_KEYS, "body"), tables=tables).drop("body")
    df = errors.flag(df, F.size("tables") == 0, "page has no table", step)
    caption_ids = F.transform("tables", lambda t: F.coalesce(markup.attribute(t["caption"]["head"], "id"), F.lit("")))
    other = F.forall(caption_ids, lambda c: (c != "") & ~is_state_table(c))
    df = errors.flag(df, (F.size("tables") > 0) & other, "page has no state table", step)
    df = _entries(df, F.col("tables"), "table", "tables", step)
    df = df.withColumn("caption_id", markup.attribute(F.col("table.caption.head"), "id"))
    df = errors.flag(df, F.col("table").isNotNull() & F.col("caption_id").isNull(),
                     "table has no caption id", step)
    df = df.filter(errors.has_errors() | is_state_table(F.col("caption_id")))
    bodies = markup.let(markup.blocks(F.col("table.inner"), "tbody", own=True),
                        lambda b: F.when(F.size(b) > 0, b).otherwise(F.array("table.inner")))
    rows = F.flatten(F.transform(bodies, lambda b: markup.blocks(b, "tr", own=True)))
    df = _once(df, state=markup.own_text(F.col("table.caption.inner")), rows=rows)
    df = _entries(df.select(*_KEYS, errors.ERRORS, "state", "rows"), F.col("rows"), "row", "rows in its state table", step)
    df = _once(df, cells=markup.blocks(F.col("row"), "td", own=True))
    df = _once(df, name=markup.own_text(markup.block(F.get("cells", F.lit(1)), "a")),
               district=markup.cell_text(F.get("cells", F.lit(0))), party=markup.cell_text(F.get("cells", F.lit(2))))
    df = markup.unescape_columns(df, "name", "district", "party", "state")
    df = errors.flag(df, ~errors.has_errors() & (F.col("name").isNull() | F.col("party").isNull()),
                     "row has no name or party", step)
    parts = split_full_name(F.col("name"))
    return df.select(*_KEYS, parts["first_name"].alias("first_name"),
                     parts["last_name"].alias("last_name"),
                     *[strip_ascii(F.col(c)).alias(c) for c in ("party", "state", "district")],
                     day.alias("date"), errors.ERRORS)


def house_roll_index(docs: DataFrame, year: Column | int, run_date: date | str,
                     mode: str = "through") -> DataFrame:
    """Links to roll calls and their bills, from the rows after the header."""
    step = "house_roll_index"
    year = F.lit(year) if isinstance(year, int) else year
    rows = markup.let(_linked_rows(F.col("body"), "rollnumber"), without_header)
    df = _once(docs.select(*_KEYS, year.alias("year"), "body"), rows=rows).drop("body")
    df = errors.flag(df, F.col("rows").isNull() | (F.size("rows") == 0), "page has no rows", step)
    df = _entries(df, F.col("rows"), "row", "rows", step)
    df = _once(df, links=markup.links(F.col("row")), texts=markup.text_nodes(F.col("row")))
    day = markup.first_matching(F.transform("texts", strip), r"^\d{1,2}-[A-Za-z]{3}$")
    df = df.select(
        *_KEYS, errors.ERRORS, "year", day.alias("day"),
        markup.first_matching(F.col("links"), "rollnumber").alias("vote_url"),
        markup.first_matching(F.col("links"), r"congress\.gov").alias("bill_url"),
    )
    df = errors.flag(df, ~errors.has_errors() & F.col("vote_url").isNull(), "row has no vote link", step)
    df = markup.unescape_columns(df, "vote_url", "bill_url")
    df = df.select(
        *_KEYS, errors.ERRORS,
        _linked("vote_url"), F.concat(_linked("bill_url"), F.lit("/amendments?pageSort=asc")).alias("bill_url"),
        casts.parse_day_in_year(F.col("day"), F.col("year"), casts.HOUSE_INDEX_DATE).alias("bill_date"),
    )
    df = errors.flag(df, ~errors.has_errors() & F.col("bill_date").isNull(), "row has no date", step)
    return df.filter(errors.has_errors() | recent(F.col("bill_date"), run_date, mode))


def roll_index_links(docs: DataFrame) -> DataFrame:
    """Links of the entry page to the pages that list roll calls."""
    rolls = F.filter(markup.links(F.col("body")), lambda v: F.contains(v, F.lit("ROLL")))
    df = _entries(errors.with_errors(docs.select(*_KEYS, rolls.alias("rolls"))), F.col("rolls"), "link",
                  "links to roll calls", "roll_index_links")
    return markup.unescape_columns(df, "link").select(*_KEYS, _linked("link"), errors.ERRORS)


def senate_vote_menu(docs: DataFrame, year: Column | int, run_date: date | str,
                     mode: str = "through") -> DataFrame:
    """Links to roll calls with their day, from the rows of the session's menu."""
    step = "senate_vote_menu"
    year = F.lit(year) if isinstance(year, int) else year
    df = _once(docs.select(*_KEYS, year.alias("year"), "body"), rows=_linked_rows(F.col("body"), "vote=")).drop("body")
    df = errors.flag(df, F.col("rows").isNull() | (F.size("rows") == 0), "page has no rows", step)
    df = _entries(df, F.col("rows"), "row", "rows", step)
    df = _once(df, links=markup.links(F.col("row")), cells=markup.blocks(F.col("row"), "td"))
    # a row without cells is a header
    df = df.filter(errors.has_errors() | (F.size("cells") > 0))
    df = _once(df, vote_url=markup.first_matching(F.col("links"), "vote="),
               day=markup.unescape(markup.cell_text(F.try_element_at("cells", F.lit(-1)))))
    df = df.select(*_KEYS, errors.ERRORS, "year", "vote_url", "day")
    df = errors.flag(df, ~errors.has_errors() & F.col("vote_url").isNull(), "row has no vote link", step)
    df = markup.unescape_columns(df, "vote_url")
    day = transliterate(F.col("day"))
    df = df.select(
        *_KEYS, errors.ERRORS, _linked("vote_url"),
        casts.parse_day_in_year(day, F.col("year"), casts.SENATE_MENU_DATE).alias("bill_date"),
    )
    df = errors.flag(df, ~errors.has_errors() & F.col("bill_date").isNull(), "row has no date", step)
    return df.filter(errors.has_errors() | recent(F.col("bill_date"), run_date, mode))


def xml_edition(docs: DataFrame) -> DataFrame:
    """The link of a roll-call page to its XML edition."""
    holder = markup.block(F.col("body"), "span", r"style=[\"']float: right[\"']")
    df = markup.unescape_columns(docs.select(*_KEYS, markup.first(markup.links(holder)).alias("xml_url")), "xml_url")
    df = errors.flag(df, F.col("xml_url").isNull(), "page has no link to its edition", "xml_edition")
    return df.select(*_KEYS, _linked("xml_url"), errors.ERRORS)


def bill_search(docs: DataFrame) -> DataFrame:
    """Bills of a search page: address and day of introduction."""
    df = errors.with_errors(docs.select(*_KEYS, "body"))
    items = markup.blocks(F.col("body"), "li", r"class=[\"']expanded[\"']")
    step = "bill_search"
    df = _entries(_once(df, items=items).drop("body"), F.col("items"), "item", "bills", step)
    texts = F.flatten(F.transform(
        markup.blocks(F.col("item"), "span", r"class=[\"']result-item[\"']"), markup.text_nodes))
    introduced = markup.first_matching(texts, "(Introduced|Submitted)")
    link = markup.first_matching(markup.links(F.col("item")), r"/bill/.*/.*/[0-9]*\?")
    df = df.select(*_KEYS, errors.ERRORS, strip_query(link).alias("bill_url"), introduced.alias("introduced"))
    df = errors.flag(df, ~errors.has_errors() & F.col("bill_url").isNull(), "bill has no link", step)
    return markup.unescape_columns(df, "bill_url") \
        .withColumn("introduced", casts.introduced_date(F.col("introduced")))


def next_page(docs: DataFrame) -> DataFrame:
    link = F.regexp_extract("body", r"(?is)(<a\b[^>]*?class=[\"']next[\"'][^>]*>)", 1)
    df = markup.unescape_columns(docs.select(*_KEYS, markup.attribute(link, "href").alias("next_url")), "next_url")
    return df.select(*_KEYS, _linked("next_url"))


_LEGEND = r"class=[\"']legDetail[\"']"
_FACTS = r"class=[\"']standard01[\"']"


def bill_details(docs: DataFrame) -> DataFrame:
    """Number, title, sponsor and summary of a bill page."""
    step = "bill_details"
    body = F.col("body")
    df = _once(errors.with_errors(docs.select(*_KEYS, "body")),
               heading=markup.own_text(markup.block(body, "h1", _LEGEND)),
               facts=markup.block(body, "table", _FACTS),
               summaries=markup.block(body, "div", r"\sid=[\"']bill-summary[\"']"),
               cosponsors=F.regexp_substr(markup.without_comments(body), F.lit(r"(?is)<a\b[^>]*>[^<]*Cosponsors")))
    df = df.withColumns({"facts": markup.blocks(F.col("facts"), "td", own=True), "summaries": markup.blocks(F.col("summaries"), "p", own=True)})
    texts = lambda parts: F.transform(parts, markup.own_text)
    people = F.flatten(F.transform("facts", lambda cell: texts(markup.blocks(markup.outside(cell, "table"), "a"))))
    some = lambda parts: markup.first(F.filter(texts(parts), lambda t: t.isNotNull()))
    df = _once(df, subtitle=some(F.col("facts")), sponsor=markup.first_matching(people, r"^.*\[.*\]$"),
               bill_summary=some(F.col("summaries")))
    df = df.withColumn("cosponsors", markup.attribute(F.col("cosponsors"), "href"))
    df = markup.unescape_columns(df, "heading", "subtitle", "sponsor", "bill_summary", "cosponsors")
    bill, sponsor = parse_bill(F.col("heading")), parse_politician(F.col("sponsor"))
    df = df.select(
        *_KEYS, errors.ERRORS, bill["bill_id"].alias("bill_id"), bill["amdt_id"].alias("amdt_id"),
        titled(bill["bill_title"], F.col("subtitle")).alias("bill_title"), "bill_summary",
        sponsor["first_name"].alias("sponsor_fn"), sponsor["last_name"].alias("sponsor_ln"),
        sponsor["party"].alias("sponsor_party"), sponsor["state"].alias("sponsor_state"),
        F.col("url").alias("bill_url"),
        _linked("cosponsors", "cosponsors_url"),
    )
    df = errors.flag(df, F.col("bill_id").isNull(), "no bill number", step)
    return errors.flag(df, F.col("sponsor_ln").isNull(), "no sponsor", step)


def cosponsors(docs: DataFrame) -> DataFrame:
    """One row per cosponsor, with the bill of the page."""
    step = "cosponsors"
    table = markup.block(F.col("body"), "table", r"class\s?=\s?[\"']item_table[\"']")
    people = markup.let(markup.outside(table, "table"), lambda own: F.transform(
        markup.blocks(F.coalesce(markup.block(own, "tbody"), own), "a"), markup.own_text))
    df = _once(docs.select(*_KEYS, "body"), heading=markup.own_text(markup.block(F.col("body"), "h1", _LEGEND)), people=people).drop("body")
    bill = parse_bill(F.col("heading"))
    df = markup.unescape_columns(df, "heading")
    df = errors.flag(df.withColumns({"bill_id": bill["bill_id"], "amdt_id": bill["amdt_id"]}),
                     F.col("bill_id").isNull(), "no bill number", step)
    df = markup.unescape_columns(_entries(df, F.col("people"), "person", "cosponsors", step), "person")
    person = parse_politician(F.col("person"))
    df = df.select(
        *_KEYS, errors.ERRORS, "bill_id", "amdt_id", "person",
        person["first_name"].alias("cosponsor_fn"), person["last_name"].alias("cosponsor_ln"),
        person["party"].alias("cosponsor_party"), person["state"].alias("cosponsor_state"),
    )
    unread = F.col("person").isNotNull() & F.col("cosponsor_ln").isNull()
    df = errors.flag(df, unread, F.concat(F.lit("not a person: "), F.col("person")), step)
    return df.drop("person")


def amendment_pages(docs: DataFrame) -> DataFrame:
    """One row per page of a bill's amendments: ``bill_url, page, heads, errors``, the headings as markup.

    The page number is in the address; the first page has none.
    """
    items = markup.blocks(F.col("body"), "li", r"class=[\"']expanded[\"']")
    page = F.coalesce(casts.to_int(F.regexp_extract("url", r"[?&]page=(\d+)", 1)), F.lit(1))
    heads = F.transform(items, lambda i: markup.block(i, "span", r"class=[\"']result-heading amendment-heading[\"']"))
    # entries of another kind have no heading and no number
    heads = F.coalesce(F.filter(heads, lambda h: h.isNotNull()), F.array().cast("array<string>"))
    pages = docs.select(F.regexp_replace("url", r"[?&]page=\d+", "").alias("bill_url"), page.alias("page"), "body")
    pages = _once(pages, heads=heads).drop("body")
    return errors.flag(pages, F.size("heads") == 0, "document has no amendments", "amendment_listing")


def amendment_listing(docs: DataFrame) -> DataFrame:
    """Amendments of a bill with their number in the whole listing: their place on their page, after all
    entries of the bill's earlier pages, however many each holds.

    A page that landed several times counts once. Where an earlier page is missing, or one
    landed with different entries, numbers are unknown: such rows have none, and an error. One shuffle, by bill.
    """
    step = "amendment_listing"
    pages = amendment_pages(docs).groupBy("bill_url", "page").agg(
        F.collect_set("heads").alias("versions"), F.flatten(F.collect_list(errors.ERRORS)).alias("all_errors"))
    versions = F.filter("versions", lambda v: F.size(v) > 0)
    sole, some = F.size(versions) == 1, F.size(versions) > 0
    pages = pages.select("bill_url", "page", F.when(some, F.get(versions, F.lit(0))).alias("heads"), sole.alias("sole"),
                         F.when(some, F.array().cast(pages.schema["all_errors"].dataType)).otherwise(F.slice("all_errors", 1, 1)).alias(errors.ERRORS),
                         F.explode(F.when(some, versions).otherwise(F.array(F.array().cast("array<string>")))).alias("version"))
    earlier = Window.partitionBy("bill_url").orderBy("page").rangeBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.when(F.col("sole"), F.size("heads"))).over(earlier), F.lit(0))
    listed = F.count_if("sole").over(earlier)
    known = pages.withColumns({"before": before, "known": F.col("sole") & (listed == F.col("page") - 1)})
    flagged = errors.flag(known, F.col("sole") & ~F.col("known"), "an earlier page is missing", step)
    flagged = errors.flag(flagged, (F.size("version") > 0) & ~F.col("sole"), "page landed with different entries", step)
    listing = flagged.select("bill_url", "before", "known", errors.ERRORS, F.posexplode_outer("version").alias("pos", "heading"))
    listing = listing.select(
        "bill_url", F.when(F.col("known"), F.col("before") + F.col("pos") + 1).cast("int").alias("ordinal"),
        markup.own_text(markup.block(F.col("heading"), "a")).alias("amdt_id"), errors.ERRORS)
    return markup.unescape_columns(listing, "amdt_id").withColumn("amdt_id", clean_bill(F.col("amdt_id")))
