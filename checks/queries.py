"""The registered queries: each reads whole driver tables and returns one DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from checks.fixtures import RUN_DATE, documents, feed, nested_documents, read
from rostrum.functions import casts, markup, names, text
from rostrum.operators import errors, extract, filters, lookup, membership, project, scrub
from rostrum.plans import crawl, feeds
from rostrum.schemas import FEEDS, TABLES, csv_schema
from rostrum.session import shared_dir
from rostrum.sources import documents as landed_documents
from rostrum.sources import feeds as csv_feeds
from rostrum.sources import messages, sinks, tables, versions
from rostrum.streaming import feeds as streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def with_status(df: DataFrame) -> DataFrame:
    """The deciding error of each row as plain columns."""
    return errors.with_errors(df).withColumns({
        "error_msg": errors.deciding_error()["error_msg"],
        "ptransform": errors.deciding_error()["ptransform"],
    }).drop(errors.ERRORS)


def joined(values: Column) -> Column:
    return F.array_join(values.cast("array<string>"), ",")


def dims(spark: SparkSession, sf_dir: str, *wanted: str) -> feeds.Dimensions:
    optional = {name: feed(spark, sf_dir, name) for name in wanted}
    return feeds.Dimensions(nicknames=feed(spark, sf_dir, "nicknames"), **optional)


# ---- names and text --------------------------------------------------------------------------

@query
def scrub_first(spark, sf):
    df = scrub.scrub_first_name(feed(spark, sf, "members"), keep_suffix=True)
    return df.select("member_id", "first_name", "suffix")


@query
def scrub_last_suffix(spark, sf):
    df = scrub.scrub_first_name(feed(spark, sf, "members"), keep_suffix=True)
    return scrub.scrub_last_name(df).select("member_id", "last_name", "suffix")


@query
def scrub_texts(spark, sf):
    """The whole texts as if they were names: long values, several lines."""
    df = read(spark, sf, "documents").select("doc_id", F.col("text").alias("last_name"))
    return scrub.scrub_column(df, "last_name", "suffix")


@query
def scrub_strip_quotes(spark, sf):
    df = feed(spark, sf, "members").withColumn("first_name", F.concat("first_name", F.lit('" x')))
    return scrub.scrub_first_name(df, True, strip_quotes=True).select("member_id", "first_name", "suffix")


@query
def scrub_legacy(spark, sf):
    df = feed(spark, sf, "members")
    return df.select("member_id", names.scrub_name_legacy(F.col("first_name")).alias("first_name"),
                     names.scrub_name_legacy(F.col("last_name")).alias("last_name"))


@query
def find_suffix(spark, sf):
    df = feed(spark, sf, "members")
    return df.select("member_id", names.find_suffix(F.col("first_name"), F.col("last_name")).alias("suffix"))


@query
def clean_bill(spark, sf):
    df = feed(spark, sf, "raw_bills")
    return df.select("bill_key", text.clean_bill(F.col("raw_title")).alias("bill_id"))


@query
def congress_session(spark, sf):
    day = F.col("o_orderdate").cast("date")
    return read(spark, sf, "orders").select(
        "o_orderkey", text.congress_number(day).alias("congress"), text.session_number(day).alias("session"))


@query
def transliterate(spark, sf):
    return read(spark, sf, "documents").select("doc_id", text.transliterate(F.col("text")).alias("text"))


@query
def transliterate_scripts(spark, sf):
    """Customers under names in seven scripts."""
    return feed(spark, sf, "foreign_names").select("member_id", text.transliterate(F.col("name")).alias("name"))


@query
def comma_strip(spark, sf):
    df = read(spark, sf, "documents").select("doc_id", "text", "lang", "source")
    return scrub.drop_commas_everywhere(df)


@query
def fullname_split(spark, sf):
    df = feed(spark, sf, "members")
    listed = F.when(F.col("member_id") % 2 == 0, F.concat("last_name", F.lit(", "), "first_name")) \
        .otherwise(F.concat(F.lit("Member "), F.col("first_name")))
    parts = names.split_full_name(listed)
    return df.select("member_id", parts["first_name"].alias("first_name"), parts["last_name"].alias("last_name"))


@query
def sponsor_parse(spark, sf):
    parts = names.parse_politician(F.col("raw_sponsor"))
    return feed(spark, sf, "raw_bills").select("bill_key", *[c.alias(n) for n, c in parts.items()])


@query
def bill_parse(spark, sf):
    parts = names.parse_bill(F.col("raw_title"))
    return feed(spark, sf, "raw_bills").select("bill_key", *[c.alias(n) for n, c in parts.items()])


@query
def char_positions(spark, sf):
    found = text.char_positions(F.col("text"), ",")
    return read(spark, sf, "documents").select("doc_id", joined(found).alias("positions"))


@query
def url_strip(spark, sf):
    return read(spark, sf, "pages").select("page_id", text.strip_query(F.col("url")).alias("url"))


@query
def url_resolve(spark, sf):
    df = read(spark, sf, "pages").select("page_id", "url", F.explode(markup.links(F.col("html"))).alias("href"))
    relative = F.expr("substring(href, 2)")
    return df.select("page_id", "href", text.resolve_url(F.col("url"), F.col("href")).alias("absolute"),
                     text.resolve_url(F.col("url"), F.concat(F.lit("../x/"), relative)).alias("upward"))


# ---- casts and recodes -----------------------------------------------------------------------

@query
def fix_types(spark, sf):
    df = feed(spark, sf, "votes").select("vote_id", "vote_cast")
    return with_status(project.drop_raw(project.fix_types(df, ["vote_cast"])))


@query
def fix_none(spark, sf):
    return project.fix_none(feed(spark, sf, "votes")).select("vote_id", "amdt_id", "first_name", "vote_cast")


def _vote_text() -> Column:
    return F.when(F.col("l_returnflag") == "A", "Yea").when(F.col("l_returnflag") == "N", "No") \
        .when(F.col("l_linenumber") == 1, "Nay").when(F.col("l_linenumber") == 2, "Aye").otherwise("Present")


@query
def vote_recode_senate(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", casts.recode_vote(_vote_text(), casts.SENATE_VOTES).alias("vote_cast"))


@query
def vote_recode_house(spark, sf):
    return read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", casts.recode_vote(_vote_text(), casts.HOUSE_VOTES).alias("vote_cast"))


@query
def date_parse(spark, sf):
    day = F.col("o_orderdate")
    year = F.year(day)
    return read(spark, sf, "orders").select(
        "o_orderkey",
        casts.parse_date(F.concat(F.date_format(day, "MMMM d, yyyy"), F.lit(",  11:40 AM")),
                         casts.SENATE_VOTE_DATE).alias("senate_vote"),
        casts.parse_date(F.date_format(day, "dd-MMM-yyyy"), casts.HOUSE_VOTE_DATE).alias("house_vote"),
        casts.parse_day_in_year(F.date_format(day, "MMM dd"), year, casts.SENATE_MENU_DATE).alias("senate_menu"),
        casts.parse_day_in_year(F.date_format(day, "d-MMM"), year, casts.HOUSE_INDEX_DATE).alias("house_index"),
        casts.introduced_date(F.concat(
            F.when(F.col("o_orderstatus") == "P", F.lit(" (Submitted ")).otherwise(F.lit(" (Introduced ")),
            F.date_format(day, "MM/dd/yyyy"), F.lit(") "))).alias("introduced"),
    )


@query
def amendment_number(spark, sf):
    df = read(spark, sf, "orders")
    found = F.when(F.col("o_orderstatus") == "F", F.array().cast("array<string>")) \
        .when(F.col("o_orderstatus") == "O", F.array(F.col("o_custkey").cast("string"))) \
        .otherwise(F.array(F.lit("1"), F.lit("2")))
    checked = errors.flag(df, (F.size(found) > 0) & casts.single_int(found).isNull(),
                          "no single amendment number", "house_votes")
    return with_status(checked.select("o_orderkey", casts.single_int(found).alias("amdt_num"), errors.ERRORS))


# ---- filters and routing ---------------------------------------------------------------------

@query
def tag_errors_counts(spark, sf):
    checked = project.fix_types(feed(spark, sf, "votes"), ["vote_cast"])
    branch = F.when(errors.has_errors(), F.lit("error")).otherwise(F.lit("clean"))
    return checked.groupBy(branch.alias("branch")).agg(F.count(F.lit(1)).alias("n"))


def _mixed_records(spark, sf) -> DataFrame:
    """Records of several kinds in one map column, kind by event type."""
    value = F.col("value").cast("string")
    pair = {
        "click": ("bill_id", "bill_url"), "error": ("bill_id", "cosponsor_fn"),
    }
    record = F.create_map(F.lit("bill_id"), value, F.lit("amdt_id"), F.col("user_id").cast("string"))
    for kind, (a, b) in pair.items():
        record = F.when(F.col("event_type") == kind, F.create_map(
            F.lit(a), value, F.lit(b), F.col("props"))).otherwise(record)
    return read(spark, sf, "events").select("event_id", record.alias("record"))


@query
def route_by_keys(spark, sf):
    df = _mixed_records(spark, sf)
    keys = F.map_keys("record")
    return df.select(
        "event_id",
        csv_feeds.belongs_to(keys, FEEDS["bill_info"]).alias("is_bill"),
        csv_feeds.belongs_to(keys, FEEDS["cosponsors"]).alias("is_cosponsor"))


@query
def route_cosponsors(spark, sf):
    return csv_feeds.route_records(_mixed_records(spark, sf), F.col("record"), "cosponsors")


@query
def recent_through(spark, sf):
    day = F.col("o_orderdate").cast("date")
    df = read(spark, sf, "orders").filter(filters.recent(day, "1998-06-01"))
    return df.select("o_orderkey", day.alias("bill_date"))


@query
def recent_only(spark, sf):
    day = F.col("o_orderdate").cast("date")
    df = read(spark, sf, "orders").filter(filters.recent(day, "1998-06-01", mode="only"))
    return df.select("o_orderkey", day.alias("bill_date"))


@query
def link_filter(spark, sf):
    found = markup.first_matching(markup.links(F.col("html")), "[.,]$")
    return read(spark, sf, "pages").select("page_id", found.alias("link"))


@query
def header_skip(spark, sf):
    rows = filters.without_header(markup.blocks(F.col("html"), "li"))
    df = read(spark, sf, "pages").select("page_id", F.posexplode(rows).alias("pos", "row"))
    return df.select("page_id", "pos", markup.all_text(F.col("row")).alias("row_text"))


# ---- lookups ---------------------------------------------------------------------------------

@query
def nickname_lookup(spark, sf):
    df = scrub.scrub_first_name(feed(spark, sf, "members"))
    df = lookup.fix_nickname(df, feed(spark, sf, "nicknames"), keep_nickname=True)
    return df.select("member_id", "first_name", "nickname")


@query
def nickname_first(spark, sf):
    df = scrub.scrub_first_name(feed(spark, sf, "members"))
    return lookup.first_nickname(df, feed(spark, sf, "nicknames")).select("member_id", "first_name", "nickname")


def _house_lookup(spark, sf, limit: int) -> DataFrame:
    df = feed(spark, sf, "votes").select("vote_id", "first_name", "last_name", "party", "state", "vote_date")
    return with_status(lookup.fix_house_first_name(df, feed(spark, sf, "house"), limit))


@query
def house_first_name(spark, sf):
    return _house_lookup(spark, sf, lookup.BROADCAST_LIMIT)


@query
def house_first_name_shuffled(spark, sf):
    """The same without broadcast: crowded keys spread over tasks."""
    return _house_lookup(spark, sf, 0)


@query
def house_first_name_intervals(spark, sf):
    """The same from runs of days, of the days that the votes ask for."""
    df = feed(spark, sf, "votes").select("vote_id", "first_name", "last_name", "party", "state", "vote_date")
    intervals = sinks.stored(lookup.validity_intervals(lookup.within_feed(feed(spark, sf, "house"), df)), "intervals")
    return with_status(lookup.fix_house_first_name_by_interval(df, intervals))


@query
def member_intervals(spark, sf):
    """The house table as runs of days."""
    return lookup.validity_intervals(feed(spark, sf, "house"))


@query
def state_map(spark, sf):
    df = lookup.map_state(feed(spark, sf, "members"), feed(spark, sf, "states"))
    return with_status(df).select("member_id", "state", "error_msg", "ptransform")


def _bare_members(spark, sf) -> DataFrame:
    df = scrub.scrub_last_name(scrub.scrub_first_name(feed(spark, sf, "members"), keep_suffix=True))
    return df.withColumn("state", F.regexp_replace("state", "NATION_", "S"))


@query
def new_politicians(spark, sf):
    new = lookup.new_politicians(_bare_members(spark, sf), feed(spark, sf, "politicians"))
    return new.select("member_id", "first_name", "last_name", "party", "state")


@query
def new_politicians_shuffled(spark, sf):
    new = lookup.new_politicians(_bare_members(spark, sf), feed(spark, sf, "politicians"), broadcast_limit=0)
    return new.select("member_id", "first_name", "last_name", "party", "state")


@query
def new_politicians_by_bitmap(spark, sf):
    """The same; only members who may be stored are shuffled."""
    new = membership.new_politicians_by_bitmap(_bare_members(spark, sf), feed(spark, sf, "politicians"))
    return new.select("member_id", "first_name", "last_name", "party", "state")


@query
def house_rows_before(spark, sf):
    return lookup.house_before(feed(spark, sf, "house"), "1998-06-01")


@query
def bill_url_carry(spark, sf):
    calls = extract.house_vote_documents(documents(spark, sf, "house_votes"))
    index = extract.house_roll_index(documents(spark, sf, "roll_index"), F.col("year"), RUN_DATE)
    index = sinks.stored(index.select("vote_url", "bill_url"), "roll-index")
    return crawl.carry_bill_url(calls, index).select("doc_id", "bill_id", "bill_url")


@query
def house_votes_amended(spark, sf):
    index = extract.house_roll_index(documents(spark, sf, "roll_index"), F.col("year"), RUN_DATE)
    votes = crawl.house_votes(documents(spark, sf, "house_votes"), index,
                              documents(spark, sf, "amendments"))
    return with_status(votes).drop("url")


# ---- projections -----------------------------------------------------------------------------

@query
def filter_keys(spark, sf):
    return project.filter_keys(feed(spark, sf, "members"), TABLES["politicians"])


@query
def normalize_sponsors(spark, sf):
    df = project.normalize(feed(spark, sf, "bills"), project.SPONSOR)
    return with_status(df).select("bill_key", "first_name", "last_name", "party", "state",
                                  "sponsor_ln", "sponsor_state", "ptransform", "error_msg")


@query
def revert_sponsors(spark, sf):
    df = project.revert(project.normalize(feed(spark, sf, "bills"), project.SPONSOR), project.SPONSOR)
    return with_status(df).select("bill_key", "sponsor_fn", "sponsor_ln", "sponsor_party", "sponsor_state",
                                  "ptransform")


@query
def add_date(spark, sf):
    return project.add_date(feed(spark, sf, "members"), RUN_DATE).select("member_id", "date")


@query
def add_constants(spark, sf):
    df = project.add_constants(feed(spark, sf, "members"), chamber="SN", chamber_state="US")
    return df.select("member_id", "chamber", "chamber_state")


@query
def make_strings(spark, sf):
    return project.make_strings(feed(spark, sf, "bills").drop("bill_title"))


@query
def csv_row(spark, sf):
    df = feed(spark, sf, "bills")
    columns = (*FEEDS["bill_info"], "error_msg", "ptransform", "script")
    return df.select("bill_key", project.csv_row(df, columns).alias("line"))


@query
def title_concat(spark, sf):
    subtitle = F.when(F.col("bill_key") % 5 != 0, F.col("subtitle"))
    return feed(spark, sf, "raw_bills").select(
        "bill_key", project.titled(F.col("raw_title"), subtitle).alias("bill_title"))


# ---- messages and tables ---------------------------------------------------------------------

def _event_messages(spark, sf) -> DataFrame:
    """Votes as messages; events of one type carry none."""
    df = messages.to_messages(feed(spark, sf, "votes"), "A vote.")
    return df.withColumn("attributes", F.when(
        F.col("attributes")["amdt_id"] != "SAMDT7", F.col("attributes")))


@query
def isolate_attrs(spark, sf):
    keys = ("vote_id", "bill_id", "amdt_id", "vote_cast", "absent")
    return with_status(messages.isolate_attributes(_event_messages(spark, sf), keys))


@query
def build_message(spark, sf):
    df = messages.to_messages(feed(spark, sf, "bills"), "A bill.")
    a = F.col("attributes")
    return df.select(F.col("data").cast("string").alias("data"), a["bill_key"].alias("bill_key"),
                     a["sponsor_fn"].alias("sponsor_fn"), a["sponsor_state"].alias("sponsor_state"),
                     F.size(F.map_keys(a)).alias("n_attributes"))


@query
def format_attributes(spark, sf):
    df = messages.to_messages(feed(spark, sf, "cosponsors").withColumnRenamed("bill_key", "topic_name"))
    kept = sinks.topic_values(F.col("attributes"))
    return df.select(F.col("attributes")["topic_name"].alias("topic_name"),
                     joined(F.map_keys(kept)).alias("header"), joined(F.map_values(kept)).alias("line"))


@query
def dimension_text(spark, sf):
    return tables.dimension(feed(spark, sf, "politicians"))


@query
def name_listing(spark, sf):
    return tables.name_listing(feed(spark, sf, "politicians"))


@query
def document_scan(spark, sf):
    """Landed documents, read back."""
    path = shared_dir(spark, "documents")
    read(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url", F.col("html").alias("body")).write.parquet(path)
    return landed_documents.read_documents(spark, path)


@query
def document_files(spark, sf):
    """One document per file: the pages of a host and day of the id's last digits in one file."""
    path = shared_dir(spark, "document-files")
    pages = read(spark, sf, "pages").select((F.col("page_id") % 40).alias("file"), F.col("page_id").cast("string").alias("value"))
    pages.repartition(4, "file").sortWithinPartitions("file", F.col("value").cast("bigint")).write.partitionBy("file").text(path)
    found = landed_documents.read_document_files(spark, path)
    return found.select(F.regexp_extract("url", r"file=(\d+)", 1).cast("bigint").alias("file"), "body")


@query
def landed_votes(spark, sf):
    """Votes landed as CSV and read back, with a line break and spaces in a value."""
    path = shared_dir(spark, "landing")
    df = feed(spark, sf, "votes").withColumn("last_name", F.concat(F.lit(" "), "last_name", F.lit("\nx ")))
    csv_feeds.land_feed(df, "bill_votes", path)
    return with_status(csv_feeds.read_feed(spark, path, "bill_votes"))


@query
def landed_votes_split(spark, sf):
    """The same votes in one file, which is split."""
    path = shared_dir(spark, "landing")
    df = feed(spark, sf, "votes").withColumn("last_name", F.concat(F.lit(" "), "last_name", F.lit("\nx ")))
    csv_feeds.land_feed(df.coalesce(1), "bill_votes", path)
    return with_status(csv_feeds.read_split_feed(spark, path, "bill_votes"))


@query
def landed_senate(spark, sf):
    path = shared_dir(spark, "landing")
    csv_feeds.land_feed(feed(spark, sf, "members"), "senate_members", path)
    return with_status(csv_feeds.read_feed(spark, path, "senate_members"))


@query
def landed_layouts(spark, sf):
    """Members of both layouts in one folder."""
    path = shared_dir(spark, "landing")
    members = feed(spark, sf, "members")
    csv_feeds.land_feed(members.filter("member_id % 2 = 0"), "house_members", f"{path}/plain")
    dated = members.filter("member_id % 2 = 1").withColumn("date", F.lit("2018-10-20"))
    csv_feeds.land_feed(dated, "house_members_dated", f"{path}/dated")
    return with_status(csv_feeds.read_members(spark, f"{path}/*"))


@query
def votes_date_errors(spark, sf):
    """Votes whose date cannot be read, with the text they had."""
    votes = _votes(spark, sf).withColumn("vote_date", F.when(
        F.col("bill_id").endswith("7"), F.concat(F.lit("on "), "vote_date")).otherwise(F.col("vote_date")))
    votes = votes.withColumns({"vote_cast": F.lit("1"), "first_name": F.lit("Kim")})
    failed = feeds.votes_feed(votes, dims(spark, sf, "house")).errors
    return sinks.error_record(failed, TABLES["all_votes"])


@query
def decoded_references(spark, sf):
    """Names with references by name and number, decoded once."""
    text = F.concat(F.lit("O&#8217;"), "p_name", F.lit(" &#x27;x&#x27; Vel&aacute;z &#38;lt; &amp;amp; &rsquo; &none; A&B"))
    return read(spark, sf, "part").select("p_partkey", markup.unescape(text).alias("name"))


@query
def split_lines(spark, sf):
    """Cosponsor lines, some with a field too few or too many, and quoted commas."""
    df = feed(spark, sf, "cosponsors").withColumn("cosponsor_ln", F.concat(
        F.lit('"'), F.coalesce("cosponsor_ln", F.lit("")), F.lit(', x"')))
    line = project.csv_row(df, FEEDS["cosponsors"])
    n = F.col("bill_key")
    line = F.concat(n.cast("string"), F.lit(","), line,
                    F.when(n % 10 == 3, F.lit(",extra")).otherwise(F.lit("")))
    line = F.when(n % 10 == 4, F.concat(n.cast("string"), F.lit(",short"))).otherwise(line)
    parsed = csv_feeds.split_lines(df.select("bill_key", line.alias("line")), F.col("line"), "cosponsors",
                                   keep=("bill_key",))
    status = with_status(parsed)
    fields = [F.when(F.col("ptransform").isNull(), F.col(c)).alias(c) for c in FEEDS["cosponsors"]]
    return status.select("bill_key", *fields, "ptransform")


@query
def landed_bills(spark, sf):
    """A feed landed as CSV and read back: quotes, commas and empty fields."""
    path = shared_dir(spark, "landing")
    csv_feeds.land_feed(feed(spark, sf, "bills"), "bill_info", path)
    return with_status(csv_feeds.read_feed(spark, path, "bill_info"))


@query
def landed_index(spark, sf):
    """Landed bills with their running number, by bill number as text."""
    path = shared_dir(spark, "landing")
    csv_feeds.land_feed(feed(spark, sf, "bills"), "bill_info", path, order_by=("bill_id",))
    landed = spark.read.schema(csv_schema("bill_info")).option("header", True).option("escape", '"').csv(path)
    return landed.select(F.col("idx").cast("bigint").alias("idx"), "bill_id")


@query
def landed_members(spark, sf):
    """Members landed as text without commas and accents, one index per row, then loaded."""
    path = shared_dir(spark, "landing")
    df = scrub.drop_commas_everywhere(scrub.transliterate_texts(feed(spark, sf, "members")))
    csv_feeds.land_feed(df, "house_members", path)
    layout = csv_feeds.house_feed_name(spark, path)
    d = dims(spark, sf, "states")
    clean, _ = errors.split_errors(feeds.resolve_house(csv_feeds.read_feed(spark, path, layout), d), layout)
    return feeds.house_rows(clean, RUN_DATE)


@query
def landed_roster(spark, sf):
    """Roster documents landed as a feed and read back."""
    path = shared_dir(spark, "landing")
    roster = extract.house_roster(documents(spark, sf, "house_roster"), RUN_DATE)
    crawl.land(roster, "house_members_dated", path, shared_dir(spark, "errors"))
    return with_status(csv_feeds.read_feed(spark, path, csv_feeds.house_feed_name(spark, path)))


@query
def append_table(spark, sf):
    """Two appends to a table that exists already."""
    path = shared_dir(spark, "house")
    name = "house_" + path.rsplit("-", 1)[1]
    spark.catalog.createTable(name, path=path, source="parquet", schema=feed(spark, sf, "house").schema)
    tables.append_to_table(feed(spark, sf, "house"), name)
    tables.append_to_table(feed(spark, sf, "members"), name)
    return spark.table(name)


@query
def load_repeated(spark, sf):
    """Members loaded twice under one load and once under another; the politicians that the tables show."""
    path = shared_dir(spark, "load")
    suffix = path.rsplit("-", 1)[1]
    made = {name: f"{name}_{suffix}" for name in ("house", "politicians")}
    for name, columns in (("house", TABLES["house"]), ("politicians", TABLES["politicians"])):
        fields = ", ".join(f"{c} {'DATE' if c == 'date' else 'STRING'}" for c in columns)
        spark.sql(f"CREATE TABLE {made[name]} ({fields}, run_id STRING, batch_id BIGINT) USING parquet "
                  f"PARTITIONED BY (run_id, batch_id) LOCATION '{path}/tables/{name}'")
    members = feed(spark, sf, "members").drop("member_id")
    known = tables.read_published(spark, made["politicians"], f"{path}/published")
    for load, party in (("first", "D"), ("first", "D"), ("second", "R")):
        feeds.load_feed_once("house_members", members.filter(F.col("party") == party), feeds.Dimensions(
            nicknames=feed(spark, sf, "nicknames"), states=feed(spark, sf, "states"), politicians=known), load, path, f"{path}/errors",
            RUN_DATE, targets=made)
    return tables.read_published(spark, made["house"], f"{path}/published").drop("batch_id")


@query
def error_csv(spark, sf):
    path = shared_dir(spark, "errors")
    failed = feeds.cosponsors_feed(feed(spark, sf, "cosponsors"), dims(spark, sf)).errors
    sinks.write_error_csv(failed, TABLES["bill_cosponsors"], path)
    return spark.read.option("header", True).option("escape", '"').csv(path)


# ---- documents -------------------------------------------------------------------------------

@query
def page_title(spark, sf):
    df = read(spark, sf, "pages").select(
        "page_id", markup.own_text(markup.block(F.col("html"), "h1")).alias("title"))
    return markup.unescape_columns(df, "title")


@query
def page_links(spark, sf):
    df = read(spark, sf, "pages")
    return df.select("page_id", F.posexplode(markup.links(F.col("html"))).alias("pos", "link"))


@query
def page_text_nodes(spark, sf):
    nodes = markup.text_nodes(markup.block(F.col("html"), "nav"))
    return read(spark, sf, "pages").select("page_id", F.posexplode(nodes).alias("pos", "node"))


@query
def senate_roster_xml(spark, sf):
    return with_status(extract.senate_roster(documents(spark, sf, "senate_roster")))


@query
def senate_votes_xml(spark, sf):
    return with_status(extract.senate_votes(documents(spark, sf, "senate_votes"))).drop("url")


@query
def house_votes_xml(spark, sf):
    calls = extract.house_vote_documents(documents(spark, sf, "house_votes"))
    return with_status(extract.house_vote_rows(calls)).drop("url")


@query
def house_roster_html(spark, sf):
    return with_status(extract.house_roster(documents(spark, sf, "house_roster"), RUN_DATE))


@query
def house_roll_index_html(spark, sf):
    index = extract.house_roll_index(documents(spark, sf, "roll_index"), F.col("year"), "1998-06-01")
    return with_status(index)


@query
def roll_index_links_html(spark, sf):
    docs = read(spark, sf, "pages").select(
        F.col("page_id").alias("doc_id"), "url", F.regexp_replace("html", 'href="/t', 'href="ROLL_').alias("body"))
    return with_status(extract.roll_index_links(docs))


@query
def senate_vote_menu_html(spark, sf):
    menu = extract.senate_vote_menu(documents(spark, sf, "vote_menu"), F.col("year"), "1998-06-01")
    return with_status(menu).drop("url")


@query
def senate_xml_edition(spark, sf):
    docs = read(spark, sf, "pages").select(F.col("page_id").alias("doc_id"), "url", F.concat(
        F.lit('<span style="float: right"><a href="/xml/vote_'), F.col("page_id").cast("string"),
        F.lit('.xml">XML</a></span>'), "html").alias("body"))
    return with_status(extract.xml_edition(docs))


@query
def bill_search_html(spark, sf):
    return with_status(extract.bill_search(documents(spark, sf, "bill_search"))).drop("url")


@query
def bill_search_next_page(spark, sf):
    return extract.next_page(documents(spark, sf, "bill_search")).drop("url")


@query
def bill_details_html(spark, sf):
    return with_status(extract.bill_details(documents(spark, sf, "bill_pages"))).drop("url")


@query
def cosponsors_html(spark, sf):
    return with_status(extract.cosponsors(documents(spark, sf, "cosponsor_pages"))).drop("url")


@query
def amendment_listing_html(spark, sf):
    return with_status(extract.amendment_listing(documents(spark, sf, "amendments")))


@query
def house_roster_nested(spark, sf):
    """The same pages with tables in tables and end tags left out; so are those of the queries below."""
    return with_status(extract.house_roster(nested_documents(spark, sf, "house_roster"), RUN_DATE))


@query
def house_roll_index_nested(spark, sf):
    pages = nested_documents(spark, sf, "roll_index")
    return with_status(extract.house_roll_index(pages, F.col("year"), "1998-06-01"))


@query
def senate_vote_menu_nested(spark, sf):
    pages = nested_documents(spark, sf, "vote_menu")
    return with_status(extract.senate_vote_menu(pages, F.col("year"), "1998-06-01")).drop("url")


@query
def bill_search_nested(spark, sf):
    return with_status(extract.bill_search(nested_documents(spark, sf, "bill_search"))).drop("url")


@query
def bill_details_nested(spark, sf):
    return with_status(extract.bill_details(nested_documents(spark, sf, "bill_pages"))).drop("url")


@query
def cosponsors_nested(spark, sf):
    return with_status(extract.cosponsors(nested_documents(spark, sf, "cosponsor_pages"))).drop("url")


@query
def amendment_listing_nested(spark, sf):
    return with_status(extract.amendment_listing(nested_documents(spark, sf, "amendments")))


# ---- feeds -----------------------------------------------------------------------------------

def _votes(spark, sf) -> DataFrame:
    return feed(spark, sf, "votes").drop("vote_id")


@query
def votes_clean(spark, sf):
    return feeds.votes_feed(_votes(spark, sf), dims(spark, sf, "house")).clean


@query
def votes_errors(spark, sf):
    failed = feeds.votes_feed(_votes(spark, sf), dims(spark, sf, "house")).errors
    return sinks.error_record(failed, TABLES["all_votes"])


@query
def bills_clean(spark, sf):
    return feeds.bills_feed(feed(spark, sf, "bills"), dims(spark, sf)).clean


@query
def bills_errors(spark, sf):
    failed = feeds.bills_feed(feed(spark, sf, "bills"), dims(spark, sf)).errors
    return sinks.error_record(failed, TABLES["bill_info"])


@query
def cosponsors_clean(spark, sf):
    return feeds.cosponsors_feed(feed(spark, sf, "cosponsors"), dims(spark, sf)).clean


@query
def cosponsors_errors(spark, sf):
    failed = feeds.cosponsors_feed(feed(spark, sf, "cosponsors"), dims(spark, sf)).errors
    return sinks.error_record(failed, TABLES["bill_cosponsors"])


def _house_branches(spark, sf, **options) -> errors.Branches:
    resolved = feeds.resolve_house(feed(spark, sf, "members"), dims(spark, sf, "states"), **options)
    return errors.split_errors(resolved, "house_members")


@query
def house_clean(spark, sf):
    return feeds.house_rows(_house_branches(spark, sf).clean, RUN_DATE)


@query
def house_new(spark, sf):
    return feeds.new_rows(_house_branches(spark, sf).clean, dims(spark, sf, "politicians"))


@query
def house_errors(spark, sf):
    return sinks.error_record(_house_branches(spark, sf).errors, TABLES["politicians"])


@query
def house_counts(spark, sf):
    """Rows of the house feed, clean ones, and those that each step failed, observed while the feed is staged."""
    counts = Observation()
    feeds.outputs("house_members", feed(spark, sf, "members").drop("member_id"), dims(spark, sf, "states", "politicians"),
                  RUN_DATE, counts=counts)
    return streams.count_rows(spark, counts).filter("n > 0")


@query
def house_dated_clean(spark, sf):
    """The variant whose feed brings the date; quotes stripped."""
    df = feed(spark, sf, "members").withColumn("date", F.lit("2018-10-23"))
    resolved = feeds.resolve_house(df, dims(spark, sf, "states"), strip_quotes=True)
    return feeds.house_rows(errors.split_errors(resolved, "house_members").clean)


@query
def senate_clean(spark, sf):
    resolved = feeds.resolve_senate(feed(spark, sf, "members"), dims(spark, sf))
    return feeds.senate_rows(errors.split_errors(resolved, "senate_members").clean, RUN_DATE)


@query
def senate_new(spark, sf):
    df = feed(spark, sf, "members").withColumn("state", F.regexp_replace("state", "NATION_", "S"))
    clean, _ = errors.split_errors(feeds.resolve_senate(df, dims(spark, sf)), "senate_members")
    return feeds.new_rows(clean, dims(spark, sf, "politicians"))


def _stored_politicians(spark, sf) -> DataFrame:
    stored = feed(spark, sf, "politicians")
    return stored.withColumn("first_name", F.when(F.col("first_name") == "Joseph", "Joe").otherwise(F.col("first_name")))


@query
def revise_names(spark, sf):
    stored = _stored_politicians(spark, sf)
    path = shared_dir(spark, "politicians")
    tables.rewrite_table(tables.revise_names(stored, feed(spark, sf, "nicknames")), path)
    return spark.read.parquet(path)


@query
def revise_names_touched(spark, sf):
    """The same in a table of buckets, of which those with a nickname are written."""
    path = shared_dir(spark, "politicians")
    versions.create_table(_stored_politicians(spark, sf), path, ["id"], 64)
    versions.update_touched(spark, path, lambda rows: tables.revise_names(rows, feed(spark, sf, "nicknames")))
    return versions.read_version(spark, path)


# ---- streams ---------------------------------------------------------------------------------

def _run(spark, sf, name: str, source: DataFrame, wanted: tuple[str, ...], root: str,
         absent: bool = False, stored: dict[str, str] | None = None, counted: bool = False) -> None:
    """Land a feed as messages, then run its stream to the end. ``absent`` leaves NULLs out of the
    messages instead of sending them as text."""
    landed = shared_dir(spark, "messages")
    sent = messages.to_messages(source)
    if absent:
        sent = sent.withColumn("attributes", F.map_filter("attributes", lambda _, v: v != "None"))
    sent.write.parquet(landed)
    stream = streams.message_records(messages.read_message_stream(spark, landed), FEEDS[name])
    streams.stream_feed(stream, name, lambda: dims(spark, sf, *wanted), root,
                        shared_dir(spark, "checkpoint"), RUN_DATE, tables=stored, counted=counted).awaitTermination()


@query
def stream_votes_clean(spark, sf):
    root = shared_dir(spark, "stream")
    _run(spark, sf, "bill_votes", _votes(spark, sf), ("house",), root)
    return spark.read.parquet(f"{root}/all_votes").drop(streams.RUN, streams.BATCH)


@query
def stream_cosponsors_errors(spark, sf):
    root = shared_dir(spark, "stream")
    _run(spark, sf, "cosponsors", feed(spark, sf, "cosponsors").drop("bill_key"), (), root,
         absent=True)
    return spark.read.option("header", True).option("escape", '"').csv(f"{root}/errors").drop(streams.RUN, streams.BATCH)


@query
def stream_cosponsors_counts(spark, sf):
    """What each step failed, summed over the batches of a stream."""
    root = shared_dir(spark, "stream")
    _run(spark, sf, "cosponsors", feed(spark, sf, "cosponsors").drop("bill_key"), (), root, absent=True, counted=True)
    return spark.read.parquet(f"{root}/counts").groupBy("step").agg(F.sum("n").alias("n")).filter("n > 0")


@query
def stream_house_new(spark, sf):
    root = shared_dir(spark, "stream")
    _run(spark, sf, "house_members", feed(spark, sf, "members").drop("member_id"),
         ("states", "politicians"), root)
    return spark.read.parquet(f"{root}/politicians").drop(streams.RUN, streams.BATCH)


@query
def stream_redelivered(spark, sf):
    """Members whose messages arrive twice, in batches of their own, with a restart before the second delivery."""
    landed, root, checkpoint = (shared_dir(spark, name) for name in ("messages", "stream", "checkpoint"))
    members = feed(spark, sf, "members").withColumns({
        messages.MESSAGE_ID: F.col("member_id"), messages.PUBLISHED: F.concat(F.lit("2018-10-23 10:"), F.lpad((F.col("member_id") % 60).cast("string"), 2, "0"), F.lit(":00"))})
    for _ in range(2):
        messages.to_messages(members.drop("member_id")).write.mode("append").parquet(landed)
        stream = messages.first_deliveries(messages.read_message_stream(spark, landed, files_per_batch=1))
        streams.stream_feed(streams.message_records(stream, FEEDS["house_members"]), "house_members",
                            lambda: dims(spark, sf, "states", "politicians"), root, checkpoint, RUN_DATE).awaitTermination()
    return spark.read.parquet(f"{root}/house").drop(streams.RUN, streams.BATCH)


@query
def stream_bills_clean(spark, sf):
    root = shared_dir(spark, "stream")
    _run(spark, sf, "bill_info", feed(spark, sf, "bills").drop("bill_key"), (), root, absent=True)
    return spark.read.parquet(f"{root}/bill_info").drop(streams.RUN, streams.BATCH)


@query
def stream_senate_clean(spark, sf):
    root = shared_dir(spark, "stream")
    _run(spark, sf, "senate_members", feed(spark, sf, "members").drop("member_id"), ("politicians",), root)
    return spark.read.parquet(f"{root}/senate").drop(streams.RUN, streams.BATCH)


@query
def stream_stored_senate(spark, sf):
    """Two runs append to one catalog table, a batch load after them; the table has the rows of all."""
    path, root = shared_dir(spark, "senate"), shared_dir(spark, "stream")
    name = "senate_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (first_name STRING, last_name STRING, party STRING, state STRING, date DATE, "
              f"run_id STRING, batch_id BIGINT) USING parquet PARTITIONED BY (run_id, batch_id) LOCATION '{path}'")
    members = feed(spark, sf, "members").filter("member_id % 3 < 2").drop("member_id")
    for party in ("D", "R"):
        _run(spark, sf, "senate_members", members.filter(F.col("party") == party), ("politicians",), root, stored={"senate": name})
    rest = feed(spark, sf, "members").filter("member_id % 3 = 2").drop("member_id")
    resolved = feeds.resolve_senate(rest, dims(spark, sf))
    tables.append_to_table(feeds.senate_rows(errors.split_errors(resolved, "senate_members").clean, RUN_DATE), name)
    return spark.table(name).drop(streams.RUN, streams.BATCH)


@query
def stream_csv_cosponsors(spark, sf):
    """Landed CSV files as a stream; empty fields are empty text, so only broken rows would fail."""
    landed, root = shared_dir(spark, "landing"), shared_dir(spark, "stream")
    csv_feeds.land_feed(feed(spark, sf, "cosponsors"), "cosponsors", landed)
    streams.stream_feed(csv_feeds.read_feed_stream(spark, landed, "cosponsors"), "cosponsors",
                        lambda: dims(spark, sf), root, shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(f"{root}/bill_cosponsors").drop(streams.RUN, streams.BATCH)


@query
def stream_error_topics(spark, sf):
    """Failed cosponsors and bills as messages of one stream; the files of the cosponsor topic."""
    landed, root = shared_dir(spark, "messages"), shared_dir(spark, "topics")
    d = dims(spark, sf)
    columns = (*TABLES["bill_cosponsors"], "error_msg", "ptransform", "script")
    failed = feeds.cosponsors_feed(feed(spark, sf, "cosponsors"), d).errors
    cosponsor = sinks.error_record(failed, TABLES["bill_cosponsors"])
    bill = sinks.error_record(feeds.bills_feed(feed(spark, sf, "bills"), d).errors, TABLES["bill_info"])
    for topic, rows in (("cosponsors", cosponsor), ("bill_info", bill)):
        messages.to_messages(rows.withColumn("topic_name", F.lit(topic))).write.mode("append").parquet(landed)
    streams.stream_errors(
        messages.read_message_stream(spark, landed),
        {"cosponsors": columns, "bill_info": (*TABLES["bill_info"], "error_msg", "ptransform", "script")},
        root, shared_dir(spark, "checkpoint")).awaitTermination()
    return spark.read.option("header", True).option("escape", '"').csv(f"{root}/cosponsors").drop(streams.RUN, streams.BATCH)
