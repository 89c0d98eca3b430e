"""From landed documents to landed feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.operators import errors, extract, lookup, scrub
from rostrum.operators.lookup import BROADCAST_LIMIT
from rostrum.schemas import FEEDS
from rostrum.sources.feeds import land_feed
from rostrum.sources.sinks import stage, staged_branches, stored, write_error_csv


ROSTERS = ("house_members", "house_members_dated", "senate_members")


def land(extracted: DataFrame, feed: str, path: str, error_path: str) -> None:
    """Land the rows of extracted documents as a feed, in ASCII, and their error rows as an error
    file. Rosters lose their commas, as their feeds have never had any."""
    clean, failed = staged_branches(stage(extracted, feed), feed)
    texts = clean.select(*[F.col(c).cast("string").alias(c) for c in clean.columns if c in FEEDS[feed]])
    texts = scrub.transliterate_texts(texts)
    if feed in ROSTERS:
        texts = scrub.drop_commas_everywhere(texts)
    land_feed(texts, feed, path)
    write_error_csv(failed, ("doc_id", "url", *FEEDS[feed]), f"{error_path}/{feed}")


def carry_bill_url(votes: DataFrame, index: DataFrame,
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Roll calls inherit the bill address from the index row that links to them."""
    return lookup.attach(votes, index, {"vote_url": "url"}, "bill_url", "bill_url", "carry_bill_url", broadcast_limit)


def resolve_amendments(votes: DataFrame, listing: DataFrame,
                       broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """The n-th amendment listed for the bill, for roll calls that give a number."""
    votes = lookup.attach(votes, listing, {"bill_url": "bill_url", "ordinal": "amdt_num"},
                          "amdt_id", "amdt_id", "resolve_amendments", broadcast_limit)
    unknown = F.col("amdt_num").isNotNull() & F.col("amdt_id").isNull() & ~errors.has_errors()
    return errors.flag(votes, unknown, "amendment is not listed", "resolve_amendments")


def house_votes(documents: DataFrame, index: DataFrame, listings: DataFrame,
                broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """House votes with amendment ids, from roll calls, the extracted index and amendment pages.

    The joins run on roll calls, hundreds of times fewer than votes; the votes are exploded last.
    What is extracted from the other pages is stored first, since it is read more than once.
    """
    index = stored(index.select("vote_url", "bill_url"), "roll-index")
    listing = extract.amendment_listing(listings)
    listing = stored(errors.clean_rows(listing), "amendments")
    calls = carry_bill_url(extract.house_vote_documents(documents), index, broadcast_limit)
    calls = resolve_amendments(calls, listing, broadcast_limit)
    return extract.house_vote_rows(calls)
