"""Column sets of the feeds, the stored tables and the error record."""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
INDEX = "idx"

# Field order of the landed feeds, after the leading index field.
FEEDS: dict[str, tuple[str, ...]] = {
    "bill_votes": (
        "bill_id", "amdt_id", "first_name", "last_name", "party", "state",
        "vote_cast", "vote_date", "chamber", "chamber_state",
    ),
    "bill_info": (
        "bill_id", "amdt_id", "bill_title", "bill_summary",
        "sponsor_fn", "sponsor_ln", "sponsor_party", "sponsor_state", "bill_url",
    ),
    "cosponsors": (
        "bill_id", "amdt_id", "cosponsor_fn", "cosponsor_ln", "cosponsor_party", "cosponsor_state",
    ),
    "house_members": ("first_name", "last_name", "party", "state", "district"),
    "house_members_dated": ("first_name", "last_name", "party", "state", "district", "date"),
    "senate_members": ("first_name", "last_name", "party", "state"),
}

# Columns of the stored tables; everything is text but the types named below.
TABLES: dict[str, tuple[str, ...]] = {
    "all_votes": (
        "bill_id", "amdt_id", "first_name", "last_name", "party", "state",
        "vote_cast", "vote_date", "chamber",
    ),
    "bill_info": FEEDS["bill_info"],
    "bill_cosponsors": ("bill_id", "amdt_id", "first_name", "last_name", "party", "state"),
    "politicians": ("first_name", "last_name", "party", "state", "suffix", "nickname"),
    "house": ("first_name", "last_name", "party", "state", "district", "date"),
    "senate": ("first_name", "last_name", "party", "state", "date"),
    "nicknames": ("nickname", "full_name"),
    "state_map": ("state", "initials"),
}
TYPES: dict[str, T.DataType] = {
    "vote_cast": T.IntegerType(),
    "vote_date": T.DateType(),
    "date": T.DateType(),
}
ERROR_COLUMNS = ("error_msg", "ptransform", "script")

MESSAGE = T.StructType([
    T.StructField("data", T.BinaryType()),
    T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
])
DOCUMENT = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("body", T.StringType()),
])


def text_schema(names) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def csv_schema(feed: str) -> T.StructType:
    """The feed as it lies in a CSV file: index first, unparsable line last."""
    return text_schema((INDEX, *FEEDS[feed], CORRUPT))


def table_schema(table: str) -> T.StructType:
    return T.StructType([
        T.StructField(name, TYPES.get(name, T.StringType())) for name in TABLES[table]
    ])
