"""Casts, null handling and recodes that never throw."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Recorded vote texts. The House list also takes the Yea/Nay spelling.
SENATE_VOTES = {"Yea": 1, "Nay": 0}
HOUSE_VOTES = {"Aye": 1, "Yea": 1, "No": 0, "Nay": 0}

# Date layouts of the source documents, as Spark patterns.
SENATE_VOTE_DATE = "MMMM d, yyyy, h:mm a"
HOUSE_VOTE_DATE = "d-MMM-yyyy"
SENATE_MENU_DATE = "MMM d, yyyy"
HOUSE_INDEX_DATE = "d-MMM, yyyy"
INTRODUCED_DATE = "M/d/yyyy"


def to_int(c: Column) -> Column:
    """NULL where Python's ``int()`` would fail on the text.

    Texts of another form never reach the cast: a failing cast costs an exception per row.
    """
    return F.when(c.rlike(r"^\s*[+-]?[0-9]+\s*$"), c.try_cast("int"))


def to_date(c: Column) -> Column:
    """ISO dates; NULL for other text."""
    return F.when(c.rlike(r"^\s*\d{4}-\d{1,2}-\d{1,2}"), c.try_cast("date"))


def none_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit("None"))


def date_column(df: DataFrame, name: str) -> Column:
    """A column as dates, whether the table stores dates or their text."""
    c = F.col(name)
    return to_date(c) if df.schema[name].dataType.typeName() == "string" else c.cast("date")


def recode_vote(c: Column, votes: Mapping[str, int]) -> Column:
    yes = [text for text, value in votes.items() if value == 1]
    no = [text for text, value in votes.items() if value == 0]
    return F.when(c.isin(yes), F.lit(1)).when(c.isin(no), F.lit(0)).cast("int")


# What text of each layout looks like: other text never reaches the parser, where it costs an exception.
_FORMS = {
    SENATE_VOTE_DATE: r"^[A-Za-z]{3,9} \d{1,2}, \d{4}, \d{1,2}:\d{2} [AaPp][Mm]$",
    HOUSE_VOTE_DATE: r"^\d{1,2}-[A-Za-z]{3}-\d{4}$",
    SENATE_MENU_DATE: r"^[A-Za-z]{3} \d{1,2}, \d{4}$",
    HOUSE_INDEX_DATE: r"^\d{1,2}-[A-Za-z]{3}, \d{4}$",
    INTRODUCED_DATE: r"^\d{1,2}/\d{1,2}/\d{4}$",
}


def parse_date(c: Column, layout: str) -> Column:
    """NULL for text that does not fit; runs of whitespace count as one space.

    Most texts fit as they are; only texts with unusual white space are rewritten first.
    """
    def read(text: Column) -> Column:
        return F.try_to_date(F.regexp_substr(text, F.lit(_FORMS[layout])), layout)

    spaced = F.when(c.rlike(r"\s\s|[^\S ]|^ | $"), F.regexp_replace(F.btrim(c), r"\s+", " ")).otherwise(c)
    return read(spaced)


def parse_day_in_year(c: Column, year: Column, layout: str) -> Column:
    """Dates whose source leaves the year out: ``Dec 5`` or ``5-Dec``."""
    return parse_date(F.concat(F.btrim(c), F.lit(", "), year.cast("string")), layout)


def introduced_date(c: Column) -> Column:
    return parse_date(F.regexp_extract(c, r"^\s*\(Introduced (\d{1,2}/\d{1,2}/\d{4})\)\s*$", 1),
                      INTRODUCED_DATE)


def single_int(values: Column) -> Column:
    """The integer in a list of exactly one text; NULL for no text."""
    return F.when(F.size(values) == 1, to_int(F.get(values, F.lit(0))))
