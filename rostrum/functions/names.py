"""Parsing of person and bill descriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostrum.functions.text import blank_to_null, strip, strip_ascii, transliterate

# Fixed values. (?d) makes "." stop at \n only, as it does in the source's dialect.
INITIAL = r" [A-Z]\."
LONE_INITIAL = r"(?s)^(?!.* [A-Z]\..* [A-Z]\.)(.*?) [A-Z]\.(.*)$"
INITIAL_ANYWHERE = r"[A-Z]\."
QUOTED = r'(?d) ".*"'
QUOTED_ANYWHERE = r'(?d)".*"'
SUFFIX = r"(?d) (Sr.|Jr.|III|IV)"
SUFFIX_ANYWHERE = r"(?d)(Sr.|Jr.|III|IV)"
PARENTHESIS = r"(?d) \(.*\)"
POLITICIAN = r"^[^ ,]* ([^,]*),([^\[]*)\[([^-\]]*)-([^-\]]*)(?:-[^-\]]*)?\].*$"

_MARK = "\x01"


def without_initial(c: Column) -> Column:
    """Drop a middle initial, unless the name has several. The input should be a plain column: names
    without a dot skip the pattern."""
    return F.when(F.contains(c, F.lit(".")), F.regexp_replace(c, LONE_INITIAL, "$1$2")).otherwise(c)


def without_quoted(c: Column, strip_quotes: bool = False) -> Column:
    out = F.regexp_replace(c, QUOTED, "")
    return F.translate(out, '"', "") if strip_quotes else out


def suffix_of(c: Column) -> Column:
    return blank_to_null(strip(F.regexp_extract(c, SUFFIX, 0)))


def bare_name(c: Column) -> Column:
    """Without suffixes, parentheses and commas."""
    return strip(F.replace(F.regexp_replace(F.regexp_replace(c, SUFFIX, ""), PARENTHESIS, ""), F.lit(","), F.lit("")))


def find_suffix(first: Column, last: Column) -> Column:
    return F.coalesce(
        blank_to_null(F.regexp_extract(first, SUFFIX_ANYWHERE, 0)),
        blank_to_null(F.regexp_extract(last, SUFFIX_ANYWHERE, 0)),
    )


def scrub_name_legacy(c: Column) -> Column:
    """The older scrub of the stored table: transliterates, knows no parentheses, and only looks
    at initials when the name has exactly one."""
    plain = transliterate(c)

    def bare(pattern: str) -> Column:
        return F.translate(F.regexp_replace(F.regexp_replace(plain, pattern, ""), SUFFIX, ""), ",", "")

    lone = F.regexp_count(c, F.lit(INITIAL_ANYWHERE)) == 1
    return strip(
        F.when(lone, F.regexp_replace(bare(QUOTED), INITIAL, "")).otherwise(bare(QUOTED_ANYWHERE))
    )


def split_full_name(c: Column) -> dict[str, Column]:
    """``Last, First`` or ``Last First``; parts after a second comma are dropped."""
    listed = F.when(F.contains(c, F.lit(",")), c).otherwise(F.regexp_replace(c, r"(?s)^([^ ]*) (.*)$", "$1,$2"))
    parts = F.split(listed, ",")
    return {
        "first_name": strip_ascii(F.get(parts, F.lit(1))),
        "last_name": strip_ascii(F.get(parts, F.lit(0))),
    }


def parse_politician(c: Column) -> dict[str, Column]:
    """``Rep. Last, First M. [R-TX-5]``; all NULL when the text has another form."""
    fields = F.split(F.regexp_replace(c, "(?s)" + POLITICIAN, _MARK.join(("$1", "$2", "$3", "$4"))), _MARK)
    whole = F.size(fields) == 4
    return {
        "first_name": F.when(whole, strip(F.get(fields, F.lit(1)))),
        "last_name": F.when(whole, F.get(fields, F.lit(0))),
        "party": F.when(whole, F.get(fields, F.lit(2))),
        "state": F.when(whole, F.get(fields, F.lit(3))),
    }


def parse_bill(c: Column) -> dict[str, Column]:
    """``H.R.5 - Title`` or ``S.Amdt.1 to H.R.5``; all NULL when the text is neither."""
    dashed = F.contains(c, F.lit("-"))
    amends = F.contains(c, F.lit("to"))
    before_dash = F.translate(F.substring_index(c, "-", 1), " .", "")
    after_dash = strip(F.regexp_extract(c, r"(?s)^[^-]*-(.*)$", 1))
    before_to = F.translate(F.substring_index(c, "to", 1), " .", "")
    after_to = F.translate(F.regexp_extract(c, r"(?s)^.*?to(.*)$", 1), " .", "")
    return {
        "bill_id": F.when(dashed, before_dash).when(amends, after_to),
        "amdt_id": F.when(~dashed & amends, before_to),
        "bill_title": F.when(dashed, after_dash).when(amends, c),
    }
