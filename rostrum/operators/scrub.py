"""Name scrubbing on DataFrames.

Every step names its input once, so a whole scrub is one nested expression in one projection. That
keeps the generated method of a feed small: the JIT compiler skips methods of more than 8,000 bytes
of code, which then run an order of magnitude slower.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostrum.functions import names
from rostrum.functions.text import drop_commas, transliterate
from rostrum.operators import errors

_WORK = "scrub__"


def scrub_column(df: DataFrame, column: str, suffix: str, strip_quotes: bool = False) -> DataFrame:
    """Replace ``column`` by the bare name and add the suffix it held as ``suffix``."""
    unquoted = names.without_quoted(names.without_initial(F.col(column)), strip_quotes)
    return df.withColumns({suffix: names.suffix_of(unquoted), column: names.bare_name(unquoted)})


def scrub_first_name(df: DataFrame, keep_suffix: bool = False, strip_quotes: bool = False) -> DataFrame:
    missing = F.col("first_name").isNull()
    df = errors.flag(df, missing, "missing value: first_name", errors.FIRST_NAME)
    df = scrub_column(df, "first_name", _WORK + "suffix", strip_quotes)
    if keep_suffix:
        df = df.withColumn("suffix", F.col(_WORK + "suffix"))
    return df.drop(_WORK + "suffix")


def scrub_last_name(df: DataFrame, keep_suffix: bool = True, strip_quotes: bool = False) -> DataFrame:
    """With ``keep_suffix`` the suffix of the first name wins over the one of the last name."""
    missing = F.col("last_name").isNull()
    df = errors.flag(df, missing, "missing value: last_name", errors.LAST_NAME)
    df = scrub_column(df, "last_name", _WORK + "suffix", strip_quotes)
    if keep_suffix:
        found = F.col(_WORK + "suffix")
        earlier = F.col("suffix") if "suffix" in df.columns else F.lit(None).cast("string")
        df = df.withColumn("suffix", F.coalesce(earlier, found))
    return df.drop(_WORK + "suffix")


def transliterate_texts(df: DataFrame) -> DataFrame:
    """Latin script to ASCII in every text column, as done when a feed is landed."""
    return df.select(*[
        transliterate(F.col(field.name)).alias(field.name)
        if field.dataType.typeName() == "string" else F.col(field.name)
        for field in df.schema.fields
    ])


def drop_commas_everywhere(df: DataFrame) -> DataFrame:
    return df.select(*[
        drop_commas(F.col(field.name)).alias(field.name)
        if field.dataType.typeName() == "string" else F.col(field.name)
        for field in df.schema.fields
    ])
