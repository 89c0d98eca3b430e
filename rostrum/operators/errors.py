"""Row-level errors: a failing row carries on, and the last failure names it."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ERRORS = "errors"
#: Names of the observed counts of all rows and of those without an error.
ROWS, CLEAN = "rows", "clean"
_TYPE = "array<struct<error_msg:string,ptransform:string>>"

# Step names recorded in the error branch.
SPLIT = "SplitFn"
ISOLATE = "IsolateAttrFn"
TYPES = "FixTypesFn"
FIRST_NAME = "ScrubFnameFn"
LAST_NAME = "ScrubLnameFn"
HOUSE_NAME = "FixHouseFirstNameFn"
STATE = "StateMapFn"
NORMALIZE = "NormalizeAttributesFn"
REVERT = "RevertAttributesFn"
STEPS = (SPLIT, ISOLATE, TYPES, FIRST_NAME, LAST_NAME, HOUSE_NAME, STATE, NORMALIZE, REVERT)


class Branches(NamedTuple):
    clean: DataFrame
    errors: DataFrame


def with_errors(df: DataFrame) -> DataFrame:
    """Start with no errors, unless the source has recorded some."""
    if ERRORS in df.columns:
        return df
    return df.withColumn(ERRORS, F.array().cast(_TYPE))


def added(condition: Column, message: Column | str, step: str) -> Column:
    """The error list of a row after one more check.

    The list so far is named once only, so that a chain of checks stays one flat ``concat`` when
    Spark merges it or pushes a filter on it down.
    """
    text = F.lit(message) if isinstance(message, str) else message
    entry = F.array(F.struct(text.cast("string").alias("error_msg"), F.lit(step).alias("ptransform")))
    none = F.array().cast(_TYPE)
    return F.concat(F.col(ERRORS), F.when(condition, entry).otherwise(none))


def flag(df: DataFrame, condition: Column, message: Column | str, step: str) -> DataFrame:
    return with_errors(df).withColumn(ERRORS, added(condition, message, step))


def has_errors() -> Column:
    return F.size(ERRORS) > 0


def deciding_error() -> Column:
    """The last error; but a line that could not be split stays a split error, because what later
    steps say about it is about fields it never had."""
    first, last = F.get(ERRORS, F.lit(0)), F.try_element_at(F.col(ERRORS), F.lit(-1))
    return F.when(first["ptransform"] == SPLIT, first).otherwise(last)


def clean_rows(df: DataFrame) -> DataFrame:
    return with_errors(df).filter(~has_errors()).drop(ERRORS)


def error_rows(df: DataFrame, script: str) -> DataFrame:
    failed = with_errors(df).filter(has_errors())
    return failed.withColumns({
        "error_msg": deciding_error()["error_msg"],
        "ptransform": deciding_error()["ptransform"],
        "script": F.lit(script),
    }).drop(ERRORS)


def split_errors(df: DataFrame, script: str) -> Branches:
    return Branches(clean_rows(df), error_rows(df, script))


def observed(df: DataFrame, counts: Observation) -> DataFrame:
    """Count rows, clean rows and the rows that each step fails while ``df`` is written or read for the first time.

    A row counts for its deciding error, so the counts are those of the error branch; ``other`` counts errors of steps
    that are not among ``STEPS``. The counts travel with the tasks' results: no pass of their own, nothing shuffled.
    """
    df = with_errors(df)
    step = deciding_error()["ptransform"]
    return df.observe(
        counts, F.count(F.lit(1)).alias(ROWS), F.count_if(~has_errors()).alias(CLEAN),
        *[F.count_if(step == name).alias(name) for name in STEPS],
        F.count_if(has_errors() & ~F.coalesce(step.isin(*STEPS), F.lit(False))).alias("other"))
