"""Projections: allow-lists, renames, constants and text forms of a row."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rostrum.functions.casts import date_column, none_to_null, to_int
from rostrum.operators import errors
from rostrum.schemas import TYPES

# Sponsor and cosponsor columns and their common names, in order.
SPONSOR = {"sponsor_fn": "first_name", "sponsor_ln": "last_name",
           "sponsor_party": "party", "sponsor_state": "state"}
COSPONSOR = {"cosponsor_fn": "first_name", "cosponsor_ln": "last_name",
             "cosponsor_party": "party", "cosponsor_state": "state"}

RAW = "raw__"
MOVED = "moved__"


def filter_keys(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly these columns, in this order; absent ones are NULL."""
    present = set(df.columns)
    return df.select(*[
        F.col(name) if name in present else F.lit(None).cast(TYPES.get(name, "string")).alias(name)
        for name in columns
    ])


def _move(df: DataFrame, names: Mapping[str, str], step: str) -> DataFrame:
    """Rename column by column as long as the values are there. At the first missing value the row
    keeps the rest under the old names and is flagged.

    How far a row got is kept in a column: a later move back needs no look at the values, which by
    then are the result of long expressions.
    """
    df = errors.with_errors(df)
    present, count = set(df.columns), len(names)
    if MOVED in present:
        moved = F.col(MOVED)
    else:
        moved = F.lit(count)
        for i, source in reversed(list(enumerate(names))):
            moved = F.when(F.col(source).isNull(), F.lit(i)).otherwise(moved)
        df = df.withColumn(MOVED, moved)
        moved = F.col(MOVED)
    columns = {}
    for i, (source, target) in enumerate(names.items()):
        old = F.col(target) if target in present else F.lit(None).cast("string")
        # a row that stopped at the first column has nothing there to move
        columns[target] = F.col(source) if i == 0 and target not in present else \
            F.when(moved > i, F.col(source)).otherwise(old)
        columns[source] = F.when(moved <= i, F.col(source))
    missing = F.get(F.array(*[F.lit(source) for source in names]), moved)
    columns[errors.ERRORS] = errors.added(
        moved < count, F.concat(F.lit("missing value: "), missing), step)
    return df.withColumns(columns)


def normalize(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Person columns under their common names."""
    return _move(df.drop(MOVED), names, errors.NORMALIZE)


def revert(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """The inverse of :func:`normalize`."""
    return _move(df, {target: source for source, target in names.items()}, errors.REVERT).drop(MOVED)


def add_date(df: DataFrame, run_date: date | str | None = None) -> DataFrame:
    today = F.current_date() if run_date is None else F.lit(str(run_date)).cast("date")
    return df.withColumn("date", today)


def add_constants(df: DataFrame, **values) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def make_strings(df: DataFrame) -> DataFrame:
    """Every column as text; NULL becomes ``None``."""
    return df.select(*[
        F.coalesce(F.col(name).cast("string"), F.lit("None")).alias(name) for name in df.columns
    ])


def csv_row(df: DataFrame, columns: Sequence[str]) -> Column:
    """Values in list order joined by commas; absent and NULL are empty."""
    present = set(df.columns)
    return F.concat_ws(",", *[
        F.coalesce(F.col(name).cast("string"), F.lit("")) if name in present else F.lit("")
        for name in columns
    ])


def titled(title: Column, subtitle: Column) -> Column:
    return F.concat(title, F.coalesce(subtitle, F.lit("")))


def fix_none(df: DataFrame) -> DataFrame:
    """The text ``None`` is NULL, in every text column."""
    return df.select(*[
        none_to_null(F.col(field.name)).alias(field.name)
        if field.dataType.typeName() == "string" else F.col(field.name)
        for field in df.schema.fields
    ])


def fix_types(df: DataFrame, int_columns: Sequence[str]) -> DataFrame:
    """Integer columns; a text that is no integer flags the row, and its text is kept aside for the
    error branch (:func:`restore_raw`)."""
    for name in int_columns:
        df = errors.with_errors(df).withColumns({RAW + name: F.col(name).cast("string"),
                                                 name: to_int(F.col(name).cast("string"))})
        text = F.coalesce(F.col(RAW + name), F.lit("None"))
        df = errors.flag(
            df, F.col(name).isNull(),
            F.concat(F.lit("invalid literal for int() with base 10: '"), text, F.lit("'")), errors.TYPES)
    return df


def parse_dates(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Date columns, their texts kept aside; what cannot be read is NULL until :func:`flag_dates`."""
    return df.withColumns({
        **{RAW + name: F.col(name).cast("string") for name in date_columns},
        **{name: date_column(df, name) for name in date_columns}})


def flag_dates(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Flags parsed dates whose text is no date. Missing dates are NULL."""
    for name in date_columns:
        raw = F.col(RAW + name)
        df = errors.flag(df, F.col(name).isNull() & ~(raw.isNull() | raw.isin("", "None")),
                         F.concat(F.lit("invalid date: '"), raw, F.lit("'")), errors.TYPES)
    return df


def fix_dates(df: DataFrame, date_columns: Sequence[str]) -> DataFrame:
    """Date columns; a text that is no date flags the row and is kept aside like a bad integer."""
    return flag_dates(parse_dates(df, date_columns), date_columns)


def restore_raw(df: DataFrame) -> DataFrame:
    kept = [name for name in df.columns if name.startswith(RAW)]
    return df.withColumns({name[len(RAW):]: F.col(name) for name in kept}).drop(*kept)


def drop_raw(df: DataFrame) -> DataFrame:
    return df.drop(*[name for name in df.columns if name.startswith(RAW)])
