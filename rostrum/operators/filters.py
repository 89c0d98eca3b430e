"""Row predicates of the crawls."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def recent(day: Column, run_date: date | str, mode: str = "through") -> Column:
    """Days up to yesterday (``through``), or yesterday alone (``only``)."""
    yesterday = F.date_sub(F.lit(str(run_date)).cast("date"), 1)
    return day == yesterday if mode == "only" else day <= yesterday


def is_state_table(caption_id: Column) -> Column:
    return F.contains(caption_id, F.lit("state"))


def without_header(rows: Column) -> Column:
    return F.when(F.size(rows) > 1, F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(1)))) \
        .otherwise(F.slice(rows, 1, 0))
