"""The five feeds, from split records to a clean and an error branch.

``resolve_*`` return every input row with its error list; ``*_feed`` split them. All of them take
plain DataFrames, so batch and micro-batch runs share them.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date
from urllib.parse import quote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from rostrum.functions.casts import date_column
from rostrum.operators import lookup, project, scrub
from rostrum.operators.errors import Branches, observed, split_errors, with_errors
from rostrum.operators.lookup import BROADCAST_LIMIT
from rostrum.schemas import TABLES
from rostrum.sources.feeds import CSV_WRITE
from rostrum.sources.sinks import error_record, stage, staged_branches, write_error_csv
from rostrum.sources.tables import append_to_table, is_published, path_exists, publish, read_dimension, write_batch_rows


@dataclass(frozen=True)
class Dimensions:
    """The stored tables a feed looks things up in; each feed needs some of them."""

    nicknames: DataFrame
    house: DataFrame | None = None
    states: DataFrame | None = None
    politicians: DataFrame | None = None
    broadcast_limit: int = BROADCAST_LIMIT


def read_dimensions(spark: SparkSession, feed: str, run_date: date | str | None = None,
                    broadcast_limit: int = BROADCAST_LIMIT) -> Dimensions:
    """What a feed needs from the session catalog. With a run date, votes see the house rows before
    yesterday only, as a batch load does; the filter reaches the scan."""
    table, members = TARGETS[feed][0], ("house", "senate")
    house = spark.table("house") if table == "all_votes" else None
    if house is not None and run_date is not None:
        house = lookup.house_before(house, run_date)
    return Dimensions(
        nicknames=read_dimension(spark, "nicknames"),
        house=house,
        states=read_dimension(spark, "state_map") if table == "house" else None,
        politicians=read_dimension(spark, "politicians") if table in members else None,
        broadcast_limit=broadcast_limit,
    )


# ---- resolving -------------------------------------------------------------------------------

def resolve_votes(df: DataFrame, dims: Dimensions) -> DataFrame:
    # dates are parsed once, for the lookup and the table; what is no date is flagged last
    df = project.parse_dates(project.fix_types(with_errors(df), ["vote_cast"]), ["vote_date"])
    df = lookup.fix_house_first_name(df, dims.house, dims.broadcast_limit)
    df = scrub.scrub_first_name(df)
    df = lookup.fix_nickname(df, dims.nicknames, broadcast_limit=dims.broadcast_limit)
    df = scrub.scrub_last_name(df, keep_suffix=False)
    return project.fix_none(project.flag_dates(df, ["vote_date"]))


def resolve_bills(df: DataFrame, dims: Dimensions) -> DataFrame:
    df = project.normalize(df, project.SPONSOR)
    df = scrub.scrub_first_name(df)
    df = lookup.fix_nickname(df, dims.nicknames, broadcast_limit=dims.broadcast_limit)
    df = scrub.scrub_last_name(df, keep_suffix=False)
    df = project.revert(df, project.SPONSOR)
    return project.fix_none(df)


def resolve_cosponsors(df: DataFrame, dims: Dimensions) -> DataFrame:
    df = project.normalize(df, project.COSPONSOR)
    df = scrub.scrub_first_name(df)
    df = lookup.fix_nickname(df, dims.nicknames, broadcast_limit=dims.broadcast_limit)
    df = scrub.scrub_last_name(df, keep_suffix=False)
    return project.fix_none(df)


def _resolve_members(df: DataFrame, dims: Dimensions, states: bool, keep_last_suffix: bool,
                     strip_quotes: bool) -> DataFrame:
    df = scrub.scrub_first_name(with_errors(df), keep_suffix=True, strip_quotes=strip_quotes)
    df = lookup.fix_nickname(df, dims.nicknames, True, dims.broadcast_limit)
    df = scrub.scrub_last_name(df, keep_last_suffix, strip_quotes)
    if states:
        df = lookup.map_state(df, dims.states, dims.broadcast_limit)
    if "date" in df.columns:
        df = project.fix_dates(df, ["date"])
    return project.fix_none(df)


def resolve_house(df: DataFrame, dims: Dimensions, keep_last_suffix: bool = True,
                  strip_quotes: bool = False) -> DataFrame:
    return _resolve_members(df, dims, True, keep_last_suffix, strip_quotes)


def resolve_senate(df: DataFrame, dims: Dimensions, keep_last_suffix: bool = True) -> DataFrame:
    return _resolve_members(df, dims, False, keep_last_suffix, False)


# ---- branches --------------------------------------------------------------------------------

def votes_feed(df: DataFrame, dims: Dimensions, script: str = "bill_votes") -> Branches:
    clean, failed = split_errors(resolve_votes(df, dims), script)
    return Branches(project.filter_keys(clean, TABLES["all_votes"]), failed)


def bills_feed(df: DataFrame, dims: Dimensions, script: str = "bill_info") -> Branches:
    clean, failed = split_errors(resolve_bills(df, dims), script)
    return Branches(project.filter_keys(clean, TABLES["bill_info"]), failed)


def cosponsors_feed(df: DataFrame, dims: Dimensions, script: str = "cosponsors") -> Branches:
    clean, failed = split_errors(resolve_cosponsors(df, dims), script)
    return Branches(project.filter_keys(clean, TABLES["bill_cosponsors"]), failed)


def new_rows(clean: DataFrame, dims: Dimensions) -> DataFrame:
    """The fork to the politicians table."""
    new = lookup.new_politicians(clean, dims.politicians, broadcast_limit=dims.broadcast_limit)
    return project.filter_keys(new, TABLES["politicians"])


def house_rows(clean: DataFrame, run_date: date | str | None = None) -> DataFrame:
    """The fork to the house table. A row that brings its date keeps it."""
    if "date" in clean.columns:
        own = project.add_date(clean.withColumn("own_date", date_column(clean, "date")), run_date)
        dated = own.withColumn("date", F.coalesce("own_date", F.col("date").cast("date"))).drop("own_date")
    else:
        dated = project.add_date(clean, run_date)
    return project.filter_keys(dated, TABLES["house"])


def senate_rows(clean: DataFrame, run_date: date | str | None = None) -> DataFrame:
    return project.filter_keys(project.add_date(clean, run_date), TABLES["senate"])


# ---- loading ---------------------------------------------------------------------------------

# Feed -> (target table, columns of its error file).
TARGETS = {
    "bill_votes": ("all_votes", TABLES["all_votes"]),
    "bill_info": ("bill_info", TABLES["bill_info"]),
    "cosponsors": ("bill_cosponsors", TABLES["bill_cosponsors"]),
    "house_members": ("house", TABLES["politicians"]),
    "house_members_dated": ("house", TABLES["politicians"]),
    "senate_members": ("senate", TABLES["politicians"]),
}
RESOLVERS = {
    "bill_votes": resolve_votes,
    "bill_info": resolve_bills,
    "cosponsors": resolve_cosponsors,
    "house_members": resolve_house,
    "house_members_dated": lambda df, dims: resolve_house(df, dims, strip_quotes=True),
    "senate_members": resolve_senate,
}


def outputs(feed: str, df: DataFrame, dims: Dimensions, run_date: date | str | None = None,
            add_politicians: bool = True, staging: str | None = None,
            counts: Observation | None = None) -> tuple[dict[str, DataFrame], DataFrame]:
    """Everything one feed writes: rows by target table, and the error rows.

    The resolved feed is staged once, since several branches read it. ``counts`` observes that writing.
    """
    resolved = RESOLVERS[feed](df, dims)
    resolved = resolved if counts is None else observed(resolved, counts)
    clean, failed = staged_branches(stage(resolved, feed, staging), feed)
    table, _ = TARGETS[feed]
    if table == "house":
        rows = {table: house_rows(clean, run_date)}
    elif table == "senate":
        rows = {table: senate_rows(clean, run_date)}
    else:
        rows = {table: project.filter_keys(clean, TABLES[table])}
    if add_politicians and table in ("house", "senate"):
        rows["politicians"] = new_rows(clean, dims)
    return rows, failed


def load_feed(feed: str, df: DataFrame, dims: Dimensions, error_path: str,
              run_date: date | str | None = None, add_politicians: bool = True, counts: Observation | None = None) -> None:
    """One batch run: append the clean branches to their tables, write the error file. ``counts`` holds the rows that
    each step failed afterwards."""
    rows, failed = outputs(feed, df, dims, run_date, add_politicians, counts=counts)
    for table, branch in rows.items():
        append_to_table(branch, table)
    write_error_csv(failed, TARGETS[feed][1], f"{error_path}/{feed}")


def load_feed_once(feed: str, df: DataFrame, dims: Dimensions, load_id: str, folder: str, error_path: str,
                   run_date: date | str | None = None, add_politicians: bool = True,
                   targets: Mapping[str, str] | None = None) -> None:
    """A batch run that may fail anywhere and be repeated under its ``load_id``: no row is lost or doubled.

    First every branch is written below ``folder``, once: a repetition takes what is there, so politicians
    that an earlier attempt stored are not taken for known ones. Then each branch replaces the load's own
    partition of its table (partitioned by run and batch, like those of streams) and the load's error files.
    Last, one file in the manifest (``folder/published``) shows the rows of all tables at once to
    readers of ``read_published``. ``targets`` gives tables of other names. A load that is published already does nothing.
    """
    spark = df.sparkSession
    manifest, root = f"{folder}/published", f"{folder}/loads/{feed}/load={quote(load_id, safe='')}"
    if is_published(spark, manifest, load_id):
        return
    table, columns = TARGETS[feed]
    names = [table, "politicians"] if add_politicians and table in ("house", "senate") else [table]
    if not path_exists(spark, f"{root}/prepared/_SUCCESS"):
        rows, failed = outputs(feed, df, dims, run_date, add_politicians)
        for name in names:
            rows[name].write.mode("overwrite").parquet(f"{root}/{name}")
        error_record(failed, columns).write.mode("overwrite").parquet(f"{root}/errors")
        spark.range(1).write.mode("overwrite").parquet(f"{root}/prepared")
    for name in names:
        write_batch_rows(spark.read.parquet(f"{root}/{name}"), (targets or {}).get(name, name), load_id, 0)
    spark.read.parquet(f"{root}/errors").write.mode("overwrite").options(**CSV_WRITE).csv(f"{error_path}/{feed}/load={quote(load_id, safe='')}")
    publish(spark, manifest, load_id)
