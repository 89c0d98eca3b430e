"""Lookups against dimension tables.

A lookup never changes the number of rows: the dimension is first brought to one row per key with
the number of its matches, and the step decides on that number. Two physical ways give the same
rows:

* the dimension is measured, and broadcast when it is small enough: the feed is not shuffled;
* otherwise both sides are shuffled, each read once. Rows with a NULL key are spread by a salt, and
  adaptive execution splits the partitions of other crowded keys on the feed's side, which a left or
  anti join to one row per key allows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rostrum.functions.casts import date_column
from rostrum.operators import errors

BROADCAST_LIMIT = 64 << 20
MATCHES = "lookup__matches"
FOUND = "lookup__found"
_SALT = "lookup__salt"


def measured_bytes(df: DataFrame) -> int:
    """An upper estimate of the size in memory, from one pass over flat columns, two words each."""
    width = F.lit(16 + 16 * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if field.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
    return int(df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0])


def fits_broadcast(df: DataFrame, limit: int) -> bool:
    return limit > 0 and measured_bytes(df) <= limit


def _spread_nulls(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a NULL key match nothing; they are dealt over all tasks instead of one.

    The salt depends on the task and the row's values, never on the order of arrival, so a task that
    is run again sends every row where it went before.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = [f.name for f in left.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    missing = F.greatest(*[F.col(k).isNull() for k in keys]) if len(keys) > 1 else F.col(keys[0]).isNull()
    salt = F.pmod(F.xxhash64(F.spark_partition_id(), *hashed), F.lit(parts)).cast("int") + 1
    return left.withColumn(_SALT, F.when(missing, salt).otherwise(0)), right.withColumn(_SALT, F.lit(0))


def keyed_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str,
               small: bool) -> DataFrame:
    """Join to ``right``, which has one row per key. ``how`` is ``left`` or ``left_anti``."""
    keys = list(keys)
    if small:
        return left.join(F.broadcast(right), keys, how)
    order = left.columns
    salted_left, salted_right = _spread_nulls(left, right, keys)
    joined = salted_left.join(salted_right, [*keys, _SALT], how)
    extra = [c for c in right.columns if c not in order]
    return joined.select(*order, *(extra if how == "left" else []))


def count_matches(df: DataFrame, dim: DataFrame, on: Mapping[str, Column | str], value: str,
                  broadcast_limit: int = BROADCAST_LIMIT, once: bool = False) -> DataFrame:
    """Add the number of matches in ``dim``, NULL for none, and the smallest matching ``value``.

    ``on`` maps each key column of ``dim`` to a column of ``df``. NULL keys match nothing. ``once``: equal
    matches count once, and any number of different ones as two, so the same aggregation finds them.
    """
    temp = {f"lookup__key{i}": (F.col(c) if isinstance(c, str) else c, key)
            for i, (key, c) in enumerate(on.items())}
    narrow = dim.select(*[F.col(key).alias(name) for name, (_, key) in temp.items()],
                        F.col(value).alias(FOUND)).dropna(subset=list(temp))
    small = fits_broadcast(narrow, broadcast_limit)
    matches = F.count(F.lit(1))
    if once:
        alike = F.min(FOUND).eqNullSafe(F.max(FOUND)) & F.count(FOUND).isin(0, matches)
        matches = F.when(alike, 1).otherwise(2).cast("bigint")
    single = narrow.groupBy(*temp).agg(matches.alias(MATCHES), F.min(FOUND).alias(FOUND))
    with_keys = df.withColumns({name: c for name, (c, _) in temp.items()})
    return keyed_join(with_keys, single, list(temp), "left", small).drop(*temp)


def _sole() -> Column:
    return F.col(MATCHES).eqNullSafe(F.lit(1))


def _done(df: DataFrame) -> DataFrame:
    return df.drop(MATCHES, FOUND)


def fix_nickname(df: DataFrame, nicknames: DataFrame, keep_nickname: bool = False,
                 broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A first name listed exactly once as a nickname becomes the full name."""
    df = count_matches(df, nicknames, {"nickname": "first_name"}, "full_name", broadcast_limit)
    sole = _sole()
    columns = {"first_name": F.when(sole, F.col(FOUND)).otherwise(F.col("first_name"))}
    if keep_nickname:
        columns["nickname"] = F.when(sole, F.col("first_name"))
    return _done(df.withColumns(columns))


def first_nickname(df: DataFrame, nicknames: DataFrame,
                   broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """A listed nickname becomes the full name, the smallest one where several are listed."""
    df = count_matches(df, nicknames, {"nickname": "first_name"}, "full_name", broadcast_limit)
    listed = F.col(MATCHES).isNotNull()
    kept = F.col("nickname") if "nickname" in df.columns else F.lit(None).cast("string")
    return _done(df.withColumns({
        "first_name": F.when(listed, F.col(FOUND)).otherwise(F.col("first_name")),
        "nickname": F.when(listed, F.col("first_name")).otherwise(kept),
    }))


def fix_house_first_name(df: DataFrame, house: DataFrame,
                         broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Fill a missing first name from the one member with that last name, party and state listed on
    the day of the vote."""
    missing = F.col("first_name").isNull() | F.col("first_name").isin("", "None")
    # rows that have a first name get a NULL key: they match nothing and are spread like any row
    house = house.withColumn("date", date_column(house, "date"))
    df = count_matches(df, house, {
        "last_name": F.when(missing, F.col("last_name")),
        "party": "party",
        "state": "state",
        "date": date_column(df, "vote_date"),
    }, "first_name", broadcast_limit)
    return _fill_first_name(df, missing)


def _fill_first_name(df: DataFrame, missing: Column) -> DataFrame:
    """Decide on the number of matches of rows whose first name is missing."""
    # Messages of the error branch.
    message = (
        F.when(F.col(MATCHES) > 1,
               F.lit("There are multiple politicians with that name active on that day."))
        .otherwise(F.lit("There are no politicians with that name active on that day."))
    )
    df = errors.flag(df, missing & ~_sole(), message, errors.HOUSE_NAME)
    filled = F.when(missing & _sole(), F.col(FOUND)).otherwise(F.col("first_name"))
    return _done(df.withColumn("first_name", filled))


# ---- validity intervals ----------------------------------------------------------------------

MEMBER = ("last_name", "party", "state")
#: Days per bucket of the interval lookup: an interval is filed once per bucket that it touches.
BUCKET_DAYS = 64


def validity_intervals(house: DataFrame) -> DataFrame:
    """``first_name, last_name, party, state, copies, from_date, to_date``: the house table's rows of a member per
    day as runs of days, on each of which the member has ``copies`` rows.

    Two shuffles: days are counted, then numbered within their member and count; the difference of day and
    number is the same throughout a run. Rows without a name, party, state or date can match nothing and are left out.
    """
    member = ["first_name", *MEMBER]
    rows = house.select(*member, date_column(house, "date").alias("date")).dropna(subset=[*MEMBER, "date"])
    days = rows.groupBy(*member, "date").agg(F.count(F.lit(1)).alias("copies"))
    nth = F.row_number().over(Window.partitionBy(*member, "copies").orderBy("date"))
    runs = days.withColumn("run", F.date_sub("date", nth))
    return runs.groupBy(*member, "copies", "run").agg(F.min("date").alias("from_date"), F.max("date").alias("to_date")).drop("run")


def _bucket(day: Column) -> Column:
    return F.floor(F.unix_date(day) / BUCKET_DAYS).cast("int")


def in_buckets(intervals: DataFrame) -> DataFrame:
    return intervals.withColumn("bucket", F.explode(F.sequence(_bucket(F.col("from_date")), _bucket(F.col("to_date")))))


def filed_intervals(intervals: DataFrame) -> DataFrame:
    """One row per member key and bucket of days, with the intervals that touch the bucket: what a feed's
    row is joined to, so that it stays one row."""
    interval = F.struct("from_date", "to_date", "copies", "first_name")
    return in_buckets(intervals).groupBy(*MEMBER, "bucket").agg(F.collect_list(interval).alias("intervals"))


def within_feed(house: DataFrame, df: DataFrame, day: str = "vote_date") -> DataFrame:
    """The house rows of the days that a feed asks for, from the first to the last: the bounds are
    values, so they reach the scan and leave out files and partitions of other days."""
    first, last = df.agg(F.min(date_column(df, day)), F.max(date_column(df, day))).first()
    days = date_column(house, "date")
    return house.filter(days.between(F.lit(first), F.lit(last)) if first is not None else F.lit(False))


def fix_house_first_name_by_interval(df: DataFrame, intervals: DataFrame,
                                     broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """:func:`fix_house_first_name` from ``validity_intervals``: the same rows and errors from a dimension with a
    row per run of days instead of one per day."""
    missing = F.col("first_name").isNull() | F.col("first_name").isin("", "None")
    day = date_column(df, "vote_date")
    keys = {"lookup__last": F.when(missing, F.col("last_name")), "lookup__party": F.col("party"), "lookup__state": F.col("state"),
            "lookup__bucket": _bucket(day)}
    filed = filed_intervals(intervals)
    filed = filed.select(*[F.col(c).alias(k) for k, c in zip(keys, (*MEMBER, "bucket"))], F.col("intervals").alias("lookup__intervals"))
    small = fits_broadcast(in_buckets(intervals), broadcast_limit)
    joined = keyed_join(df.withColumns({**keys, "lookup__day": day}), filed, list(keys), "left", small)
    valid = F.filter("lookup__intervals", lambda i: F.col("lookup__day").between(i["from_date"], i["to_date"]))
    joined = joined.withColumn("lookup__intervals", valid)
    matches = F.aggregate("lookup__intervals", F.lit(0).cast("bigint"), lambda n, i: n + i["copies"])
    found = F.array_min(F.transform("lookup__intervals", lambda i: i["first_name"]))
    joined = joined.withColumns({MATCHES: F.nullif(matches, F.lit(0)), FOUND: found})
    return _fill_first_name(joined.drop(*keys, "lookup__day", "lookup__intervals"), missing)


def map_state(df: DataFrame, states: DataFrame, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """State names become initials; unknown and ambiguous names are errors."""
    df = count_matches(df, states, {"state": "state"}, "initials", broadcast_limit)
    # Messages of the error branch.
    message = (
        F.when(F.col(MATCHES) > 1,
               F.lit("There are multiple states in the database that match the given state."))
        .otherwise(F.lit("There are no states in the database that match the given state."))
    )
    df = errors.flag(df, ~_sole(), message, errors.STATE)
    mapped = F.when(_sole(), F.col(FOUND)).otherwise(F.col("state"))
    return _done(df.withColumn("state", mapped))


PERSON = ("first_name", "last_name", "party", "state")


def new_politicians(df: DataFrame, known: DataFrame, dedupe: bool = False,
                    broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Rows whose person is not stored yet. Equal new rows all stay, unless ``dedupe``."""
    stored = known.select(*PERSON).dropna()
    small = fits_broadcast(stored, broadcast_limit)
    new = keyed_join(df, stored.distinct(), PERSON, "left_anti", small)
    return new.dropDuplicates(list(PERSON)) if dedupe else new


def house_before(house: DataFrame, run_date: date | str) -> DataFrame:
    """House rows dated before yesterday, the ones a vote load may look at."""
    yesterday = F.date_sub(F.lit(str(run_date)).cast("date"), 1)
    return house.filter(date_column(house, "date") < yesterday)


def attach(df: DataFrame, other: DataFrame, on: Mapping[str, Column | str], value: str, name: str,
           step: str, broadcast_limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Carry one column over from a table; NULL where it has no row for the key, or rows with
    different values, which also flags the row. Equal rows count once."""
    df = count_matches(df, other, on, value, broadcast_limit, once=True)
    df = errors.flag(df, F.col(MATCHES) > 1, f"several values of {value} for one key", step)
    return _done(df.withColumn(name, F.when(_sole(), F.col(FOUND))))
