"""Lookups: decisions by number of matches, and the same rows on both physical ways."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from rostrum_testing import rows, shuffled_rows
from rostrum.operators import errors, lookup, membership
from rostrum.session import shared_dir

LIMITS = [lookup.BROADCAST_LIMIT, 0]


@pytest.fixture(scope="module")
def nicknames(spark):
    return spark.createDataFrame(
        [("Joe", "Joseph"), ("Al", "Albert"), ("Al", "Alan"), (None, "Nobody")], "nickname string, full_name string")


@pytest.fixture(scope="module")
def crowded(spark):
    """A third of the rows with one name, a third with none, the others all different; in copies."""
    first = F.when(F.col("id") % 3 == 0, "Joe").when(F.col("id") % 3 == 1, F.concat(F.lit("n"), "id"))
    return spark.range(0, 9000, 1, 6).select(
        first.alias("first_name"), F.lit("L").alias("last_name"), F.lit("R").alias("party"),
        F.when(F.col("id") % 2 == 0, "MA").otherwise("FL").alias("state"))


@pytest.mark.parametrize("limit", LIMITS)
def test_nickname(spark, nicknames, limit):
    df = spark.createDataFrame([("Joe",), ("Al",), ("Kim",), (None,)], "first_name string")
    found = lookup.fix_nickname(df, nicknames, True, limit)
    assert rows(found, "first_name", "nickname") == sorted(
        [("Joseph", "Joe"), ("Al", None), ("Kim", None), (None, None)], key=repr)
    first = lookup.first_nickname(df, nicknames, limit)
    assert rows(first, "first_name", "nickname") == sorted(
        [("Joseph", "Joe"), ("Alan", "Al"), ("Kim", None), (None, None)], key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_states(spark, limit):
    states = spark.createDataFrame([("Ohio", "OH"), ("Iowa", "IA"), ("Iowa", "IO")], "state string, initials string")
    df = spark.createDataFrame([("Ohio",), ("Iowa",), ("Utah",), (None,)], "state string")
    found = lookup.map_state(df, states, limit)
    assert rows(found, "state", F.size("errors")) == sorted(
        [("OH", 0), ("Iowa", 1), ("Utah", 1), (None, 1)], key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_house_first_name(spark, limit):
    house = spark.createDataFrame(
        [("Ann", "Lee", "R", "MA", "2018-10-01"), ("Bob", "Ray", "D", "FL", "2018-10-01"),
         ("Bo", "Ray", "D", "FL", "2018-10-01")],
        "first_name string, last_name string, party string, state string, date string"
    ).withColumn("date", F.col("date").cast("date"))
    df = spark.createDataFrame(
        [("", "Lee", "R", "MA", "2018-10-01"), ("None", "Ray", "D", "FL", "2018-10-01"),
         (None, "Lee", "R", "MA", "2018-10-02"), ("Kim", "Ray", "D", "FL", "2018-10-01"),
         ("", "Lee", "R", "MA", "no date")],
        "first_name string, last_name string, party string, state string, vote_date string")
    found = lookup.fix_house_first_name(df, house, limit)
    status = found.select("first_name", errors.deciding_error()["error_msg"].alias("m"))
    assert rows(status) == sorted([
        ("Ann", None),
        ("None", "There are multiple politicians with that name active on that day."),
        (None, "There are no politicians with that name active on that day."),
        ("Kim", None),
        ("", "There are no politicians with that name active on that day."),
    ], key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_new_politicians(spark, limit):
    known = spark.createDataFrame([("A", "B", "R", "MA"), ("A", "B", "R", "MA"), (None, "C", "R", "MA")],
                                  "first_name string, last_name string, party string, state string")
    df = spark.createDataFrame([("A", "B", "R", "MA"), ("A", "B", "D", "MA"), ("A", "B", "D", "MA"),
                                (None, "C", "R", "MA")],
                               "first_name string, last_name string, party string, state string")
    new = lookup.new_politicians(df, known, broadcast_limit=limit)
    assert rows(new) == sorted([("A", "B", "D", "MA")] * 2 + [(None, "C", "R", "MA")], key=repr)
    assert lookup.new_politicians(df, known, dedupe=True, broadcast_limit=limit).count() == 2


def test_crowded_keys_same_rows(spark, crowded, nicknames):
    small = lookup.fix_nickname(crowded, nicknames, True)
    spread = lookup.fix_nickname(crowded, nicknames, True, broadcast_limit=0)
    assert spread.count() == crowded.count()
    assert small.exceptAll(spread).count() == 0 and spread.exceptAll(small).count() == 0


def test_crowded_keys_anti_join(spark, crowded):
    known = spark.createDataFrame([("Joe", "L", "R", "MA")], "first_name string, last_name string, party string, state string")
    small = lookup.new_politicians(crowded, known)
    spread = lookup.new_politicians(crowded, known, broadcast_limit=0)
    assert 0 < spread.count() < crowded.count()
    assert small.exceptAll(spread).count() == 0 and spread.exceptAll(small).count() == 0


def test_null_keys_are_spread(spark, crowded):
    left, _ = lookup._spread_nulls(crowded, crowded.select("first_name").distinct(), ["first_name"])
    pieces = left.filter("first_name is null").groupBy(lookup._SALT).count()
    assert pieces.count() > 1 and left.filter("first_name is not null").select(lookup._SALT).distinct().count() == 1


def test_shuffled_lookup_reads_the_feed_once(spark, crowded, nicknames):
    """Chained lookups without broadcast: one scan of the feed, one of each dimension or two."""
    path = shared_dir(spark, "feed")
    crowded.write.parquet(path)
    df = spark.read.parquet(path)
    known = spark.createDataFrame([("Joe", "L", "R", "MA")], "first_name string, last_name string, party string, state string")
    df = lookup.fix_nickname(df, nicknames, True, broadcast_limit=0)
    df = lookup.new_politicians(df, known, broadcast_limit=0)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


@pytest.mark.parametrize("limit", LIMITS)
def test_attach(spark, limit):
    other = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", "2"), (None, "3")], "k string, v string")
    df = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "x string")
    found = lookup.attach(df, other, {"k": "x"}, "v", "w", "step", limit)
    assert rows(found, "x", "w", F.size("errors")) == sorted(
        [("a", "1", 0), ("b", None, 1), ("c", None, 0), (None, None, 0)], key=repr)


@pytest.mark.parametrize("limit", LIMITS)
def test_attach_counts_equal_rows_once(spark, limit):
    df = spark.createDataFrame([(k,) for k in (1, 2, 3, 4, 5, None)], "k int")
    pairs = [(1, None), (1, None), (2, None), (2, "a"), (3, "a"), (3, "a"), (4, "a"), (4, "b"), (None, "c")]
    found = lookup.attach(df, spark.createDataFrame(pairs, "x int, v string"), {"x": "k"}, "v", "w", "step", limit)
    assert rows(found.select("k", "w", F.size("errors"))) == sorted(
        [(1, None, 0), (2, None, 1), (3, "a", 0), (4, None, 1), (5, None, 0), (None, None, 0)], key=repr)


def test_attach_aggregates_the_other_table_once(spark):
    df = spark.createDataFrame([(1,)], "k int")
    other = spark.createDataFrame([(1, "a"), (1, "a")], "x int, v string")
    plan = lookup.attach(df, other, {"x": "k"}, "v", "w", "step", 0)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 1


def test_size_is_measured(spark, nicknames, crowded):
    assert lookup.measured_bytes(nicknames) < 1000
    assert not lookup.fits_broadcast(crowded, 10_000)
    plan = lookup.fix_nickname(crowded, nicknames, broadcast_limit=0)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "BroadcastNestedLoop" not in plan


def test_dates_before_yesterday(spark):
    house = spark.sql("SELECT date'2018-10-01' AS date UNION ALL SELECT date'2018-10-02'")
    assert lookup.house_before(house, "2018-10-03").count() == 1


def test_intervals_say_what_days_say(spark, tmp_path):
    """Gaps, members of one name, repeated rows, missing names and dates, runs over buckets, both ways to join."""
    import random
    from datetime import date, timedelta

    rng = random.Random(2)
    start = date(2018, 1, 1)
    house = [(f"F{k}", f"L{k % 3}", "D", "MA" if k < 5 else None, start + timedelta(d)) for k in range(6) for d in range(200) if rng.random() < 0.97 and not 80 <= d - k < 90]
    house += [r for r in house if r[4].day == 7] + [(None, "L1", "D", "MA", start), ("F9", "L1", "D", "MA", None)]
    house = spark.createDataFrame(house, "first_name string, last_name string, party string, state string, date date").repartition(3)
    votes = [(rng.choice(("", "None", None, "Kim")), f"L{rng.randrange(4)}", rng.choice("DR"), rng.choice(("MA", None)), str(start + timedelta(rng.randrange(-5, 210)))) for _ in range(400)]
    votes = spark.createDataFrame([*votes, ("", "L1", "D", "MA", "no day")], "first_name string, last_name string, party string, state string, vote_date string")
    want = rows(lookup.fix_house_first_name(votes, house))
    intervals = lookup.validity_intervals(lookup.within_feed(house, votes)).cache()
    assert intervals.count() * 4 < house.count()
    for limit in (lookup.BROADCAST_LIMIT, 0):
        assert rows(lookup.fix_house_first_name_by_interval(votes, intervals, limit)) == want
    # the feed's days prune the stored table's partitions
    house.write.partitionBy("date").parquet(str(tmp_path / "house"))
    few = votes.filter(F.col("vote_date").between("2018-02-01", "2018-02-03"))
    pruned = lookup.within_feed(spark.read.schema(house.schema).parquet(str(tmp_path / "house")), few)
    assert "PartitionFilters: [isnotnull(date" in pruned._jdf.queryExecution().executedPlan().toString()
    assert 0 < pruned.select(F.input_file_name().alias("f")).distinct().count() <= 9
    assert lookup.within_feed(house, votes.limit(0)).count() == 0


def test_bitmap_spares_the_shuffle(spark, crowded):
    """Mostly new people: the same rows as by the anti-join alone, a fraction of them shuffled."""
    path = shared_dir(spark, "people")
    crowded.write.parquet(path)
    people = spark.read.parquet(path)
    known = people.filter("first_name = 'Joe' or length(first_name) = 2").select(*lookup.PERSON) \
        .unionByName(people.filter("first_name is null").select(*lookup.PERSON).limit(3))
    plain = lookup.new_politicians(people, known, broadcast_limit=0)
    new = membership.new_politicians_by_bitmap(people, known)
    assert rows(new) == rows(plain) and 0 < new.count() < people.count()
    others = people.filter("first_name is null or first_name <> 'Joe'")
    limits = [f"spark.sql.{part}autoBroadcastJoinThreshold" for part in ("", "adaptive.")]
    for limit in limits:  # as if the stored table were too large for Spark to broadcast by itself
        spark.conf.set(limit, "-1")
    before = shuffled_rows(lookup.new_politicians(others, known, broadcast_limit=0))
    after = shuffled_rows(membership.new_politicians_by_bitmap(others, known))
    for limit in limits:
        spark.conf.unset(limit)
    assert before >= others.count() and after < before / 3


def test_bitmap_of_any_size_gives_the_same_rows(spark):
    schema = "first_name string, last_name string, party string, state string"
    known = spark.createDataFrame([(f"n{i}", "L", "R", "MA") for i in range(3000)] + [(None, "L", "R", "MA")], schema)
    people = spark.createDataFrame([(f"n{i}", "L", "R", "MA") for i in range(2990, 3500)] + [(None, "L", "R", "MA")] * 2, schema)
    expected = rows(lookup.new_politicians(people, known))
    for limit in (0, 64 << 20):  # one part whatever the limit: nearly a tenth of its bits are set
        found = membership.membership(known, lookup.PERSON, limit=limit)
        assert found.bits == (membership.PART_BITS if limit == 0 else 2 * membership.PART_BITS)
        assert 0.02 < membership.error_rate(found) < 0.1
        assert rows(membership.not_stored(people, known, lookup.PERSON, found)) == expected
    marked = membership.maybe_known(people, found, "maybe")
    assert marked.filter("maybe and first_name is null").count() == 0
    assert marked.filter("not maybe and first_name < 'n3000'").count() == 0
    assert rows(membership.not_stored(people, known.limit(0), lookup.PERSON)) == rows(people)
    assert membership.not_stored(people.limit(0), known, lookup.PERSON).count() == 0
    with pytest.raises(ValueError):
        membership.not_stored(people.withColumn("party", F.lit(1)), known, lookup.PERSON)
