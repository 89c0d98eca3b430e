"""The feeds end to end on small messages, files and tables."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from rostrum_testing import SF, rows, shuffled_rows
from checks.fixtures import feed as driver_feed
from rostrum.plans import feeds
from rostrum.operators import errors, project
from rostrum.schemas import FEEDS, TABLES, table_schema
from rostrum.session import shared_dir
from rostrum.sources import feeds as csv_feeds
from rostrum.sources import messages, records, sinks, tables, versions


@pytest.fixture(scope="module")
def dims(spark):
    nicknames = spark.createDataFrame([("Joe", "Joseph"), ("Carol", "Caroline")], "nickname string, full_name string")
    return feeds.Dimensions(
        nicknames=nicknames,
        house=spark.createDataFrame([], table_schema("house")),
        states=spark.createDataFrame([("MA", "MA"), ("FL", "FL")], "state string, initials string"),
        politicians=spark.createDataFrame(
            [("Cameron", "Mattheson", "R", "MA", None, None)], table_schema("politicians")))


def sent(spark, feed, *records):
    """Records as messages that carry only the keys they have."""
    df = spark.createDataFrame([(b"x", r) for r in records], "data binary, attributes map<string,string>")
    return messages.isolate_attributes(df, FEEDS[feed])


VOTE = {"bill_id": "S3600", "amdt_id": "None", "first_name": "Joe", "last_name": "Donnelly", "party": "D",
        "state": "IN", "vote_cast": "1", "vote_date": "2018-10-23", "chamber": "HR"}
BILL = {"bill_id": "S1000", "amdt_id": "None", "bill_title": "t", "bill_summary": "s",
        "sponsor_fn": "Caroline M.", "sponsor_ln": "Brantley IV", "sponsor_party": "R", "sponsor_state": "FL",
        "bill_url": "u"}
COSPONSOR = {"bill_id": "S1000", "amdt_id": "None", "cosponsor_fn": "Caroline M.", "cosponsor_ln": "Brantley IV",
             "cosponsor_party": "R", "cosponsor_state": "FL"}
KNOWN = {"first_name": "Cameron", "last_name": "Mattheson", "party": "R", "state": "MA", "district": "1st"}
NEW = {"first_name": "Carol", "last_name": "Brantley IV", "party": "R", "state": "FL", "district": "2nd"}


def without(record, key):
    return {k: v for k, v in record.items() if k != key}


def test_votes(spark, dims):
    bad = {**VOTE, "vote_cast": "None"}
    clean, failed = feeds.votes_feed(sent(spark, "bill_votes", VOTE, bad), dims)
    assert clean.columns == list(TABLES["all_votes"])
    assert rows(clean, "first_name", "amdt_id", "vote_cast", F.col("vote_date").cast("string")) == [
        ("Joseph", None, 1, "2018-10-23")]
    record = sinks.error_record(failed, TABLES["all_votes"])
    assert rows(record, "ptransform", "vote_cast", "script") == [("FixTypesFn", "None", "bill_votes")]


def test_bills(spark, dims):
    clean, failed = feeds.bills_feed(sent(spark, "bill_info", BILL, without(BILL, "sponsor_fn")), dims)
    assert rows(clean, "sponsor_fn", "sponsor_ln", "sponsor_party", "amdt_id") == [("Caroline", "Brantley", "R", None)]
    # the last failing step names the row, and what was not moved is as it was
    record = sinks.error_record(failed, TABLES["bill_info"])
    assert rows(record, "ptransform", "sponsor_ln", "sponsor_state") == [("RevertAttributesFn", "Brantley IV", "FL")]


@pytest.mark.parametrize("key,step", [
    ("cosponsor_party", "NormalizeAttributesFn"), ("cosponsor_state", "NormalizeAttributesFn"),
    ("cosponsor_ln", "ScrubLnameFn"), ("cosponsor_fn", "ScrubLnameFn")])
def test_cosponsors(spark, dims, key, step):
    clean, failed = feeds.cosponsors_feed(sent(spark, "cosponsors", COSPONSOR, without(COSPONSOR, key)), dims)
    assert rows(clean, "first_name", "last_name", "party", "state") == [("Caroline", "Brantley", "R", "FL")]
    assert rows(failed, "ptransform") == [(step,)]


def test_house(spark, dims):
    produced, failed = feeds.outputs("house_members", sent(spark, "house_members", KNOWN, NEW), dims, "2018-10-24")
    assert rows(produced["house"], "first_name", "district", F.col("date").cast("string")) == [
        ("Cameron", "1st", "2018-10-24"), ("Caroline", "2nd", "2018-10-24")]
    assert rows(produced["politicians"]) == [("Caroline", "Brantley", "R", "FL", "IV", "Carol")]
    assert failed.count() == 0


def test_senate(spark, dims):
    produced, _ = feeds.outputs("senate_members", sent(spark, "senate_members", KNOWN, NEW), dims, "2018-10-24")
    assert produced["senate"].count() == 2
    assert rows(produced["politicians"], "first_name", "suffix") == [("Caroline", "IV")]
    alone, _ = feeds.outputs("senate_members", sent(spark, "senate_members", KNOWN), dims, add_politicians=False)
    assert list(alone) == ["senate"]


def test_house_feed_with_date(spark, dims):
    dated = {**KNOWN, "date": "2018-10-20"}
    produced, _ = feeds.outputs("house_members_dated", sent(spark, "house_members_dated", dated), dims, "2018-10-24")
    assert rows(produced["house"], F.col("date").cast("string")) == [("2018-10-20",)]


def test_message_without_attributes(spark, dims):
    df = spark.createDataFrame([(b"x", None)], "data binary, attributes map<string,string>")
    isolated = messages.isolate_attributes(df, FEEDS["cosponsors"])
    assert isolated.select("errors.ptransform").first()[0] == ["IsolateAttrFn"]


@pytest.fixture(scope="module")
def catalog(spark):
    """All stored tables, with one known politician."""
    for table in TABLES:
        spark.catalog.createTable(table, path=shared_dir(spark, table), source="parquet", schema=table_schema(table))
    spark.sql("INSERT INTO politicians VALUES ('Cameron', 'Mattheson', 'R', 'MA', NULL, NULL)")
    spark.sql("INSERT INTO nicknames VALUES ('Joe', 'Joseph')")
    return spark


def lines(spark, header, *body):
    path = shared_dir(spark, "lines")
    spark.createDataFrame([("\n".join([header, *body]),)], "value string").coalesce(1).write.text(path)
    return path


def test_csv_lines(spark, dims):
    path = lines(
        spark, ",first_name,last_name,party,state", "0,Carol,Brantley IV,R,FL", '1,"Joe ""J"" X","A, B",D,MA',
        "2,too,few", "3,Al,B,R,MA,too many", "4,,B,R,MA")
    df = csv_feeds.read_feed(spark, path, "senate_members")
    assert df.filter("size(errors) > 0").count() == 2
    clean, failed = (df.filter("size(errors) = 0"), df.filter("size(errors) > 0"))
    assert rows(clean, "first_name", "last_name") == [
        ("", "B"), ("Carol", "Brantley IV"), ('Joe "J" X', "A, B")]
    # a broken line stays a split error whatever later steps say
    split = feeds.split_errors(feeds.resolve_senate(df, dims), "senate_members")
    assert rows(split.errors, "ptransform") == [("SplitFn",), ("SplitFn",)]
    assert split.clean.count() + split.errors.count() == 5


def test_house_layouts(spark):
    plain = lines(spark, ",first_name,last_name,party,state,district", "0,A,B,R,MA,1st")
    dated = lines(spark, ",first_name,last_name,party,state,district,date", "0,A,B,R,MA,1st,2018-10-20")
    assert csv_feeds.house_feed_name(spark, plain) == "house_members"
    assert csv_feeds.house_feed_name(spark, dated) == "house_members_dated"
    assert csv_feeds.read_feed(spark, dated, "house_members_dated").first().date == "2018-10-20"
    both = csv_feeds.read_members(spark, plain)
    assert rows(both, "first_name", "date", F.size("errors")) == [("A", "", 0)]


def test_landing_round_trip(spark):
    df = spark.createDataFrame([("HR1", 'a "b", c', "x"), ("HR2", None, "")],
                               "bill_id string, bill_title string, extra string")
    path = shared_dir(spark, "landing")
    csv_feeds.land_feed(df, "bill_info", path)
    csv_feeds.land_feed(df, "bill_info", path)  # replaces
    back = csv_feeds.read_feed(spark, path, "bill_info")
    assert rows(back, "bill_id", "bill_title", "bill_url") == [("HR1", 'a "b", c', ""), ("HR2", "", "")]


def test_running_numbers(spark):
    df = spark.range(0, 1000, 1, 7).select(
        F.when(F.col("id") < 400, "same").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        (F.col("id") % 3).alias("v"))
    out = csv_feeds.numbered(df, ["k"]).orderBy("idx").collect()
    assert [r.idx for r in out] == list(range(1000))
    assert [r.k for r in out] == sorted(r.k for r in out)


def test_load_and_append(catalog, dims):
    spark = catalog
    with pytest.raises(ValueError):
        tables.append_to_table(spark.range(1), "no_such_table")
    current = feeds.Dimensions(dims.nicknames, states=dims.states, politicians=spark.table("politicians"))
    feed = sent(spark, "house_members", KNOWN, NEW, {**NEW, "state": "Nowhere"})
    error_path = shared_dir(spark, "errors")
    for _ in range(2):  # the second run finds its politician stored
        feeds.load_feed("house_members", feed, current, error_path, "2018-10-24")
        spark.catalog.refreshTable("politicians")
    assert spark.table("house").count() == 4
    assert spark.table("politicians").count() == 2
    failed = spark.read.option("header", True).csv(f"{error_path}/house_members")
    assert failed.columns == [*TABLES["politicians"], "error_msg", "ptransform", "script"]
    assert rows(failed, "ptransform", "state") == [("StateMapFn", "Nowhere")] * 2


def test_dimensions_from_the_catalog(catalog):
    spark = catalog
    spark.sql("INSERT INTO house VALUES ('Ann', 'Old', 'R', 'MA', '1st', date'2018-10-20')")
    found = feeds.read_dimensions(spark, "bill_votes", "2018-10-26")
    assert found.house is not None and found.politicians is None
    vote = {**VOTE, "first_name": "", "last_name": "Old", "party": "R", "state": "MA", "vote_date": "2018-10-20"}
    clean, _ = feeds.votes_feed(sent(spark, "bill_votes", vote), found)
    assert rows(clean, "first_name") == [("Ann",)]
    # a row is visible from the second day after its date
    visible = [feeds.read_dimensions(spark, "bill_votes", day).house.filter("last_name = 'Old'").count()
               for day in ("2018-10-21", "2018-10-22")]
    assert visible == [0, 1]
    assert feeds.read_dimensions(spark, "senate_members").politicians is not None


def test_error_record_columns(spark):
    df = spark.createDataFrame([("a", None, "m", "p", "s")],
                               "bill_id string, amdt_id string, error_msg string, ptransform string, script string")
    record = sinks.error_record(df, ("bill_id", "amdt_id", "party"))
    assert rows(record) == [("a", "None", "", "m", "p", "s")]


def test_projections(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    assert project.filter_keys(df, ["y", "q", "vote_cast"]).dtypes == [
        ("y", "string"), ("q", "string"), ("vote_cast", "int")]
    assert rows(project.make_strings(df)) == [("a", "None", "1")]
    assert rows(df.select(project.csv_row(df, ["z", "q", "y", "x"]))) == [("1,,,a",)]


def test_revise_names(spark, dims):
    stored = spark.createDataFrame([(1, "Joe", None), (2, "Kim", "K")], "id int, first_name string, nickname string")
    path = shared_dir(spark, "revised")
    tables.rewrite_table(tables.revise_names(stored, dims.nicknames), path)
    assert rows(spark.read.parquet(path)) == [(1, "Joseph", "Joe"), (2, "Kim", "K")]
    with pytest.raises(Exception):
        tables.rewrite_table(stored, path)


def _bucket_files(path):
    return {f.relative_to(path): (f.stat().st_mtime_ns, f.stat().st_size) for f in Path(path, "data").rglob("*.parquet")}


def test_update_of_touched_buckets(spark, dims):
    schema = "id int, first_name string, nickname string"
    people = [(i, "Joe" if i in (3, 4) else f"N{i}", None) for i in range(200)] + [(None, "Joe", None), (None, "Kim", "K"), (3, "Joe", None)]
    path = shared_dir(spark, "versions")
    versions.create_table(spark.createDataFrame(people, schema), path, ["id"], 32)
    first, before = versions.read_version(spark, path), _bucket_files(path)

    def revise(rows):
        return tables.revise_names(rows, dims.nicknames)

    touched = versions.update_touched(spark, path, revise)
    expected = sorted([(i, "Joseph", "Joe") if n == "Joe" else (i, n, k) for i, n, k in people], key=repr)
    after = _bucket_files(path)
    assert rows(versions.read_version(spark, path)) == expected and 1 <= len(touched) <= 3
    assert {f: after[f] for f in before} == before and len(after) - len(before) == len(touched)
    assert rows(first) == rows(versions.read_version(spark, path, 1)) == sorted(people, key=repr)
    assert versions.update_touched(spark, path, revise) == [] and versions.versions(spark, path) == [1, 2]


def test_update_that_stops_before_its_manifest(spark, dims, monkeypatch):
    path = shared_dir(spark, "versions")
    people = spark.createDataFrame([(1, "Joe", None), (2, "Kim", "K")], "id int, first_name string, nickname string")
    versions.create_table(people, path, ["id"], 4)

    def revise(rows):
        return tables.revise_names(rows, dims.nicknames)

    with monkeypatch.context() as m, pytest.raises(OSError):
        m.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(OSError("stopped")))
        versions.update_touched(spark, path, revise)
    assert rows(versions.read_version(spark, path)) == rows(people)
    versions.update_touched(spark, path, revise)
    assert rows(versions.read_version(spark, path)) == [(1, "Joseph", "Joe"), (2, "Kim", "K")]
    with pytest.raises(ValueError):
        versions.update_touched(spark, path, lambda rows: rows.drop("nickname"))
    with pytest.raises(ValueError):
        versions.create_table(people, path, ["id"])
    empty = shared_dir(spark, "versions")
    versions.create_table(people.limit(0), empty, ["id"], 4)
    assert versions.read_version(spark, empty).count() == 0 and versions.update_touched(spark, empty, revise) == []


def test_routing(spark):
    df = spark.createDataFrame([({"bill_id": "1", "x": "2"},), ({"bill_id": "1"},)], "r map<string,string>")
    assert rows(df.select(csv_feeds.belongs_to(F.map_keys("r"), ("bill_id", "amdt_id")))) == [(False,), (True,)]


@pytest.mark.parametrize("feed", sorted(FEEDS))
def test_every_feed_lands_and_loads(spark, feed):
    df = spark.createDataFrame([tuple(f"{c} {i}" for c in FEEDS[feed]) for i in range(3)],
                               ", ".join(f"{c} string" for c in FEEDS[feed]))
    path = shared_dir(spark, "landing")
    csv_feeds.land_feed(df, feed, path, order_by=FEEDS[feed][:1])
    back = csv_feeds.read_feed(spark, path, feed)
    assert rows(back, *FEEDS[feed]) == rows(df)
    assert back.filter("size(errors) > 0").count() == 0


@pytest.mark.parametrize("feed,name,wanted", [
    ("bill_votes", "votes", ("house",)), ("bill_info", "bills", ()), ("cosponsors", "cosponsors", ()),
    ("house_members", "members", ("states", "politicians")), ("senate_members", "members", ("politicians",))])
def test_no_row_is_lost(spark, feed, name, wanted):
    source = driver_feed(spark, SF, name)
    dims = feeds.Dimensions(driver_feed(spark, SF, "nicknames"),
                            **{w: driver_feed(spark, SF, w) for w in wanted})
    produced, failed = feeds.outputs(feed, source, dims, "2018-10-24")
    assert produced[feeds.TARGETS[feed][0]].count() + failed.count() == source.count()


def test_split_files_give_the_rows_of_whole_ones(spark, tmp_path):
    """Breaks, quotes, commas and CRLF in values, records over several splits, at splits of 1 KB."""
    import random

    rng = random.Random(3)
    pieces = ['a', ',', '"', '\n', '\r\n', ' ', 'word ' * 40, 'é', '""', '\n\n', 'None']
    text = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(6)))
    values = [(f"HR{i}", text(), text(), text() * rng.choice((1, 1, 1, 30)), "F", "L", "D", "S", "u") for i in range(400)]

    def quoted(v):
        return '"' + v.replace('"', '""') + '"' if set(v) & set(',"\n\r') or v != v.strip() else v

    for ending in ("\n", "\r\n"):
        lines = [",".join(("", "bill_id", "amdt_id", "bill_title", "bill_summary", "sponsor_fn", "sponsor_ln", "sponsor_party", "sponsor_state", "bill_url"))]
        lines += [",".join((str(i), *map(quoted, v))) for i, v in enumerate(values)] + ["7,too,few", "", '9,"open to the end\n of the file']
        folder = tmp_path / f"csv{len(ending)}"
        folder.mkdir()
        for k in range(2):
            (folder / f"{k}.csv").write_bytes(ending.join(lines[:1] + lines[1 + k::2]).encode())
        whole = with_errors_text(csv_feeds.read_feed(spark, str(folder), "bill_info"))
        held = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
        try:
            for c in held:
                spark.conf.set(c, "1024")
            assert spark.read.text(str(folder)).rdd.getNumPartitions() > 100
            assert with_errors_text(csv_feeds.read_split_feed(spark, str(folder), "bill_info")) == whole and len(whole) > 400
        finally:
            for c, v in held.items():
                spark.conf.set(c, v)


def test_split_files_shuffle_pieces_of_blocks_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("idx,v\n" + "".join(f'{i},"a\n{i}"\n' for i in range(20000)) + '9,"' + "long\n" * 5000 + '"\n')
    held = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        found = records.read_records(spark, str(tmp_path))
        blocks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
        assert blocks > 10 and shuffled_rows(found) < 8 * blocks
        texts = sorted((r.record for r in found.collect()), key=len)
        assert len(texts) == 20001 and set(texts[:-1]) == {f'{i},"a\n{i}"' for i in range(20000)} and texts[-1] == '9,"' + "long\n" * 5000 + '"'
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", held)


def with_errors_text(df):
    """Good rows as they are, of broken ones that they are broken."""
    broken = F.size("errors") > 0
    return rows(df, broken, *[F.when(~broken, F.col(c)) for c in df.columns if c != "errors"])


@pytest.mark.parametrize("stop", ["prepare", "first table", "second table", "errors", "publish", "never"])
def test_a_load_that_stops_anywhere_can_be_repeated(spark, tmp_path, monkeypatch, stop):
    """No row is lost or doubled, readers see all tables or none, new politicians stay new."""
    suffix = "once_" + stop.replace(" ", "_")
    made = {name: f"{name}_{suffix}" for name in ("senate", "politicians")}
    for name in made:
        fields = ", ".join(f"{c} {'DATE' if c == 'date' else 'STRING'}" for c in TABLES[name])
        spark.sql(f"CREATE TABLE {made[name]} ({fields}, run_id STRING, batch_id BIGINT) USING parquet PARTITIONED BY (run_id, batch_id) LOCATION '{tmp_path}/{name}'")
    members = spark.createDataFrame([("Al", "Lee", "D", "MA"), ("Kim", "Ng", "R", "OH"), ("Kim", "Ng", "R", "OH")], "first_name string, last_name string, party string, state string")
    nicknames = spark.createDataFrame([("Bo", "Bob")], "nickname string, full_name string")
    seen = lambda name: tables.read_published(spark, made[name], f"{tmp_path}/published").count()

    def load():
        dims = feeds.Dimensions(nicknames, politicians=spark.table(made["politicians"]))
        feeds.load_feed_once("senate_members", members, dims, "2018/10 a", str(tmp_path), f"{tmp_path}/errors", "2018-10-24", targets=made)

    class Stop(Exception):
        pass

    def stopping(module, name, at):
        calls, whole = [], getattr(module, name)

        def run(*args, **kwargs):
            calls.append(1)
            if len(calls) == at:
                raise Stop
            return whole(*args, **kwargs)
        monkeypatch.setattr(module, name, run)

    if stop != "never":
        stopping(feeds, *{"prepare": ("error_record", 1), "first table": ("write_batch_rows", 1), "second table": ("write_batch_rows", 2),
                          "errors": ("write_batch_rows", 3), "publish": ("publish", 1)}[stop])
        if stop == "errors":
            load()
        else:
            with pytest.raises(Stop):
                load()
            assert seen("senate") == seen("politicians") == 0
    monkeypatch.undo()
    load()
    load()
    assert seen("senate") == seen("politicians") == 3
    assert rows(tables.read_published(spark, made["senate"], f"{tmp_path}/published"), "last_name", "run_id") == [("Lee", "2018/10 a"), ("Ng", "2018/10 a"), ("Ng", "2018/10 a")]
    assert spark.read.option("header", True).csv(f"{tmp_path}/errors/senate_members").count() == 0


def test_observed_counts_equal_the_error_branch(spark, dims):
    records = spark.createDataFrame([("Kim", None), ("Lee", "R"), (None, None), ("Lee", "R")], "first_name string, party string")
    flagged = errors.flag(records, F.col("party").isNull(), "no party", errors.STATE)
    flagged = errors.flag(flagged, F.col("first_name").isNull(), "no name", "a step of one's own")
    for df in (flagged, flagged.limit(0)):
        counts = Observation()
        path = shared_dir(spark, "counted")
        errors.observed(df, counts).write.parquet(path)
        found = counts.get
        failed = dict(rows(errors.error_rows(spark.read.schema(df.schema).parquet(path), "s").groupBy("ptransform").count()))
        assert found["rows"] == df.count() and found["clean"] == errors.clean_rows(df).count()
        assert found["other"] == failed.pop("a step of one's own", 0)
        assert {k: v for k, v in found.items() if v and k in errors.STEPS} == failed
