"""Streams: same rows as batch, later batches see earlier ones, retries write nothing twice."""

from __future__ import annotations

from pyspark.sql import functions as F

from rostrum_testing import SF, rows
from checks.fixtures import feed
from rostrum.plans import feeds
from rostrum.schemas import FEEDS, MESSAGE, table_schema
from rostrum.session import shared_dir
from rostrum.sources import messages, sinks, tables
from rostrum.streaming import feeds as streams


def dims(spark, politicians=None):
    return feeds.Dimensions(feed(spark, SF, "nicknames"), states=feed(spark, SF, "states"),
                            politicians=politicians if politicians is not None else feed(spark, SF, "politicians"))


def start(spark, landed, root, checkpoint, read_dims, per_batch=1000):
    stream = streams.message_records(
        messages.read_message_stream(spark, landed, files_per_batch=per_batch), FEEDS["house_members"])
    streams.stream_feed(stream, "house_members", read_dims, root, checkpoint, "2018-10-24").awaitTermination()


def test_batch_equals_stream(spark):
    members = feed(spark, SF, "members").drop("member_id")
    landed, root, checkpoint = (shared_dir(spark, x) for x in ("messages", "out", "checkpoint"))
    messages.to_messages(members).repartition(5).write.parquet(landed)
    start(spark, landed, root, checkpoint, lambda: dims(spark), per_batch=2)
    batch, failed = feeds.outputs("house_members", members, dims(spark), "2018-10-24")
    assert len({r[0] for r in spark.read.parquet(f"{root}/house").select("batch_id").collect()}) == 3
    for table in ("house", "politicians"):
        streamed = spark.read.parquet(f"{root}/{table}").drop("run_id", "batch_id")
        assert rows(streamed) == rows(batch[table])
    streamed = spark.read.option("header", True).csv(f"{root}/errors").drop("run_id", "batch_id")
    assert rows(streamed, "last_name", "ptransform") == rows(failed, "last_name", "ptransform")
    assert batch["house"].count() + failed.count() == members.count()


def test_later_batches_know_earlier_politicians(spark):
    landed, root, checkpoint = (shared_dir(spark, x) for x in ("messages", "out", "checkpoint"))
    known = spark.createDataFrame([], table_schema("politicians"))

    def stored():
        try:
            return dims(spark, spark.read.parquet(f"{root}/politicians").drop("run_id", "batch_id"))
        except Exception:  # nothing written yet
            return dims(spark, known)

    record = {"first_name": "Ann", "last_name": "Lee", "party": "R", "state": "NATION_1", "district": "1st"}
    for _ in range(2):
        spark.createDataFrame([(b"x", record)], MESSAGE).coalesce(1).write.mode("append").parquet(landed)
        start(spark, landed, root, checkpoint, stored)
    assert spark.read.parquet(f"{root}/house").count() == 2
    assert spark.read.parquet(f"{root}/politicians").count() == 1


def test_runs_keep_each_others_rows(spark):
    """Two runs with checkpoints of their own write to one root; both start at batch 0."""
    members = feed(spark, SF, "members").drop("member_id")
    root = shared_dir(spark, "out")
    for part in (0, 1):
        landed = shared_dir(spark, "messages")
        messages.to_messages(members.filter(F.length("last_name") % 2 == part)).write.parquet(landed)
        start(spark, landed, root, shared_dir(spark, "checkpoint"), lambda: dims(spark))
    expected, _ = feeds.outputs("house_members", members, dims(spark), "2018-10-24")
    assert rows(spark.read.parquet(f"{root}/house").drop("run_id", "batch_id")) == rows(expected["house"])


def test_retry_replaces_its_batch(spark):
    members = feed(spark, SF, "members").drop("member_id")
    root = shared_dir(spark, "out")
    written, failed = feeds.outputs("house_members", members, dims(spark), "2018-10-24")
    for _ in range(2):
        streams.write_batch(written, failed, FEEDS["house_members"], root, "r", 0)
    assert spark.read.parquet(f"{root}/house").count() == written["house"].count()
    back = spark.read.option("header", True).csv(f"{root}/errors")
    assert back.count() == failed.count()


def test_stored_table_takes_each_batch_once(spark):
    path = shared_dir(spark, "house")
    name = "stored_" + path.rsplit("-", 1)[1]
    spark.sql(f"CREATE TABLE {name} (first_name STRING, district STRING, run_id STRING, batch_id BIGINT) "
              f"USING parquet PARTITIONED BY (run_id, batch_id) LOCATION '{path}'")
    rows_of = lambda *names: spark.createDataFrame([(n, "x") for n in names], "first_name string, extra string")
    for run, batch, names in (("a", 0, ("A", "B")), ("b", 0, ("C",)), ("a", 1, ("D",)), ("a", 0, ("A", "B"))):
        tables.write_batch_rows(rows_of(*names), name, run, batch)
    tables.append_to_table(rows_of("E"), name)
    assert rows(spark.table(name), "first_name", "run_id", "batch_id") == sorted(
        [("A", "a", 0), ("B", "a", 0), ("C", "b", 0), ("D", "a", 1), ("E", None, None)], key=repr)


def test_topics(spark):
    sent = [("a", {"topic_name": "bills", "x": "1", "y": "2"}), ("b", {"topic_name": "votes", "z": "3"}),
            ("c", {"topic_name": "odd", "z": "4"}), ("d", {"z": "5"})]
    landed, root = shared_dir(spark, "messages"), shared_dir(spark, "topics")
    spark.createDataFrame(sent, "k string, attributes map<string,string>").select(
        F.col("k").cast("binary").alias("data"), "attributes").write.parquet(landed)
    streams.stream_errors(messages.read_message_stream(spark, landed), {"bills": ("y", "x"), "votes": ("z",)},
                          root, shared_dir(spark, "checkpoint")).awaitTermination()
    read = lambda topic: spark.read.option("header", True).option("escape", '"').csv(f"{root}/{topic}").drop("run_id", "batch_id")
    assert rows(read("bills")) == [("2", "1")]
    assert rows(read("votes")) == [("3",)]
    assert rows(read("other"), "topic_name") == sorted([("odd",), (None,)], key=repr)


def test_topic_values(spark):
    df = spark.createDataFrame([({"topic_name": "t", "x": "1"},)], "m map<string,string>")
    assert df.select(sinks.topic_values(F.col("m"))).first()[0] == {"x": "1"}


def test_redelivered_messages_are_stored_once(spark):
    """Across batches and a restart; messages without an id all stay; what comes after its delay is counted."""
    landed, root, checkpoint = (shared_dir(spark, x) for x in ("messages", "out", "checkpoint"))

    def send(*sent):
        made = [(b"x", {"last_name": name, **({"message_id": i} if i else {}), **({"publish_time": t} if t else {})}) for name, i, t in sent]
        spark.createDataFrame(made, MESSAGE).coalesce(1).write.mode("append").parquet(landed)

    def run():
        stream = messages.first_deliveries(messages.read_message_stream(spark, landed, files_per_batch=1), "10 minutes")
        query = streams.message_records(stream, ("last_name",)).drop("errors").writeStream.format("parquet") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(root)
        query.awaitTermination()
        return messages.late_messages(query)

    noon = lambda minute: f"2018-10-24 12:{minute:02d}:00"
    send(("A", "1", noon(0)), ("A", "1", noon(0)), ("B", "2", noon(1)))
    send(("B", "2", noon(1)), ("C", "3", noon(2)), ("bad time", "4", "noon"), ("bad time", "4", "noon"))
    assert run() == 0
    send(("A", "1", noon(0)), ("D", "5", noon(3)), ("C", "3", noon(2)))
    assert run() == 0
    seen = lambda: sorted(r[0] for r in spark.read.parquet(root).select("last_name").collect())
    assert seen() == ["A", "B", "C", "D", "bad time", "bad time"]


def test_messages_after_their_delay_are_counted(spark):
    landed, root, checkpoint = (shared_dir(spark, x) for x in ("messages", "out", "checkpoint"))
    late = 0
    for name, i, minute in (("A", "1", 0), ("B", "2", 40), ("C", "3", 41), ("late", "4", 1), ("D", "5", 42)):
        message = {"last_name": name, "message_id": i, "publish_time": f"2018-10-24 12:{minute:02d}:00"}
        spark.createDataFrame([(b"x", message)], MESSAGE).coalesce(1).write.mode("append").parquet(landed)
        stream = messages.first_deliveries(messages.read_message_stream(spark, landed, files_per_batch=1), "10 minutes")
        query = streams.message_records(stream, ("last_name",)).drop("errors").writeStream.format("parquet") \
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(root)
        query.awaitTermination()
        late += messages.late_messages(query)
    assert sorted(r[0] for r in spark.read.parquet(root).select("last_name").collect()) == ["A", "B", "C", "D"] and late == 1
