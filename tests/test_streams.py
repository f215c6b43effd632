import json

import pytest
from pyspark.sql import functions as F

from helpers import tuples
from weirflow.functions.parsing import (
    first_or, parse_csv_messages, parse_json_messages, split_usable,
)
from weirflow.jobs.streams import (
    ingest_occupancy, land_predictions, score_flowers, score_flowers_by_batch, score_occupancy,
    train_flowers, train_occupancy,
)
from weirflow.schemas import IRIS_MEASURES, OCCUPANCY_LAKE, OCCUPANCY_LINE
from weirflow.sinks.messages import as_messages, publish
from weirflow.sources.files import read_day
from weirflow.sources.messages import (
    KafkaTopic, MessageFolder, Reading, client_settings, read_messages, read_tail, stream_messages, tail_offsets,
)
from weirflow.streaming.common import default_checkpoint, run_until_stopped
from weirflow.streaming.landing import land, measurements
from weirflow.streaming.microbatch import batch_folder_sink, client_sink, fan_out, for_each_batch

BAD_LINES = ["", "2015-02-04 17:51:00", "no time,1,2,3,4,5,1", "2015-02-04 17:51:00,x,2,3,4,5,1"]


def lines(n, day=4):
    """Occupied exactly when the light is on."""
    return [
        f"2015-02-{day:02d} {8 + i // 60:02d}:{i % 60:02d}:00,"
        f"{20 + i % 5 / 10},27.2,{400.5 if i % 3 else 0.0},{600 + i},0.0047,{1 if i % 3 else 0}"
        for i in range(n)
    ]


def send(spark, topic, texts):
    publish(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), topic)


def values(spark, topic):
    return [r.value.decode() for r in read_messages(spark, topic).collect()]


def flower_csv(path):
    rows = ["sepal_length,sepal_width,petal_length,petal_width,species"]
    for i in range(60):
        rows.append(f"{5 + i % 4 / 10},3.4,{1.4 + i % 3 / 10},0.2,setosa")
        rows.append(f"{6 + i % 4 / 10},2.8,{4.3 + i % 3 / 10},1.3,versicolor")
        rows.append(f"{6.8 + i % 4 / 10},3.0,{5.8 + i % 3 / 10},2.1,virginica")
    path.write_text("\n".join(rows))
    return str(path)


# One typical flower per class, by petal length.
FLOWERS = {
    1.4: {"sepal_length": 5.1, "sepal_width": 3.4, "petal_length": 1.4, "petal_width": 0.2},
    4.4: {"sepal_length": 6.1, "sepal_width": 2.8, "petal_length": 4.4, "petal_width": 1.3},
    5.9: {"sepal_length": 7.0, "sepal_width": 3.0, "petal_length": 5.9, "petal_width": 2.1},
}


def flower(length):
    return json.dumps({**FLOWERS[length], "species": "ignored"})


def test_bad_messages_are_kept_and_split(spark):
    df = spark.createDataFrame([(t,) for t in lines(2) + BAD_LINES], "value string")
    good, bad = split_usable(parse_csv_messages(df, OCCUPANCY_LINE), ["date", "Temperature", "Occupancy"])
    assert good.count() == 3 and bad.count() == 3
    texts = [flower(1.4), "{broken", "{}", '{"sepal_length": "text"}', "", "null", "[1]"]
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "value string")
    rows = parse_json_messages(df, IRIS_MEASURES)
    assert rows.count() == len(texts) + 1
    good, bad = split_usable(rows, IRIS_MEASURES.fieldNames())
    assert tuples(good.select("raw_message", "petal_length")) == [(flower(1.4), 1.4)]
    assert bad.count() == len(texts)


def test_first_or(spark):
    df = spark.sql("SELECT array() AS a UNION ALL SELECT array('x', 'y') UNION ALL SELECT NULL")
    got = [r[0] for r in df.select(first_or(F.col("a").cast("array<string>"), "<none>")).collect()]
    assert sorted(got) == ["<none>", "<none>", "x"]


def test_messages_carry_keys(spark, tmp_path):
    topic = MessageFolder(str(tmp_path / "t"))
    df = spark.createDataFrame([("n1", 2.5, None)], "Name string, Price double, Genre string")
    publish(as_messages(df, key="Name"), topic)
    row = read_messages(spark, topic).first()
    assert row.key == b"n1" and json.loads(row.value) == {"Name": "n1", "Price": 2.5}


def test_tail_of_a_topic(spark, tmp_path):
    sizes = {0: 0, 1: 3, 2: 5, 3: 12}
    rows = [(f"{p}:{o}", "books", p, o) for p, n in sizes.items() for o in range(n)]
    topic = MessageFolder(str(tmp_path / "t"))
    publish(
        spark.createDataFrame(rows, "value string, topic string, partition int, offset long"), topic
    )
    got = sorted(r.value.decode() for r in read_tail(spark, topic, 5).collect())
    assert got == sorted(f"{p}:{o}" for p, n in sizes.items() for o in range(max(n - 5, 0), n))


def test_tail_offsets_of_kafka():
    ends = json.dumps({"books": {"0": 0, "1": 3, "2": 12}})
    assert json.loads(tail_offsets(ends, 5)) == {"books": {"0": 0, "1": 0, "2": 7}}


def test_client_settings_of_kafka():
    topic = KafkaTopic("host:9092", "books", {"kafka.security.protocol": "SSL", "minPartitions": "9"})
    settings = client_settings(topic)
    assert settings["bootstrap.servers"] == "host:9092"
    assert settings["security.protocol"] == "SSL" and "minPartitions" not in settings


def test_ingest_restart_adds_nothing_and_new_messages_arrive(spark, tmp_path):
    topic, lake = MessageFolder(str(tmp_path / "t")), str(tmp_path / "lake")
    send(spark, topic, lines(30))
    for expected in (30, 30):
        ingest_occupancy(spark, topic, lake, str(tmp_path / "bad"), available_now=True).awaitTermination()
        assert read_day(spark, lake, OCCUPANCY_LAKE, "2015-02-04").count() == expected
    send(spark, topic, lines(5) + lines(7, day=5))
    ingest_occupancy(spark, topic, lake, str(tmp_path / "bad"), available_now=True).awaitTermination()
    assert read_day(spark, lake, OCCUPANCY_LAKE, "2015-02-04").count() == 35
    assert read_day(spark, lake, OCCUPANCY_LAKE, "2015-02-05").count() == 7
    row = read_day(spark, lake, OCCUPANCY_LAKE, "2015-02-05").orderBy("minute").first()
    assert (row.hour, row.minute, row.second, row.Light) == (8, 0, 0, 0.0)
    assert (tmp_path / "lake" / ".checkpoint").is_dir()


def test_bad_lines_do_not_stop_ingestion(spark, tmp_path):
    topic, lake = MessageFolder(str(tmp_path / "t")), str(tmp_path / "lake")
    send(spark, topic, BAD_LINES + lines(3))
    ingest_occupancy(spark, topic, lake, str(tmp_path / "bad"), available_now=True).awaitTermination()
    # The line with one bad measure still has its time and lands.
    landed = spark.read.schema(OCCUPANCY_LAKE).json(lake)
    aside = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert landed.count() == 3 + 2
    assert sorted(r.raw_message for r in aside) == sorted(t for t in BAD_LINES if t[:4] != "2015")


def test_occupancy_from_feed_to_landed_predictions(spark, tmp_path):
    feed, out, bad = (MessageFolder(str(tmp_path / n)) for n in ("feed", "out", "bad"))
    lake, landed = str(tmp_path / "lake"), str(tmp_path / "landed")
    send(spark, feed, lines(300) + BAD_LINES)
    ingest_occupancy(spark, feed, lake, str(tmp_path / "aside"), available_now=True).awaitTermination()

    by_day = train_occupancy(spark, lake, str(tmp_path / "model"), day="2015-02-04")
    assert by_day.metrics.first().accuracy > 0.95 and by_day.removed == 2

    score_occupancy(
        spark, feed, out, bad, str(tmp_path / "model"), str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    assert sorted(values(spark, bad)) == sorted(BAD_LINES)
    messages = [json.loads(v) for v in values(spark, out)]
    assert len(messages) == 300
    assert set(messages[0]) == {"Timestamp", "Occupancy", "Prediction"}
    assert all(m["Occupancy"] == m["Prediction"] for m in messages)

    land_predictions(spark, out, landed, str(tmp_path / "aside2"), available_now=True).awaitTermination()
    rows = spark.read.parquet(landed)
    assert rows.count() == 300
    assert rows.filter("year = 2015 AND month = 2 AND day = 4").count() == 300
    assert str(rows.agg(F.min("Timestamp")).first()[0]) == "2015-02-04 08:00:00"


def test_occupancy_from_csv(spark, tmp_path):
    header = ",".join(OCCUPANCY_LINE.fieldNames())
    (tmp_path / "train.csv").write_text("\n".join([header, *lines(200), BAD_LINES[2]]))
    trained = train_occupancy(spark, str(tmp_path / "train.csv"), str(tmp_path / "model"))
    assert trained.metrics.first().accuracy > 0.95 and trained.removed == 1


def test_flowers_stream_equals_batch_and_bad_go_aside(spark, tmp_path):
    model = str(tmp_path / "model")
    trained = train_flowers(spark, flower_csv(tmp_path / "iris.csv"), model)
    assert trained.metrics.first().accuracy > 0.9
    source, out, bad = (MessageFolder(str(tmp_path / n)) for n in ("in", "out", "bad"))
    send(spark, source, [flower(x) for x in (1.4, 4.4, 5.9)] + ["{broken", "{}"])
    score_flowers(
        spark, source, out, bad, model, str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    rows = read_messages(spark, out).collect()
    assert sorted(r.key.decode() for r in rows) == ["setosa", "versicolor", "virginica"]
    for r in rows:
        value = json.loads(r.value)
        assert list(value) == [*IRIS_MEASURES.fieldNames(), "predicted_species"]
        assert value["predicted_species"] == r.key.decode()
    assert sorted(values(spark, bad)) == ["{broken", "{}"]

    query = score_flowers_by_batch(
        spark, source, batch_folder_sink(str(tmp_path / "batches")),
        batch_folder_sink(str(tmp_path / "bad_batches")), model, str(tmp_path / "cp2"),
        available_now=True,
    )
    query.awaitTermination()
    aside = spark.read.parquet(str(tmp_path / "bad_batches")).collect()
    assert sorted(r.value for r in aside) == ["{broken", "{}"]
    by_batch = spark.read.parquet(str(tmp_path / "batches")).select("key", "value").collect()
    assert sorted(r.value for r in by_batch) == sorted(r.value.decode() for r in rows)


def test_batches_skip_empty_and_replay_once(spark, tmp_path):
    topic, seen = MessageFolder(str(tmp_path / "t")), []
    send(spark, topic, ["a", "b"])
    send(spark, topic, ["skip"])
    send(spark, topic, ["c"])
    sink = batch_folder_sink(str(tmp_path / "out"))

    def record(batch, batch_id):
        seen.append((batch_id, batch.count()))
        sink(batch, batch_id)
        sink(batch, batch_id)

    rows = stream_messages(spark, topic, Reading(max_per_trigger=1)).select(
        F.col("value").cast("string").alias("v")
    ).filter("v <> 'skip'")
    for_each_batch(rows, record, str(tmp_path / "cp"), available_now=True).awaitTermination()
    assert sorted(n for _, n in seen) == [1, 2]
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(r.v for r in stored.collect()) == ["a", "b", "c"]


def test_a_new_checkpoint_replaces_no_earlier_batch(spark, tmp_path):
    topic = MessageFolder(str(tmp_path / "t"))
    send(spark, topic, ["a", "b"])
    for n in range(2):
        rows = stream_messages(spark, topic).select(F.col("value").cast("string").alias("v"))
        for_each_batch(
            rows, batch_folder_sink(str(tmp_path / "out")), str(tmp_path / f"cp{n}"), available_now=True
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_messages_sent_at_the_start_reach_one_output_each(spark, tmp_path):
    """Two starts of the job on one checkpoint, messages arriving in between."""
    model = str(tmp_path / "model")
    train_flowers(spark, flower_csv(tmp_path / "iris.csv"), model)
    source, out, bad = (MessageFolder(str(tmp_path / n)) for n in ("in", "out", "bad"))
    send(spark, source, [flower(1.4), "{broken"])
    query = score_flowers(spark, source, out, bad, model, str(tmp_path / "cp"), period_seconds=0.2)
    send(spark, source, [flower(4.4), "{}"])
    query.processAllAvailable()
    query.stop()
    send(spark, source, [flower(5.9), "late"])
    score_flowers(
        spark, source, out, bad, model, str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    assert len(values(spark, out)) == 3
    assert sorted(values(spark, bad)) == ["late", "{broken", "{}"]


def test_paced_stream_runs_several_batches(spark, sf, tmp_path):
    from weirflow.plans.streams import paced_batches

    paced_batches(spark, sf, str(tmp_path / "out"))
    assert len(list((tmp_path / "out").glob("batch_id=*"))) >= 3
    assert spark.read.parquet(str(tmp_path / "out")).count() == spark.read.parquet(
        f"{sf}/events.parquet").count()


def test_event_lines_keep_their_fields(spark):
    from weirflow.plans.scans import SENSOR_LINE, event_lines

    events = spark.createDataFrame(
        [(1, None, 'a,"b', 2.0), (2, 7, None, None)], "event_id long, user_id long, event_type string, value double"
    ).withColumn("ts", F.to_timestamp(F.lit("2024-01-01 10:00:00")))
    sent = events.select(event_lines(events).alias("value"))
    rows = parse_csv_messages(sent, SENSOR_LINE).drop("raw_message")
    assert sorted(tuples(rows)) == [
        ("2024-01-01 10:00:00", 1, None, 'a,"b', 2.0), ("2024-01-01 10:00:00", 2, 7, None, None),
    ]


def test_rows_sent_from_executors(spark, tmp_path):
    topic, mailbox = MessageFolder(str(tmp_path / "t")), tmp_path / "mail"
    mailbox.mkdir()
    send(spark, topic, ["a", "b", "c"])
    folder = str(mailbox)

    def send_rows(rows):
        import os
        import uuid

        with open(os.path.join(folder, uuid.uuid4().hex), "w") as client:
            for row in rows:
                client.write(row.v + "\n")

    rows = stream_messages(spark, topic).select(F.col("value").cast("string").alias("v"))
    both = fan_out(client_sink(send_rows), batch_folder_sink(str(tmp_path / "kept")))
    for_each_batch(rows, both, str(tmp_path / "cp"), available_now=True).awaitTermination()
    sent = sorted(line for f in mailbox.iterdir() for line in f.read_text().split())
    assert sent == ["a", "b", "c"] == sorted(
        r.v for r in spark.read.parquet(str(tmp_path / "kept")).collect()
    )


def test_period_trigger_and_clean_stop(spark, tmp_path):
    topic = MessageFolder(str(tmp_path / "t"))
    send(spark, topic, lines(3))
    query = land(
        stream_messages(spark, topic), measurements, str(tmp_path / "lake"), str(tmp_path / "bad"),
        fmt="json", period_seconds=0.2,
    )
    query.processAllAvailable()
    assert query.isActive
    query.stop()
    run_until_stopped(query)
    assert not query.isActive
    assert spark.read.schema(OCCUPANCY_LAKE).json(str(tmp_path / "lake")).count() == 3


def test_default_checkpoint():
    assert default_checkpoint("/x/y/", None) == "/x/y/.checkpoint"
    assert default_checkpoint("/x/y", "/z") == "/z"


def test_scored_batches_are_kept_once(spark, tmp_path):
    """One cached table a batch, with the text of unusable messages alone."""
    source, model, kept = MessageFolder(str(tmp_path / "in")), str(tmp_path / "model"), []
    csv = tmp_path / "iris.csv"
    flower_csv(csv)
    train_flowers(spark, str(csv), model)
    flower = json.dumps({c: 1.5 for c in IRIS_MEASURES.fieldNames()})
    send(spark, source, [flower, "{broken", flower])
    already = spark.sparkContext._jsc.getPersistentRDDs().size()

    def sink(batch, batch_id):
        rows = sorted(r.value for r in batch.collect())
        kept.append((rows, spark.sparkContext._jsc.getPersistentRDDs().size() - already))

    score_flowers_by_batch(
        spark, source, sink, sink, model, str(tmp_path / "cp"), available_now=True
    ).awaitTermination()
    assert [n for _, n in kept] == [1, 1]
    assert len(kept[0][0]) == 2 and kept[1][0] == ["{broken"]
