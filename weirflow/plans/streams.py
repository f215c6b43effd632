"""Structured Streaming over message folders made from the given tables.

The folders hold rows of the message source's shape; a Kafka topic takes their
place by passing a `KafkaTopic` to the same functions.
"""

from __future__ import annotations

import threading

from pyspark.sql import functions as F, types as T

from weirflow.functions.calendar import SECONDS_PATTERN
from weirflow.functions.parsing import json_value, parse_json_messages
from weirflow.ml.training import load_model, save_model, train_text_classifier
from weirflow.plans.registry import Registry, table
from weirflow.plans.scans import EVENT_LAKE, SENSOR_LINE, event_lines
from weirflow.schemas import DAY_PARTITIONS, struct_of
from weirflow.sinks.messages import as_messages, publish
from weirflow.sources.offsets import index_offsets
from weirflow.sources.messages import (
    MessageFolder, Reading, read_messages, read_tail, stream_messages,
)
from weirflow.streaming.common import run_until_stopped
from weirflow.streaming.commits import committed_rows, committing
from weirflow.streaming.landing import land, measurements, predictions
from weirflow.streaming.microbatch import (
    batch_folder_sink, both_outputs, for_each_batch, message_sink,
)
from weirflow.streaming.rowsends import folder_outbox, send_rows
from weirflow.streaming.scoring import score_json_messages, scoring_sink
from weirflow.workspace import new_path

plans = Registry()

FILES_PER_BATCH = 5_000
TAIL_PARTITIONS = 1_000
_PARTS = ("hour", "minute", "second", "year", "month", "day")
MEASURES = struct_of(
    l_quantity="double",
    l_extendedprice="double",
    l_discount="double",
    l_tax="double",
)


def _topic(spark, label) -> MessageFolder:
    return MessageFolder(new_path(spark, label))


def _send(spark, label, lines) -> MessageFolder:
    """Publish texts as messages; those of error events arrive broken."""
    topic = _topic(spark, label)
    broken = F.concat(F.lit("broken "), F.col("value"))
    text = F.when(F.col("event_type") == "error", broken).otherwise(F.col("value"))
    publish(lines.select(text.alias("value")), topic)
    return topic


def _stream(spark, topic):
    # A backlog of any size is worked off in micro-batches of bounded size.
    return stream_messages(spark, topic, Reading(max_per_trigger=FILES_PER_BATCH))


_BROKEN = """CAST((SELECT count(*) FROM events WHERE event_type = 'error') AS BIGINT) AS num_bad
    FROM events WHERE event_type IS DISTINCT FROM 'error'"""


def _with_bad_count(spark, landed, bad):
    """Landed rows beside the number of broken messages whose text was kept."""
    kept = spark.read.parquet(bad).filter(F.col("raw_message").startswith("broken "))
    return landed.crossJoin(kept.agg(F.count(F.lit(1)).alias("num_bad")))


@plans.query(
    "stream_ingest_json",
    f"""SELECT event_id, user_id, event_type, value, hour(ts) AS hour, minute(ts) AS minute,
        second(ts) AS second, year(ts) AS year, month(ts) AS month, day(ts) AS day, {_BROKEN}""",
)
def stream_ingest_json(spark, sf):
    """CSV messages → JSON lake by day, broken ones aside with their text. The
    query runs twice on one checkpoint; the second run adds nothing."""
    events = table(spark, sf, "events")
    topic = _send(spark, "lines", events.select("event_type", event_lines(events).alias("value")))
    lake, bad = new_path(spark, "lake"), new_path(spark, "bad")
    for _ in range(2):
        land(
            _stream(spark, topic), lambda batch: measurements(batch, SENSOR_LINE), lake, bad,
            fmt="json", available_now=True,
        ).awaitTermination()
    full = T.StructType(EVENT_LAKE.fields + DAY_PARTITIONS.fields)
    landed = spark.read.schema(full).json(lake).select(*full.fieldNames())
    return _with_bad_count(spark, landed.withColumns({c: F.col(c).cast("long") for c in _PARTS}), bad)


@plans.query(
    "stream_land_parquet",
    f"""SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, year(ts) AS year,
        month(ts) AS month, day(ts) AS day,
        CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS second_of_day, {_BROKEN}""",
)
def stream_land_parquet(spark, sf):
    """JSON messages → Parquet by day, broken ones aside with their text."""
    output, bad = new_path(spark, "landed"), new_path(spark, "bad")
    schema = struct_of(Timestamp="string", event_id="long", k="int")
    value = json_value([
        F.date_format("ts", SECONDS_PATTERN).alias("Timestamp"),
        "event_id",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    ])
    topic = _send(spark, "predictions", table(spark, sf, "events").select("event_type", value))
    land(
        _stream(spark, topic), lambda batch: predictions(batch, schema), output, bad,
        fmt="parquet", available_now=True,
    ).awaitTermination()
    landed = spark.read.parquet(output)
    clock = F.hour("Timestamp") * 3600 + F.minute("Timestamp") * 60 + F.second("Timestamp")
    return _with_bad_count(spark, landed.select(
        "event_id",
        "k",
        *[F.col(c).cast("long").alias(c) for c in ("year", "month", "day")],
        clock.cast("long").alias("second_of_day"),
    ), bad)


EVENT_TEXT = struct_of(
    event_id="long", user_id="long", event_type="string", ts="string", value="double",
    props="string",
)


def paced_batches(spark, sf, output):
    """All events through a stream with a period trigger, a third of the feed's
    files per micro-batch, stopped once everything has arrived."""
    topic = _topic(spark, "paced")
    files = max(6, int(spark.conf.get("spark.sql.shuffle.partitions")))
    events = table(spark, sf, "events").withColumn("ts", F.col("ts").cast("string"))
    publish(as_messages(events.repartition(files, "event_id")), topic)
    messages = stream_messages(spark, topic, Reading(max_per_trigger=-(-files // 3)))
    query = for_each_batch(
        parse_json_messages(messages, EVENT_TEXT).select(*EVENT_TEXT.fieldNames()),
        batch_folder_sink(output),
        new_path(spark, "checkpoint"),
        period_seconds=0.2,
    )

    def stop_when_done():
        query.processAllAvailable()
        query.stop()

    threading.Thread(target=stop_when_done, daemon=True).start()
    run_until_stopped(query)


@plans.query(
    "stream_foreach_batch",
    """SELECT event_id, user_id, event_type, CAST(ts AS VARCHAR) AS ts, value, props FROM events""",
)
def stream_foreach_batch(spark, sf):
    """Micro-batches of a paced stream, each written under its own name."""
    output = new_path(spark, "batches")
    paced_batches(spark, sf, output)
    return spark.read.parquet(output).drop("batch_id")


@plans.query(
    "message_tail",
    """SELECT user_id % 1000 AS partition, event_id FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id % 1000 ORDER BY event_id DESC) AS n
        FROM events) t
    WHERE n <= 5""",
)
def message_tail(spark, sf):
    """The last five messages of every topic partition, to which users are dealt.
    The topic is sent in four parts; an index of its offsets tells which of its
    files to open."""
    topic = _topic(spark, "tail")
    events = table(spark, sf, "events")
    messages = events.select(
        F.col("event_id").cast("string").alias("value"),
        F.lit("events").alias("topic"),
        F.pmod("user_id", F.lit(TAIL_PARTITIONS)).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )
    publish(messages.repartitionByRange(4, "offset"), topic)
    index_offsets(spark, topic.path)
    return read_tail(spark, topic, 5).select(
        F.col("partition").cast("long").alias("partition"),
        F.col("value").cast("string").cast("long").alias("event_id"),
    )


@plans.query(
    "stream_committed_outputs",
    """SELECT event_type, CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS INTEGER) AS usable,
        count(*) AS num_messages FROM events GROUP BY 1, 2""",
)
def stream_committed_outputs(spark, sf):
    """Usable and unusable messages of several micro-batches in two outputs, read
    through the manifest that shows both parts of a batch at once."""
    events = table(spark, sf, "events")
    topic = _send(spark, "committed-in", events.select(
        "event_type", event_lines(events).alias("value")).repartition(3, "event_type", "value"))
    good, bad, manifest = (new_path(spark, n) for n in ("good", "bad", "commits"))
    sink = both_outputs(
        lambda batch: measurements(batch, SENSOR_LINE), batch_folder_sink(good), batch_folder_sink(bad)
    )
    messages = stream_messages(spark, topic, Reading(max_per_trigger=1))
    run_until_stopped(for_each_batch(
        messages, committing(sink, manifest), new_path(spark, "checkpoint"), available_now=True
    ))
    kind = F.split("raw_message", ",")[3].alias("event_type")
    usable = committed_rows(spark.read.parquet(good), manifest).select("event_type", F.lit(1).alias("usable"))
    broken = committed_rows(spark.read.parquet(bad), manifest).select(kind, F.lit(0).alias("usable"))
    return usable.unionByName(broken).groupBy("event_type", "usable").agg(
        F.count(F.lit(1)).alias("num_messages")
    )


@plans.query("stream_foreach_rows", "SELECT event_id, user_id, event_type, value FROM events")
def stream_foreach_rows(spark, sf):
    """Events sent row by row from the executors, three micro-batches of them, as
    an outside system has them afterwards. A batch has a file for each task that the
    session can run at once."""
    topic, outbox = _topic(spark, "rows-in"), new_path(spark, "outbox")
    files = max(1, spark.sparkContext.defaultParallelism)
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    publish(as_messages(events.repartition(3 * files, "event_id")), topic)
    rows = parse_json_messages(
        stream_messages(spark, topic, Reading(max_per_trigger=files)), events.schema
    ).select(*events.columns)
    run_until_stopped(send_rows(
        rows, folder_outbox(spark, outbox), new_path(spark, "checkpoint"), available_now=True
    ))
    return spark.read.schema(events.schema).json(outbox)


_USABLE = "l_linenumber <> 1"


@plans.query(
    "stream_score",
    f"""SELECT count(*) AS num_messages,
        CAST(sum(CASE WHEN {_USABLE} THEN 1 ELSE 0 END) AS BIGINT) AS num_scored,
        CAST(sum(CASE WHEN {_USABLE} THEN 0 ELSE 1 END) AS BIGINT) AS num_bad,
        1 AS same_as_batch
    FROM lineitem""",
)
def stream_score(spark, sf):
    """A stream scored by a saved and loaded model against batch scoring of the
    same messages; unusable messages end in their own output."""
    items = table(spark, sf, "lineitem")
    path, topic = new_path(spark, "model"), _topic(spark, "items")
    scored_topic, bad_topic = _topic(spark, "scored"), _topic(spark, "bad")
    trained = train_text_classifier(
        items.select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", *MEASURES.fieldNames()),
        features=MEASURES.fieldNames(),
        label="l_returnflag",
        predicted="predicted",
        key=["l_orderkey", "l_linenumber", "l_partkey"],
    )
    save_model(trained.model, path)
    model = load_model(path)
    # Some of the lines arrive as broken text.
    broken = F.concat(F.lit("broken "), F.col("value"))
    text = F.when(F.col("usable"), F.col("value")).otherwise(broken)
    messages = items.select(F.expr(_USABLE).alias("usable"), json_value(MEASURES.fieldNames()))
    publish(messages.select(text.alias("value")), topic)
    arguments = {"measures": MEASURES, "predicted": "predicted", "output": "predicted_flag"}
    for_each_batch(
        _stream(spark, topic),
        scoring_sink(model, message_sink(scored_topic), message_sink(bad_topic), **arguments),
        new_path(spark, "checkpoint"),
        available_now=True,
        keep=False,
    ).awaitTermination()

    batch, _ = score_json_messages(read_messages(spark, topic), model, **arguments)
    stored = read_messages(spark, scored_topic)
    tagged = (
        _content(batch).withColumn("side", F.lit("batch"))
        .unionByName(_content(stored).withColumn("side", F.lit("stream")))
        .unionByName(_content(read_messages(spark, bad_topic)).withColumn("side", F.lit("bad")))
    )

    def of(side, column):
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col(column))), F.lit(0))

    # Equal counts and equal sums of content hashes: the same bag of messages.
    same = (of("batch", "n") == of("stream", "n")) & (of("batch", "h") == of("stream", "h"))
    return tagged.agg(
        (of("stream", "n") + of("bad", "n")).alias("num_messages"),
        of("stream", "n").alias("num_scored"),
        of("bad", "n").alias("num_bad"),
        same.cast("int").alias("same_as_batch"),
    )


def _content(messages):
    key = F.col("key").cast("string") if "key" in messages.columns else F.lit(None)
    digest = F.xxhash64(key, F.col("value").cast("string")).cast("decimal(38,0)")
    return messages.select(F.lit(1).cast("long").alias("n"), digest.alias("h"))
