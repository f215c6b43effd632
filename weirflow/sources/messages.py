"""Message topics: Kafka, or a folder of Parquet files with the same row shape
(key, value, topic, partition, offset, timestamp) where no broker is at hand."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from weirflow.operators.ranking import tail_per_partition
from weirflow.schemas import MESSAGES
from weirflow.sources.offsets import tail_files


@dataclass(frozen=True)
class KafkaTopic:
    servers: str
    topic: str
    options: dict[str, str] = field(default_factory=dict)

    def settings(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, **self.options}


@dataclass(frozen=True)
class MessageFolder:
    path: str


Topic = KafkaTopic | MessageFolder


@dataclass(frozen=True)
class Reading:
    """Where a stream starts, what lost data does, and how it is paced.

    `starting_offsets` counts at a query's first start only ("latest" leaves the
    backlog out, "earliest" takes it). Data that is gone before it was read ends
    the query, unless `fail_on_data_loss` is false. `max_per_trigger` bounds a
    micro-batch: offsets for Kafka, files for a folder, which is read from its
    oldest file.
    """

    starting_offsets: str = "latest"
    fail_on_data_loss: bool = True
    max_per_trigger: int | None = None


def stream_messages(spark: SparkSession, topic: Topic, reading: Reading = Reading()) -> DataFrame:
    """Unbounded message table."""
    if isinstance(topic, KafkaTopic):
        reader = (
            spark.readStream.format("kafka")
            .options(**topic.settings())
            .option("subscribe", topic.topic)
            .option("startingOffsets", reading.starting_offsets)
            .option("failOnDataLoss", str(reading.fail_on_data_loss).lower())
        )
        if reading.max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", reading.max_per_trigger)
        return reader.load()
    reader = (
        spark.readStream.schema(MESSAGES)
        .option("recursiveFileLookup", True)
        .option("ignoreMissingFiles", str(not reading.fail_on_data_loss).lower())
    )
    if reading.max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", reading.max_per_trigger)
    return reader.parquet(topic.path)


def read_messages(
    spark: SparkSession, topic: Topic, *, starting_offsets: str = "earliest",
    ending_offsets: str = "latest",
) -> DataFrame:
    """Bounded message table."""
    if isinstance(topic, KafkaTopic):
        return (
            spark.read.format("kafka")
            .options(**topic.settings())
            .option("subscribe", topic.topic)
            .option("startingOffsets", starting_offsets)
            .option("endingOffsets", ending_offsets)
            .load()
        )
    return spark.read.schema(MESSAGES).option("recursiveFileLookup", True).parquet(topic.path)


def tail_offsets(end_offsets: str, n: int) -> str:
    """Start offsets for the last n messages of every partition, as JSON, from
    end offsets in the same form: {"topic": {"partition": offset}}."""
    ends = json.loads(end_offsets)
    return json.dumps(
        {t: {p: max(end - n, 0) for p, end in parts.items()} for t, parts in ends.items()}
    )


def latest_offsets(spark: SparkSession, topic: KafkaTopic) -> str:
    """End offsets of all partitions as JSON: one metadata request by the
    client library that the Kafka connector brings along; no message is read."""
    jvm = spark._jvm
    settings = jvm.java.util.Properties()
    for name, value in client_settings(topic).items():
        settings.setProperty(name, value)
    consumer = jvm.org.apache.kafka.clients.consumer.KafkaConsumer(settings)
    try:
        partitions = jvm.java.util.ArrayList()
        for info in consumer.partitionsFor(topic.topic):
            partitions.add(jvm.org.apache.kafka.common.TopicPartition(topic.topic, info.partition()))
        ends = {str(p.partition()): int(end) for p, end in consumer.endOffsets(partitions).items()}
    finally:
        consumer.close()
    return json.dumps({topic.topic: ends})


def client_settings(topic: KafkaTopic) -> dict[str, str]:
    """The topic's `kafka.` options as the client library names them."""
    decoder = "org.apache.kafka.common.serialization.ByteArrayDeserializer"
    given = {
        name.removeprefix("kafka."): str(value)
        for name, value in topic.settings().items()
        if name.startswith("kafka.")
    }
    return {"key.deserializer": decoder, "value.deserializer": decoder, **given}


def read_tail(spark: SparkSession, topic: Topic, n: int = 5) -> DataFrame:
    """The last n messages of every partition as of the call.

    From Kafka exactly those offsets are fetched. Of a folder whose files are all
    indexed (`index_offsets`) only the files that can hold such a message are read,
    at most n for each partition where files don't overlap; else all are. Messages
    without an offset come last. n rows per partition and task are kept before the
    shuffle.
    """
    if isinstance(topic, KafkaTopic):
        ends = latest_offsets(spark, topic)
        return read_messages(
            spark, topic, starting_offsets=tail_offsets(ends, n), ending_offsets=ends
        )
    names = tail_files(spark, topic.path, n)
    messages = read_messages(spark, topic)
    if names:
        messages = spark.read.schema(MESSAGES).parquet(*[f"{topic.path.rstrip('/')}/{x}" for x in names])
    return tail_per_partition(
        messages, partition=["topic", "partition"], position="offset", n=n
    ).drop("num_from_end")
