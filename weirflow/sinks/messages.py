"""Message sinks: Kafka, or a folder of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions.parsing import json_value
from weirflow.sources.messages import KafkaTopic, Topic


def as_messages(
    df: DataFrame, *, key: str | Column | None = None, columns: Sequence[str | Column] | None = None
) -> DataFrame:
    """(key, value) rows: the record as JSON text under a business key."""
    value = json_value(columns)
    if key is None:
        return df.select(value)
    key = F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), value)


def publish(messages: DataFrame, topic: Topic, *, batch: str | None = None) -> None:
    """Write a bounded table of messages; acknowledged by all replicas on Kafka.

    In a folder, messages of a named `batch` replace those of an earlier attempt
    at it. Kafka has no such names: a batch that runs again is sent again, so
    receivers should know messages by key or content.
    """
    if isinstance(topic, KafkaTopic):
        (
            messages.write.format("kafka")
            .options(**{"kafka.acks": "all", **topic.settings()})
            .option("topic", topic.topic)
            .save()
        )
    elif batch is None:
        _stored(messages).write.mode("append").parquet(topic.path)
    else:
        _stored(messages).write.mode("overwrite").parquet(f"{topic.path}/{batch}")


def _stored(messages: DataFrame) -> DataFrame:
    # A folder has no broker to hand out positions; keep the ones present.
    present = set(messages.columns)
    columns = {
        "key": F.col("key").cast("binary") if "key" in present else F.lit(None).cast("binary"),
        "value": F.col("value").cast("binary"),
        "topic": F.col("topic") if "topic" in present else F.lit(None).cast("string"),
        "partition": F.col("partition") if "partition" in present else F.lit(None).cast("int"),
        "offset": F.col("offset") if "offset" in present else F.lit(None).cast("long"),
        "timestamp": F.col("timestamp") if "timestamp" in present else F.current_timestamp(),
    }
    return messages.select(*[c.alias(n) for n, c in columns.items()])
