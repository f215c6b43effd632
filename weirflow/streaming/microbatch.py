"""Micro-batch callbacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StreamingQuery

from weirflow.sinks.messages import publish
from weirflow.sources.messages import Topic
from weirflow.streaming.common import start

BatchSink = Callable[[DataFrame, int], None]


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for a micro-batch that no batch of another query has: batch ids
    start at 0 again with every new checkpoint, query ids don't."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query or 'query'}-{batch_id}"


def for_each_batch(
    rows: DataFrame,
    sink: BatchSink,
    checkpoint: str,
    *,
    period_seconds: float | None = None,
    available_now: bool = False,
    keep: bool = True,
) -> StreamingQuery:
    """Hand every non-empty micro-batch to `sink(batch, batch_id)`. It is kept
    while the sink runs, so the source is read once however often the sink and
    the test for rows use it. A sink that reads its batch once, as one that keeps
    what it derives, does without (`keep=False`); the test for rows then reads up to
    the first."""

    def call(batch: DataFrame, batch_id: int) -> None:
        if not keep:
            if not batch.isEmpty():
                sink(batch, batch_id)
            return
        batch.persist()
        try:
            if not batch.isEmpty():
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint)
    return start(writer, period_seconds=period_seconds, available_now=available_now)


def batch_folder_sink(path: str, fmt: str = "parquet") -> BatchSink:
    """Writes each batch to its own folder; a batch that runs again after a
    failure replaces its earlier attempt, so no row lands twice."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        batch.write.mode("overwrite").format(fmt).save(f"{path}/batch_id={name}")

    return sink


def message_sink(topic: Topic) -> BatchSink:
    """Sends each batch to a topic, under its name."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        publish(batch, topic, batch=batch_name(batch, batch_id))

    return sink


def client_sink(send_rows: Callable[[Iterable[Row]], None]) -> BatchSink:
    """Sends rows from the executors to an outside system. `send_rows` runs
    once per partition and opens one client for all of its rows. A partition
    that runs again sends its rows again, so receivers should know them by key."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.foreachPartition(send_rows)

    return sink


def fan_out(*sinks: BatchSink) -> BatchSink:
    """Several outputs of one micro-batch."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        for one in sinks:
            one(batch, batch_id)

    return sink


def both_outputs(
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]], sink: BatchSink, bad_sink: BatchSink
) -> BatchSink:
    """Hands the usable and the unusable messages of a micro-batch on. Both stem
    from one read, so every message reaches exactly one of them."""

    def run(batch: DataFrame, batch_id: int) -> None:
        good, bad = split(batch)
        sink(good, batch_id)
        bad_sink(bad, batch_id)

    return run
