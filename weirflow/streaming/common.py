"""Triggers, checkpoints and stopping."""

from __future__ import annotations

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def default_checkpoint(output: str, checkpoint: str | None) -> str:
    """The given folder, else a dot folder in the output, which reads ignore."""
    return checkpoint or output.rstrip("/") + "/.checkpoint"


def start(
    writer: DataStreamWriter,
    *,
    period_seconds: float | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Start with a fixed period, or run over what is there now and end, or
    (neither given) begin each micro-batch as soon as the last one is done."""
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif period_seconds is not None:
        writer = writer.trigger(processingTime=f"{period_seconds:g} seconds")
    return writer.start()


def run_until_stopped(query: StreamingQuery) -> None:
    """Wait for the query; on exit or interrupt let it stop cleanly."""
    try:
        query.awaitTermination()
    finally:
        if query.isActive:
            query.stop()
