"""Streaming jobs of the occupancy and flower systems. Each returns the running
query; callers wait with `run_until_stopped`."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from weirflow.functions.calendar import SECONDS_PATTERN, parse_timestamp, with_calendar
from weirflow.functions.parsing import split_usable
from weirflow.ml.training import (
    Trained, load_model, save_model, train_classifier, train_text_classifier,
)
from weirflow.schemas import IRIS, IRIS_MEASURES, OCCUPANCY_LAKE, OCCUPANCY_LINE
from weirflow.sources.files import read_csv, read_day
from weirflow.sources.messages import Reading, Topic, stream_messages
from weirflow.streaming.landing import land, measurements, predictions
from weirflow.streaming.microbatch import BatchSink, both_outputs, for_each_batch, message_sink
from weirflow.streaming.scoring import OCCUPANCY_FEATURES, score_lines, scoring_sink


def ingest_occupancy(
    spark: SparkSession, source: Topic, landing_zone: str, bad_lines: str, *,
    checkpoint: str | None = None, reading: Reading = Reading(), **trigger,
) -> StreamingQuery:
    """Sensor lines → JSON lake by day; lines without a time go to `bad_lines`."""
    messages = stream_messages(spark, source, reading)
    return land(messages, measurements, landing_zone, bad_lines, fmt="json",
                checkpoint=checkpoint, **trigger)


def train_occupancy(
    spark: SparkSession, source: str, output: str, *, day: str | None = None, seed: int = 42
) -> Trained:
    """Train on a CSV file, or on one day of the JSON lake, and save the model.
    Rows that lack a value are left out and counted in `removed`."""
    if day is None:
        lines = read_csv(spark, source, OCCUPANCY_LINE)
        timed = lines.withColumn("timestamp", parse_timestamp("date", SECONDS_PATTERN))
        rows = with_calendar(timed, "timestamp").drop("date", "timestamp")
    else:
        rows = read_day(spark, source, OCCUPANCY_LAKE, day)
    usable, unusable = split_usable(rows, [*OCCUPANCY_FEATURES, "Occupancy"])
    trained = train_classifier(usable, features=OCCUPANCY_FEATURES, label="Occupancy", seed=seed)
    save_model(trained.model, output)
    return replace(trained, removed=unusable.count())


def train_flowers(spark: SparkSession, source: str, output: str, *, seed: int = 42) -> Trained:
    """Train the species classifier on a CSV file and save it; rows that lack a
    value are left out and counted in `removed`."""
    measures = IRIS_MEASURES.fieldNames()
    usable, unusable = split_usable(read_csv(spark, source, IRIS), [*measures, "species"])
    trained = train_text_classifier(usable, features=measures, label="species", seed=seed)
    save_model(trained.model, output)
    return replace(trained, removed=unusable.count())


def score_flowers(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    bad_target: Topic,
    model_path: str,
    checkpoint: str,
    *,
    reading: Reading = Reading(),
    **trigger,
) -> StreamingQuery:
    """Measurements → species messages; bad messages go to their own topic. One
    query with one checkpoint feeds both."""
    return score_flowers_by_batch(
        spark, source, message_sink(target), message_sink(bad_target), model_path, checkpoint,
        reading=reading, **{"period_seconds": None, **trigger},
    )


def score_occupancy(
    spark: SparkSession,
    source: Topic,
    target: Topic,
    bad_target: Topic,
    model_path: str,
    checkpoint: str,
    *,
    reading: Reading = Reading(),
    **trigger,
) -> StreamingQuery:
    """Sensor lines → prediction messages; bad lines go to their own topic. One
    query with one checkpoint feeds both."""
    model = load_model(model_path)
    outputs = both_outputs(
        lambda batch: score_lines(batch, model), message_sink(target), message_sink(bad_target)
    )
    return for_each_batch(stream_messages(spark, source, reading), outputs, checkpoint, **trigger)


def score_flowers_by_batch(
    spark: SparkSession,
    source: Topic,
    sink: BatchSink,
    bad_sink: BatchSink,
    model_path: str,
    checkpoint: str,
    *,
    reading: Reading = Reading(),
    period_seconds: float | None = 1,
    available_now: bool = False,
) -> StreamingQuery:
    """The same with one callback per micro-batch, every second by default."""
    return for_each_batch(
        stream_messages(spark, source, reading),
        scoring_sink(load_model(model_path), sink, bad_sink),
        checkpoint,
        period_seconds=period_seconds,
        available_now=available_now,
        keep=False,
    )


def land_predictions(
    spark: SparkSession, source: Topic, output: str, bad_messages: str, *,
    checkpoint: str | None = None, reading: Reading = Reading(), **trigger,
) -> StreamingQuery:
    """Prediction messages → Parquet by day; those without a time go to
    `bad_messages`."""
    messages = stream_messages(spark, source, reading)
    return land(messages, predictions, output, bad_messages, fmt="parquet",
                checkpoint=checkpoint, **trigger)
