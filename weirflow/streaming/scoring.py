"""Scoring of message streams with a fitted model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F, types as T

from weirflow.functions.calendar import with_calendar
from weirflow.functions.parsing import (
    RAW, all_present, json_value, parse_json_messages, split_usable,
)
from weirflow.schemas import IRIS_MEASURES, OCCUPANCY_LINE
from weirflow.streaming.landing import timed_lines
from weirflow.streaming.microbatch import BatchSink, both_outputs

# Columns the occupancy model is trained on. Seconds are left out.
OCCUPANCY_FEATURES = (
    "year", "month", "day", "hour", "minute",
    "Temperature", "Humidity", "Light", "CO2", "HumidityRatio",
)


def score_json_messages(
    messages: DataFrame,
    model: PipelineModel,
    *,
    measures: T.StructType = IRIS_MEASURES,
    predicted: str = "predictedSpecies",
    output: str = "predicted_species",
) -> tuple[DataFrame, DataFrame]:
    """(scored messages, unusable messages).

    A scored message has the predicted class as key and the measures with the
    class as JSON value. The model would fail on a NULL measure and stop the
    query, so messages that lack one go to the second output as raw text.
    """
    return _score_parsed(parse_json_messages(messages, measures), model, measures, predicted, output)


def _score_parsed(parsed, model, measures, predicted, output) -> tuple[DataFrame, DataFrame]:
    rows, bad = split_usable(parsed, measures.fieldNames())
    scored = model.transform(rows.drop(RAW)).select(
        *measures.fieldNames(), F.col(predicted).alias(output)
    )
    return scored.select(F.col(output).alias("key"), json_value()), bad.select(
        F.col(RAW).alias("value")
    )


def scoring_sink(
    model: PipelineModel,
    sink: BatchSink,
    bad_sink: BatchSink,
    *,
    measures: T.StructType = IRIS_MEASURES,
    predicted: str = "predictedSpecies",
    output: str = "predicted_species",
) -> BatchSink:
    """Scores a micro-batch of raw JSON messages and hands both outputs on. It keeps
    the measures, and the text of unusable messages alone, so the batch itself need
    not be kept."""
    usable = all_present(measures.fieldNames())

    def run(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_json_messages(batch, measures).withColumn(
            RAW, F.when(~usable, F.col(RAW))
        ).persist()
        try:
            both = both_outputs(
                lambda rows: _score_parsed(rows, model, measures, predicted, output), sink, bad_sink
            )
            both(parsed, batch_id)
        finally:
            parsed.unpersist()

    return run


def score_lines(
    messages: DataFrame,
    model: PipelineModel,
    *,
    schema: T.StructType = OCCUPANCY_LINE,
    time_column: str = "date",
    features: Sequence[str] = OCCUPANCY_FEATURES,
    label: str = "Occupancy",
) -> tuple[DataFrame, DataFrame]:
    """(scored messages, unusable messages) for delimited lines.

    The value holds Timestamp, the label sent along, and the integer
    Prediction. Calendar columns stem from the line's time.
    """
    # The calendar columns are NULL exactly when the time is, so the time is
    # checked before they are derived.
    sent = [c for c in schema.fieldNames() if c in features]
    rows, bad = split_usable(
        timed_lines(messages, schema, time_column=time_column), ["timestamp", *sent]
    )
    timed = with_calendar(rows.drop(RAW, time_column), "timestamp")
    scored = model.transform(timed).select(
        F.col("timestamp").alias("Timestamp"),
        F.col(label),
        F.col("prediction").cast("int").alias("Prediction"),
    )
    return scored.select(json_value()), bad.select(F.col(RAW).alias("value"))
