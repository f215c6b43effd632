"""Streams that parse messages and land them in year/month/day folders. Lines
that can't be used go to an output of their own, as they came."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from weirflow.functions.calendar import SECONDS_PATTERN, date_parts, parse_timestamp, with_calendar
from weirflow.functions.parsing import RAW, parse_csv_messages, parse_json_messages, split_usable
from weirflow.schemas import OCCUPANCY_LINE, OCCUPANCY_PREDICTION
from weirflow.streaming.common import default_checkpoint
from weirflow.streaming.microbatch import batch_name, both_outputs, for_each_batch

DAY_FOLDERS = ("year", "month", "day")


def timed_lines(
    messages: DataFrame,
    schema: T.StructType = OCCUPANCY_LINE,
    *,
    time_column: str = "date",
    pattern: str = SECONDS_PATTERN,
) -> DataFrame:
    """Delimited message lines as columns, with the time parsed to `timestamp`.
    Unparsable fields are NULL; the line itself stays in `raw_message`."""
    rows = parse_csv_messages(messages, schema)
    return rows.withColumn("timestamp", parse_timestamp(time_column, pattern))


def measurements(
    messages: DataFrame, schema: T.StructType = OCCUPANCY_LINE, *, time_column: str = "date"
) -> tuple[DataFrame, DataFrame]:
    """(rows as they land in the JSON lake: fields and calendar columns; the
    lines without a time as `raw_message`)."""
    rows, bad = split_usable(timed_lines(messages, schema, time_column=time_column), ["timestamp"])
    landed = with_calendar(rows.drop(RAW, time_column), "timestamp").drop("timestamp")
    return landed, bad.select(RAW)


def predictions(
    messages: DataFrame,
    schema: T.StructType = OCCUPANCY_PREDICTION,
    *,
    time_column: str = "Timestamp",
) -> tuple[DataFrame, DataFrame]:
    """(JSON prediction messages as typed rows with year, month and day; the
    messages without a time as `raw_message`)."""
    parsed = parse_json_messages(messages, schema)
    timed = parsed.withColumn(time_column, parse_timestamp(time_column))
    rows, bad = split_usable(timed, [time_column])
    return rows.select(*schema.fieldNames(), *date_parts(time_column)), bad.select(RAW)


def land(
    messages: DataFrame,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]],
    path: str,
    bad_path: str,
    *,
    fmt: str,
    checkpoint: str | None = None,
    folders: Sequence[str] = DAY_FOLDERS,
    period_seconds: float | None = None,
    available_now: bool = False,
) -> StreamingQuery:
    """Land a message stream in partitioned files, and its unusable messages as
    text in `bad_path`.

    Both come from one read of the stream. Within a day every micro-batch has a
    folder of its own, which a repeated attempt replaces, so a restarted query
    adds nothing twice. A batch's rows are brought together by day first, a day
    with much of them over several tasks.
    """

    def day_folders(batch: DataFrame, batch_id: int) -> None:
        named = batch.hint("rebalance", *folders).withColumn(
            "batch", F.lit(batch_name(batch, batch_id))
        )
        (
            named.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            .partitionBy(*folders, "batch").format(fmt).save(path)
        )

    def bad_lines(batch: DataFrame, batch_id: int) -> None:
        target = f"{bad_path}/batch={batch_name(batch, batch_id)}"
        batch.write.mode("overwrite").parquet(target)

    return for_each_batch(
        messages,
        both_outputs(split, day_folders, bad_lines),
        default_checkpoint(path, checkpoint),
        period_seconds=period_seconds,
        available_now=available_now,
    )
