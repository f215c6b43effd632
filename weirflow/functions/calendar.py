"""Timestamp parsing and calendar parts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

SECONDS_PATTERN = "yyyy-MM-dd HH:mm:ss"


def parse_timestamp(column: Column | str, pattern: str | None = None) -> Column:
    """Text to timestamp; unparsable text gives NULL instead of an error, also
    under ANSI mode, so one bad message does not stop a stream."""
    column = F.col(column) if isinstance(column, str) else column
    if pattern is None:
        return F.try_to_timestamp(column)
    return F.try_to_timestamp(column, F.lit(pattern))


def date_parts(timestamp: Column | str) -> list[Column]:
    return [
        F.year(timestamp).alias("year"),
        F.month(timestamp).alias("month"),
        F.dayofmonth(timestamp).alias("day"),
    ]


def time_parts(timestamp: Column | str) -> list[Column]:
    return [
        F.hour(timestamp).alias("hour"),
        F.minute(timestamp).alias("minute"),
        F.second(timestamp).alias("second"),
    ]


def with_calendar(df: DataFrame, timestamp: str) -> DataFrame:
    """All columns plus year, month, day, hour, minute and second."""
    return df.select("*", *date_parts(timestamp), *time_parts(timestamp))


def utc_hour(df: DataFrame, timestamp: str) -> Column:
    """Hour of day in UTC whatever the session time zone is.

    A timestamp without zone carries no offset and is taken as it stands.
    """
    if isinstance(df.schema[timestamp].dataType, T.TimestampNTZType):
        return F.hour(timestamp)
    epoch_hours = F.floor(F.unix_seconds(F.col(timestamp)) / F.lit(3600))
    return F.pmod(epoch_hours, F.lit(24)).cast("int")
