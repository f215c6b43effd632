"""Message text to columns and back, with a split of unusable rows."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

RAW = "raw_message"


def parse_json_messages(
    df: DataFrame, schema: T.StructType, *, value: str = "value", keep: Sequence[str] = ()
) -> DataFrame:
    """Expand a JSON message column into the declared columns.

    The text stays in `raw_message`, so that rows routed to a bad-message
    output can be inspected and replayed. Broken text gives NULL columns.
    """
    text = F.col(value).cast("string")
    return _expand(df, text, F.from_json(text, schema), keep)


def parse_csv_messages(
    df: DataFrame,
    schema: T.StructType,
    *,
    value: str = "value",
    separator: str = ",",
    keep: Sequence[str] = (),
) -> DataFrame:
    """The same for one delimited line per message."""
    text = F.col(value).cast("string")
    parsed = F.from_csv(text, schema.toDDL(), {"header": "false", "sep": separator})
    return _expand(df, text, parsed, keep)


def _expand(df: DataFrame, text: Column, parsed: Column, keep: Sequence[str]) -> DataFrame:
    # `inline` turns the parsed struct into columns and, as a generator, keeps
    # the parse from being copied into every later expression: a filter on n
    # of the columns would otherwise be pushed down as n more parses per row.
    # An unreadable message is a struct of NULLs, so no row is lost.
    return df.select(*keep, text.alias(RAW), F.inline(F.array(parsed)))


def all_present(columns: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def split_usable(df: DataFrame, required: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with every required column, the rest); each row is in exactly one."""
    usable = all_present(required)
    return df.filter(usable), df.filter(~usable)


def json_value(columns: Sequence[str | Column] | None = None) -> Column:
    """The given columns (default: all) as one JSON text column named `value`."""
    packed = F.struct("*") if columns is None else F.struct(*columns)
    return F.to_json(packed).alias("value")


def first_or(array: Column | str, default: str) -> Column:
    """First array element; the default for an empty or missing array."""
    return F.coalesce(F.get(array, F.lit(0)), F.lit(default))
