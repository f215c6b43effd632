"""Fact-to-dimension popularity rankings, reconciliation and hourly counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from weirflow.functions.calendar import utc_hour

_FACT_KEY, _FACTS, _COPIES = "_fact_key", "_fact_count", "_dimension_copies"


def _facts_per_key(facts: DataFrame, fact_key: str) -> DataFrame:
    return facts.groupBy(F.col(fact_key).alias(_FACT_KEY)).agg(F.count(F.lit(1)).alias(_FACTS))


def _dimension_per_key(dims: DataFrame, dim_key: str, attributes: Sequence[str]) -> DataFrame:
    # `min` gives the same attribute value on every run; `first` would depend
    # on row order. The attributes are functions of the key.
    return dims.groupBy(dim_key).agg(
        F.count(F.lit(1)).alias(_COPIES), *[F.min(a).alias(a) for a in attributes]
    )


def rank_by_popularity(
    facts: DataFrame,
    dims: DataFrame,
    *,
    fact_key: str,
    dim_key: str,
    attributes: Sequence[str],
    count_name: str = "num_pickups",
) -> DataFrame:
    """Facts per dimension key with the dimension's attributes, busiest first.

    Facts without a matching dimension row disappear (inner join). Facts are
    counted per key before the join: the fact table is never shuffled row by
    row, a hot key shrinks to one partial row per task, and the join only
    meets one row per key. Both sides come out of their aggregations hashed by
    the join key, so the join adds no shuffle; Spark broadcasts the dimension
    by itself when its measured size is below the session's threshold.
    A dimension key listed several times multiplies its count, as joining row
    by row would.
    """
    joined = _facts_per_key(facts, fact_key).join(
        _dimension_per_key(dims, dim_key, attributes), F.col(_FACT_KEY) == F.col(dim_key)
    )
    number = (F.col(_FACTS) * F.col(_COPIES)).alias(count_name)
    return joined.select(dim_key, number, *attributes).orderBy(F.desc(count_name), F.asc(dim_key))


def reconcile_counts(
    facts: DataFrame, dims: DataFrame, *, fact_key: str, dim_key: str
) -> DataFrame:
    """One row: raw fact count, fact count after the join, and whether they
    agree. One scan of the facts serves both numbers."""
    joined = _facts_per_key(facts, fact_key).join(
        _dimension_per_key(dims, dim_key, []), F.col(_FACT_KEY) == F.col(dim_key), "left"
    )
    totals = joined.agg(
        F.coalesce(F.sum(_FACTS), F.lit(0)).alias("num_raw"),
        F.coalesce(F.sum(F.col(_FACTS) * F.col(_COPIES)), F.lit(0)).alias("num_joined"),
    )
    return totals.select("*", (F.col("num_raw") == F.col("num_joined")).alias("is_equal"))


def count_by_hour(
    facts: DataFrame, timestamp: str, *, hour_name: str = "pickup_hour", count_name: str = "num_rides"
) -> DataFrame:
    """Rows per hour of day in UTC, by hour. Rows without a timestamp count
    under a NULL hour."""
    return (
        facts.select(utc_hour(facts, timestamp).alias(hour_name))
        .groupBy(hour_name)
        .agg(F.count(F.lit(1)).alias(count_name))
        .orderBy(hour_name)
    )
