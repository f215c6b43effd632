"""Tables kept by ranges of a key, with an index of the ranges beside the data.

`data/key_range=<n>` holds the rows of one range and `index` one row per range with
its bounds, half open, and its size. Ranges hold about equal numbers of rows, but a
key that would fill more than one has a range of its own, and so have the rows
without a key; such ranges are written by several tasks. A reader asks the index
first and opens only the folders of the ranges it needs.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from weirflow.operators.chunks import key_chunks, place_among

MOST_RANGES = 1024
RANGE = "key_range"
NO_KEY = -1


def range_starts(df: DataFrame, *, key: str, tie: str, rows_per_range: int) -> tuple[list[Any], list[Any]]:
    """The first keys of the ranges in order, at most MOST_RANGES, and those of them
    that begin more than one chunk and so fill at least one."""
    known = df.filter(F.col(key).isNotNull())
    size = max(rows_per_range, -(-known.count() // MOST_RANGES))
    starts = key_chunks(known, key=key, tie=tie, size=size).groupBy("first_key").agg(
        F.count(F.lit(1)).alias("n")
    )
    found = starts.orderBy("first_key").collect()
    return [r["first_key"] for r in found], [r["first_key"] for r in found if r["n"] > 1]


def range_of(key: Column, kind: T.DataType, starts: list[Any], hot: list[Any]) -> Column:
    """The number of a key's range. Start p has the ranges 2p and 2p + 1: the first
    for the start itself if it is hot, the second for all others up to the next."""
    def literal(values):
        return F.array(*[F.lit(v).cast(kind) for v in values]).cast(T.ArrayType(kind))

    place = place_among(key, literal(starts), len(starts)) - 1
    alone = F.array_contains(literal(hot), key)
    return F.when(key.isNull(), NO_KEY).otherwise(2 * place + F.when(alone, 0).otherwise(1))


def write_range_table(df: DataFrame, path: str, *, key: str, tie: str, rows_per_range: int) -> None:
    """Write a table by ranges of `key` of about `rows_per_range` rows, replacing
    what is there. `tie` tells rows of one key apart where the ranges are measured.

    The index is written last, from the data as they are on disk.
    """
    if RANGE in df.columns:
        raise ValueError(f"a column must not be named {RANGE}")
    spark, root = df.sparkSession, path.rstrip("/")
    kind = df.schema[key].dataType
    starts, hot = range_starts(df, key=key, tie=tie, rows_per_range=rows_per_range)
    placed = df.withColumn(RANGE, range_of(F.col(key), kind, starts, hot))
    placed.hint("rebalance", RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(f"{root}/data")
    schema = T.StructType([*df.schema.fields, T.StructField(RANGE, T.IntegerType())])
    sizes = spark.read.schema(schema).parquet(f"{root}/data").groupBy(RANGE).agg(
        F.min(key).alias("low"), F.count(F.lit(1)).alias("num_rows")
    )
    following = Window.partitionBy(F.col(RANGE) == NO_KEY).orderBy(RANGE)
    sizes.withColumn("high", F.lead("low").over(following)).coalesce(1).write.mode("overwrite").parquet(
        f"{root}/index"
    )
    about = spark.range(1).select(F.lit(key).alias("key"), F.lit(df.schema.json()).alias("schema"))
    about.coalesce(1).write.mode("overwrite").parquet(f"{root}/about")


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """(key_range, low, high, num_rows): keys from `low` up to, not including,
    `high`; the last range has no `high`, and that of the rows without a key
    (number -1) neither bound."""
    return spark.read.parquet(f"{path.rstrip('/')}/index").select(RANGE, "low", "high", "num_rows")


def read_key_range(
    spark: SparkSession, path: str, low: Any = None, high: Any = None, *, nulls: bool = False
) -> DataFrame:
    """The rows with low <= key <= high, without a bound that is None, and with
    `nulls` those without a key. The numbers of the ranges reach the driver, at most
    two for each of MOST_RANGES; the folders of others are neither listed nor read.
    """
    root = path.rstrip("/")
    about = spark.read.parquet(f"{root}/about").first()
    key, schema = about["key"], T.StructType.fromJson(json.loads(about["schema"]))
    kind = schema[key].dataType
    known, within = F.col(RANGE) != NO_KEY, F.col(key).isNotNull()
    if high is not None:
        known &= F.col("low") <= F.lit(high).cast(kind)
        within &= F.col(key) <= F.lit(high).cast(kind)
    if low is not None:
        known &= F.col("high").isNull() | (F.col("high") > F.lit(low).cast(kind))
        within &= F.col(key) >= F.lit(low).cast(kind)
    if nulls:
        known |= F.col(RANGE) == NO_KEY
        within |= F.col(key).isNull()
    ranges = sorted(r[0] for r in read_index(spark, root).filter(known).select(RANGE).collect())
    if not ranges:
        return spark.createDataFrame([], schema)
    folders = [f"{root}/data/{RANGE}={n}" for n in ranges]
    return spark.read.schema(schema).parquet(*folders).filter(within)

