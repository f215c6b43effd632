"""Weighted rendezvous hashing of record keys to shards.

Every (key, shard) has a score from their hash; a record goes to the shard with
the highest. Adding a shard adds one score per record and changes no other, so
a record either stays or moves to the new shard. Weights enter by
-weight / ln(u), u the hash as a number between 0 and 1: the shard's share of
the records is its share of the weights.

Only DataFrame functions are used. Places within a shard are counted per input
task and offset by prefix sums, so that no shard is gathered in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from weirflow.llm.common import query
from weirflow.plans.registry import table
from weirflow.workspace import materialize

SHARDS = 24
ROW_BYTES = 8
_HALF = float(1 << 52)


def score(key: Column, shard: int, weight: float) -> Column:
    """Score of a shard for a key; the hash's upper 52 bits make u."""
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(shard)), 12).cast("double") + 0.5) / F.lit(_HALF)
    return F.lit(float(weight)) / -F.log(u)


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """Number of the shard with the highest score; the lower number on a tie."""
    if not weights or min(weights) <= 0:
        raise ValueError("every shard needs a weight above zero")
    scores = [
        F.struct(score(key, n, w).alias("score"), F.lit(-n).alias("shard"))
        for n, w in enumerate(weights)
    ]
    best = scores[0] if len(scores) == 1 else F.greatest(*scores)
    return (-best["shard"]).cast("int")


def shard_rows(rows: DataFrame, *, key: str, weights: Sequence[float]) -> DataFrame:
    """Add to a table of `row` structs the `shard` (by `row.key` and the weights),
    the `slot` (its place in the shard, gapless from 0), and `grown_shard` (the
    shard if one more with the mean weight is added).

    Rows with equal keys share a shard; the null key is a key of its own. Rows
    may repeat, and each gets a slot.
    """
    mean = sum(weights) / len(weights)
    own_key = F.coalesce(F.col("row")[key].cast("string"), F.lit("\0null"))
    mark = F.monotonically_increasing_id()
    placed = materialize(
        rows.select(
            "row", rendezvous(own_key, weights).alias("shard"),
            rendezvous(own_key, [*weights, mean]).alias("grown_shard"),
            mark.alias("mark"), F.shiftrightunsigned(mark, 33).alias("task"),
        ),
        "shards",
    )
    sizes = placed.groupBy("shard", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = sizes.select(
        "shard", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")
    )
    in_task = Window.partitionBy("shard", "task").orderBy("mark")
    return (
        placed.withColumn("place", F.row_number().over(in_task) - 1)
        .join(before, ["shard", "task"])
        .select("row", "shard", (F.col("before") + F.col("place")).alias("slot"), "grown_shard")
    )


@query("op7_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(F.struct(
        "doc_id", (F.octet_length(data) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.lit("key").alias("law"),
    ).alias("row"))
    placed = shard_rows(rows, key="doc_id", weights=[1.0] * SHARDS)
    return placed.select("row.*", "shard", "slot", "grown_shard")
