"""Top-k, first and last row, tail per partition and global row numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weirflow.workspace import materialize


def top_k(df: DataFrame, order: Sequence[Column], k: int = 10) -> DataFrame:
    """First k rows of the order. Every task keeps k rows, nothing is sorted
    as a whole. End `order` with a unique column so that ties are settled."""
    return df.orderBy(*order).limit(k)


def first_and_last(
    df: DataFrame, *, order: Sequence[Column], reverse: Sequence[Column]
) -> DataFrame:
    """First and last row of an order with a `position` column, without
    bringing the rows between them to the driver. `reverse` is `order` turned
    round."""
    first = df.orderBy(*order).limit(1).select(F.lit("first").alias("position"), "*")
    last = df.orderBy(*reverse).limit(1).select(F.lit("last").alias("position"), "*")
    return first.unionByName(last)


def tail_per_partition(
    df: DataFrame, *, partition: Sequence[str], position: str, n: int = 5
) -> DataFrame:
    """The n rows with the highest position in every partition, with
    `num_from_end` counting from the end (1 is the newest).

    Spark keeps n rows per partition and task before it shuffles, so a
    partition holding most of the table sends no more than n rows per task.
    """
    newest_first = Window.partitionBy(*partition).orderBy(F.desc(position))
    return df.withColumn("num_from_end", F.row_number().over(newest_first)).filter(
        F.col("num_from_end") <= n
    )


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "row_num") -> DataFrame:
    """Number all rows 1, 2, 3, … in a global order.

    A window over the whole table would run in one task. Here the rows are
    range-sorted in parallel and written once with (task, position in task);
    a row's number is its position plus the rows of the tasks before it. Only
    one count per task goes through the small window below. The written copy is
    an intermediate table: see `intermediates` for when it goes.
    """
    mark = F.monotonically_increasing_id()
    fixed = materialize(
        df.orderBy(*order)
        .withColumn("_mark", mark)
        .withColumn("_task", F.shiftright("_mark", 33))
        .withColumn("_place", F.col("_mark") - F.shiftleft(F.col("_task"), 33))
        .drop("_mark"),
        "numbered",
    )
    sizes = fixed.groupBy("_task").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_task", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before")
    )
    return fixed.join(offsets, "_task").select(
        *df.columns, (F.col("_before") + F.col("_place") + 1).alias(name)
    )
