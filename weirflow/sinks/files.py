"""File sinks: Parquet, CSV, JSON lines, JSON array documents, day folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from weirflow.operators.documents import pack_json_arrays
from weirflow.workspace import materialize


def save_parquet(
    df: DataFrame, path: str, *, mode: str = "overwrite", single_file: bool = False
) -> None:
    """Write Parquet. `single_file` puts the last stage in one task, so ask for
    it only for small results; a sorted small result ends up in few files
    anyway because adaptive execution merges its partitions."""
    (df.coalesce(1) if single_file else df).write.mode(mode).parquet(path)


def save_csv(df: DataFrame, path: str, *, header: bool = True, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", header).csv(path)


def save_by_partition(
    df: DataFrame, path: str, columns: Sequence[str], *, fmt: str = "json", mode: str = "overwrite"
) -> None:
    """Write folders per value of the partition columns.

    Rows are brought together by those columns first, so that a folder gets few
    files; the rebalance splits a value that holds much of the table over
    several tasks, which a plain repartition would send to one.
    """
    df.hint("rebalance", *columns).write.mode(mode).partitionBy(*columns).format(fmt).save(path)


def save_json_array(
    df: DataFrame, path: str, *, rows_per_document: int, mode: str = "overwrite"
) -> None:
    """Write JSON array documents, one per file, each of at most
    `rows_per_document` rows. A table of up to that many rows in one partition,
    such as a top-k, becomes one document; an empty table becomes one empty array.
    See `operators.documents.rows_per_document` for wide rows."""
    seen = Observation("documents")
    documents = pack_json_arrays(df, rows_per_document).observe(seen, F.count(F.lit(1)).alias("n"))
    documents.write.mode(mode).option("maxRecordsPerFile", 1).text(path)
    if not seen.get["n"]:
        df.sparkSession.range(1).select(F.lit("[]").alias("value")).write.mode("append").text(path)


def save_json_document(
    df: DataFrame, path: str, *, order: Sequence[Column] = (), mode: str = "overwrite"
) -> None:
    """Write one JSON array of any size as ordered part files: their concatenation
    in the order of their names is the document, and `read_json_array_split` reads
    the folder as one with `parts=True`.

    Every row is a line that begins with a comma, the first with the opening
    bracket; the last line closes. Rows come in the given order, or as the table has
    them. No task holds more than its rows, and only the number of the first row
    reaches the driver. An empty table becomes `[]`. Part files sort by name up to
    100,000 of them.
    """
    rows = df.orderBy(*order) if order else df
    line = F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")
    lines = materialize(rows.select(line, F.monotonically_increasing_id().alias("mark")), "lines")
    first = lines.agg(F.min("mark")).first()[0]
    opening = F.when(F.col("mark") == F.lit(first), "[").otherwise(",")
    closing = df.sparkSession.range(1).select(
        F.lit("[]" if first is None else "]").alias("value"), F.lit(2**63 - 1).alias("mark")
    )
    (
        lines.select(F.concat(opening, "value").alias("value"), "mark")
        .unionByName(closing).orderBy("mark").select("value").write.mode(mode).text(path)
    )
