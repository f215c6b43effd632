"""Rows packed into JSON array documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def rows_per_document(df: DataFrame, document_bytes: int = 64 << 20) -> int:
    """Rows of which a document of about `document_bytes` can hold any, by the
    widest row of the table (one pass)."""
    width = F.max(F.octet_length(F.to_json(F.struct("*"))))
    widest = df.agg(F.coalesce(width, F.lit(1)).alias("w")).first()[0]
    return max(1, document_bytes // (widest + 1))


def pack_json_arrays(df: DataFrame, rows_per_document: int) -> DataFrame:
    """Several rows `value`, each a JSON array of at most `rows_per_document`
    rows, so that no task ever holds more than that."""
    if rows_per_document < 1:
        raise ValueError("rows_per_document must be positive")
    placed = df.select(
        F.monotonically_increasing_id().alias("pos"), F.struct("*").alias("item")
    )
    chunk = F.floor(F.col("pos") / F.lit(rows_per_document))
    return placed.groupBy(chunk.alias("chunk")).agg(_array_text()).select("value")


def _array_text():
    ordered = F.array_sort(F.collect_list(F.struct("pos", "item")))
    return F.to_json(F.transform(ordered, lambda e: e["item"])).alias("value")
