"""Console preview."""

from __future__ import annotations

from pyspark.sql import DataFrame


def preview(df: DataFrame, n: int = 10) -> None:
    """Print the first n rows with their values in full; only n rows are fetched."""
    df.show(n, truncate=False)
