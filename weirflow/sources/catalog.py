"""Catalog tables and views over existing files."""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T


def _literal(path: str) -> str:
    return "'" + path.replace("\\", "\\\\").replace("'", "\\'") + "'"


def create_database(spark: SparkSession, name: str, location: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {_literal(location)}")


def external_parquet_table(
    spark: SparkSession, name: str, location: str, schema: T.StructType | None = None
) -> None:
    """Table over a folder of Parquet files; dropping it keeps the files.
    Without a schema the file footer decides."""
    columns = f" ({schema.toDDL()})" if schema is not None else ""
    spark.sql(f"CREATE TABLE {name}{columns} USING parquet LOCATION {_literal(location)}")


def external_text_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType,
    *,
    separator: str = ",",
    header: bool = True,
) -> None:
    """Table over delimited text whose first line per file is a header."""
    spark.sql(
        f"CREATE TABLE {name} ({schema.toDDL()}) USING csv "
        f"OPTIONS (header '{str(header).lower()}', sep {_literal(separator)}) "
        f"LOCATION {_literal(location)}"
    )


def columnar_copy(spark: SparkSession, name: str, source: str, schema: T.StructType) -> None:
    """Managed ORC table with the declared columns, filled from `source`."""
    columns = ", ".join(f"`{c}`" for c in schema.fieldNames())
    spark.sql(f"CREATE TABLE {name} ({schema.toDDL()}) USING orc")
    spark.sql(f"INSERT INTO {name} SELECT {columns} FROM {source}")


def create_view(spark: SparkSession, name: str, query: str) -> None:
    """Persistent view; its query is planned anew on every use."""
    spark.sql(f"CREATE VIEW {name} AS {query}")
