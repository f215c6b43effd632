"""Batch jobs from input paths to written results."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weirflow.operators.datamart import TABLE, append_snapshot
from weirflow.operators.metrics import as_metric_rows, summary_metrics
from weirflow.operators.popularity import count_by_hour, rank_by_popularity
from weirflow.operators.ranking import top_k
from weirflow.functions.parsing import first_or
from weirflow.schemas import BOOKS, COUNTRIES, TAXI_ZONES
from weirflow.sinks.files import save_json_array, save_parquet
from weirflow.sinks.messages import as_messages, publish
from weirflow.sources.files import read_csv, read_json_arrays, read_lines_numbered, read_parquet
from weirflow.sources.jdbc import JdbcDatabase
from weirflow.sources.messages import Topic


def popular_zones(spark: SparkSession, facts: str, zones: str, output: str) -> dict[str, int]:
    """Pickup zones by popularity, written as Parquet files that follow each
    other in rank order; returns raw and joined fact counts, of which the second
    is observed while writing."""
    rides = read_parquet(spark, facts)
    ranked = rank_by_popularity(
        rides,
        read_csv(spark, zones, TAXI_ZONES),
        fact_key="PULocationID",
        dim_key="LocationID",
        attributes=["Borough", "Zone", "service_zone"],
    )
    seen = Observation("popular_zones")
    save_parquet(ranked.observe(seen, F.sum("num_pickups").alias("joined")), output)
    return {"raw": rides.count(), "joined": seen.get["joined"] or 0}


def popular_hours(spark: SparkSession, facts: str, output: str) -> None:
    """Pickups per UTC hour; at most 25 rows, written as one file."""
    rides = read_parquet(spark, facts)
    save_parquet(count_by_hour(rides, "tpep_pickup_datetime"), output, single_file=True)


def distance_datamart(
    spark: SparkSession, facts: str, database: JdbcDatabase, table: str = TABLE
) -> int:
    """Append the trip distance metrics as a new snapshot; returns its id."""
    rides = read_parquet(spark, facts)
    return append_snapshot(as_metric_rows(summary_metrics(rides, "trip_distance")), database, table)


def largest_countries(countries: DataFrame, region: str = "Africa", k: int = 10) -> DataFrame:
    """The k largest countries of a region: official name, first capital, area."""
    ordered = top_k(
        countries.filter(F.col("region") == region),
        [F.desc("area"), F.asc("name.official")],
        k,
    )
    return ordered.select(
        F.col("name.official").alias("name"),
        first_or("capital", "<Undefined>").alias("capital"),
        "area",
    )


def country_report(
    spark: SparkSession, source: str, output: str, region: str = "Africa", k: int = 10
) -> None:
    """Read country documents, write the top k as one JSON array."""
    largest = largest_countries(read_json_arrays(spark, source, COUNTRIES), region, k)
    save_json_array(largest, output, rows_per_document=k)


def publish_books(spark: SparkSession, source: str, topic: Topic) -> None:
    """Book rows of a CSV file as JSON messages under the book's name."""
    publish(as_messages(read_csv(spark, source, BOOKS, strict=True), key="Name"), topic)


def publish_lines(spark: SparkSession, source: str, topic: Topic) -> None:
    """The lines of a text file, header dropped, under their running number.
    Pacing is the reader's: see `max_per_trigger` of the message stream."""
    publish(read_lines_numbered(spark, source), topic)
