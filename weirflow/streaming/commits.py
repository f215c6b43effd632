"""All outputs of a micro-batch become visible at once.

Outputs are written one after the other, each under the batch's name. When all are
there, the name goes into a manifest, a table beside them, and readers take the
batches of the manifest only: a batch that failed between two outputs shows none.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.sources.hadoop import filesystem, hadoop_path
from weirflow.streaming.microbatch import BatchSink, batch_name

MANIFEST = "batch string, committed timestamp"


def committing(sink: BatchSink, manifest: str) -> BatchSink:
    """A sink, such as one with several outputs, whose batches count once they are
    written in full. A batch that failed runs again and replaces what it left; one
    that is in the manifest is not run again, so readers never see it half replaced.
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark, name = batch.sparkSession, batch_name(batch, batch_id)
        entry = f"{manifest.rstrip('/')}/{name}"
        if filesystem(spark, entry).exists(hadoop_path(spark, f"{entry}/_SUCCESS")):
            return
        sink(batch, batch_id)
        row = spark.range(1).select(F.lit(name).alias("batch"), F.current_timestamp().alias("committed"))
        row.write.mode("overwrite").parquet(entry)

    return run


def committed_batches(spark: SparkSession, manifest: str) -> DataFrame:
    """(batch, committed) of all batches that were written in full."""
    if not filesystem(spark, manifest).exists(hadoop_path(spark, manifest)):
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).option("recursiveFileLookup", True).parquet(manifest)


def committed_rows(rows: DataFrame, manifest: str, column: str = "batch_id") -> DataFrame:
    """The rows of an output, named by batch in `column`, whose batch is committed."""
    batches = committed_batches(rows.sparkSession, manifest).select(F.col("batch").alias(column))
    return rows.join(batches, column, "left_semi")
