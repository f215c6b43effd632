"""An index of the offsets in a folder topic.

`_offsets` in the topic's folder, which readers of the topic don't see, has a row per
file and topic partition with the lowest and highest offset and the number of
messages. With it the tail of a topic opens only the files that can hold it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirflow.schemas import MESSAGES
from weirflow.sources.files import data_files, list_files, plain_path
from weirflow.sources.hadoop import absolute_name, filesystem, hadoop_path

INDEX = "_offsets"
FILES_PER_PASS = 10_000
ROWS = "relative_path string, topic string, partition int, low long, high long, num_offsets long"


def read_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(relative_path, topic, partition, low, high, num_offsets) of all indexed
    files, those that are gone included; a file without messages has one row."""
    place = f"{path.rstrip('/')}/{INDEX}"
    if not filesystem(spark, place).exists(hadoop_path(spark, place)):
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(ROWS).parquet(place).dropDuplicates(["relative_path", "topic", "partition"])


def topic_files(spark: SparkSession, path: str) -> DataFrame:
    """(relative_path): the files of a topic, listed in tasks."""
    return data_files(list_files(spark, path)).select("relative_path")


def index_offsets(spark: SparkSession, path: str) -> int:
    """Add the files that the index does not have yet; returns their number.

    Only these are read, three columns of each, FILES_PER_PASS at a time. Message
    files are never changed under their name, so an indexed file stays indexed. Two
    calls at once may index a file twice, which does no harm.
    """
    root, done = path.rstrip("/"), 0
    files = topic_files(spark, root)
    while True:
        new = files.join(read_offsets(spark, root), "relative_path", "left_anti")
        names = [r[0] for r in new.limit(FILES_PER_PASS).collect()]
        if not names:
            return done
        base = len(absolute_name(spark, root).rstrip("/")) + 1
        messages = spark.read.schema(MESSAGES).parquet(*[f"{root}/{n}" for n in names])
        relative = F.substring(plain_path(F.col("_metadata.file_path")), F.lit(base + 1), F.lit(2**31 - 1))
        found = messages.groupBy(relative.alias("relative_path"), "topic", "partition").agg(
            F.min("offset").alias("low"), F.max("offset").alias("high"), F.count("offset").alias("num_offsets")
        )
        listed = spark.createDataFrame([(n,) for n in names], "relative_path string")
        rows = listed.join(found, "relative_path", "left").withColumn(
            "num_offsets", F.coalesce("num_offsets", F.lit(0))
        )
        rows.coalesce(1).write.mode("append").parquet(f"{root}/{INDEX}")
        done += len(names)


def tail_files(spark: SparkSession, path: str, n: int) -> list[str] | None:
    """The files that can hold one of the last n messages of a topic partition, or
    None if a file is not indexed.

    Of a partition's files by falling lowest offset, the first with n messages
    together set a bound: the last n lie at or above the lowest offset of the last
    of these, and files that end below it are not needed. A partition with fewer
    messages needs all its files.
    """
    files, index = topic_files(spark, path), read_offsets(spark, path)
    if not files.join(index, "relative_path", "left_anti").isEmpty():
        return None
    known = index.join(files, "relative_path", "left_semi").filter("num_offsets > 0")
    newest = Window.partitionBy("topic", "partition").orderBy(F.desc("low"), "relative_path")
    so_far = F.sum("num_offsets").over(newest.rowsBetween(Window.unboundedPreceding, 0))
    bound = F.max(F.when(F.col("so_far") >= n, F.col("low"))).over(Window.partitionBy("topic", "partition"))
    needed = known.withColumn("so_far", so_far).withColumn("bound", bound).filter(
        "bound IS NULL OR high >= bound"
    )
    return [r[0] for r in needed.select("relative_path").distinct().collect()]
