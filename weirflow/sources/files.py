"""File scans: CSV, Parquet, JSON lines, JSON arrays, day folders, staged
text parts and file inventories. Schemas are always declared."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from weirflow.schemas import DAY_PARTITIONS
from weirflow.sources.hadoop import absolute_name, filesystem, hadoop_path
from weirflow.sources.inventory import list_tree

PathArg = str | Sequence[str]

# Naming rules of staged folders and part files.
STAGE_FOLDER = r"^date=\d{4}-\d{2}-\d{2}$"
STAGE_PART = r"^part-\d{4}\.csv$"


def read_csv(
    spark: SparkSession,
    path: PathArg,
    schema: T.StructType,
    *,
    header: bool = True,
    separator: str = ",",
    strict: bool = False,
) -> DataFrame:
    """Delimited text with quotes removed. `strict` fails the job on a value
    that does not parse; otherwise it becomes NULL."""
    return (
        spark.read.schema(schema)
        .options(header=header, sep=separator, mode="FAILFAST" if strict else "PERMISSIVE")
        .csv(path)
    )


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Columnar files; the schema comes from the file footer."""
    return spark.read.parquet(*paths)


def read_json_arrays(
    spark: SparkSession, path: PathArg, schema: T.StructType, *, mode: str = "FAILFAST"
) -> DataFrame:
    """Files that each hold one JSON array of objects; one row per object.

    One document is parsed by one task, so keep documents moderate in size
    and many in number.
    """
    return spark.read.schema(schema).options(multiLine=True, mode=mode).json(path)


def read_day(spark: SparkSession, root: str, schema: T.StructType, day: str) -> DataFrame:
    """One day of a JSON lake laid out as year=/month=/day= folders.

    Only the day's folder is listed, however many others the lake has; year, month
    and day come back as columns. Folders below a day, such as those of
    micro-batches, are read with it. A day without a folder has no rows.
    """
    wanted = date.fromisoformat(day)
    full = T.StructType(schema.fields + DAY_PARTITIONS.fields)
    # A number may be written with a leading zero.
    month, number = (f"{{{n},{n:02d}}}" if n < 10 else str(n) for n in (wanted.month, wanted.day))
    folder = f"{root.rstrip('/')}/year={wanted.year}/month={month}/day={number}"
    if not filesystem(spark, root).globStatus(hadoop_path(spark, folder)):
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", root).json(folder).filter(
        (F.col("year") == wanted.year)
        & (F.col("month") == wanted.month)
        & (F.col("day") == wanted.day)
    ).select(*full.fieldNames())


def plain_path(url: Column) -> Column:
    """The path in a file's address as Spark gives it, without scheme and host."""
    # A plus sign stands for itself in a path, for a blank in url_decode.
    path = F.url_decode(F.replace(url, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def list_files(
    spark: SparkSession, root: str, *, depth: int | None = None, folders: str | None = None
) -> DataFrame:
    """(path, relative_path, folder, name, length, modified) of all files below
    `root`, hidden and empty ones included; see `list_tree`. `path` has no scheme
    or host. File contents are not read, and no name reaches the driver.
    """
    base = absolute_name(spark, root).rstrip("/") + "/"
    inner = F.concat(F.when(F.col("parent") == "", "").otherwise(F.concat("parent", F.lit("/"))), "name")
    return (
        list_tree(spark, root, depth=depth, folders=folders)
        .filter(~F.col("is_folder"))
        .select(
            F.concat(F.lit(base), inner).alias("path"), inner.alias("relative_path"),
            F.col("parent").alias("folder"), "name", "length", "modified",
        )
    )


def data_files(files: DataFrame) -> DataFrame:
    """The files of an inventory that Spark's file sources read: no part of the
    path below the root starts with a dot or an underscore."""
    return files.filter(~F.col("relative_path").rlike("(^|/)[._]"))


def in_listing_order(files: DataFrame) -> DataFrame:
    """Files of a folder first, then each of its sub-folders, both by name."""
    parts = F.split("relative_path", "/")
    folders = F.transform(F.slice(parts, 1, F.size(parts) - 1), lambda p: F.concat(F.lit("1"), p))
    leaf = F.concat(F.lit("0"), F.element_at(parts, -1))
    return files.orderBy(F.concat(folders, F.array(leaf)))


def staged_files(
    spark: SparkSession,
    root: str,
    *,
    folder_pattern: str = STAGE_FOLDER,
    part_pattern: str = STAGE_PART,
) -> DataFrame:
    """Inventory of the part files directly inside the matching folders of
    `root`; unfinished parts and stray folders do not match."""
    return list_files(spark, root, depth=2, folders=folder_pattern).filter(
        F.col("folder").rlike(folder_pattern) & F.col("name").rlike(part_pattern)
    )


def staged_lines(spark: SparkSession, root: str, *, part_pattern: str = STAGE_PART) -> DataFrame:
    """(path, block, place, value): the lines of the part files below `root`.

    `block` is the byte offset of the scan split inside its file and `place`
    orders the lines of a split, so (path, block, place) is the original order.
    Files are skipped by name before they are opened.
    """
    return (
        spark.read.option("recursiveFileLookup", True)
        .option("lineSep", "\n")
        .text(root)
        .filter(F.col("_metadata.file_name").rlike(part_pattern))
        .select(
            plain_path(F.col("_metadata.file_path")).alias("path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("place"),
            "value",
        )
    )


def read_lines_numbered(
    spark: SparkSession, path: str, *, header: bool = True, part_pattern: str = ".*"
) -> DataFrame:
    """(key, value): the lines of text files in file order, header lines
    dropped, with the running number from 1 as key text.

    The lines of a split are in order already. They are counted per split, the
    counts summed up over the splits in file order (one row per split), and a
    line's number is that sum plus its place in the split. Lines are neither
    sorted nor stored.
    """
    lines = staged_lines(spark, path, part_pattern=part_pattern)
    heads = F.when(F.col("block") == 0, F.lit(int(header))).otherwise(0)
    splits = lines.groupBy("path", "block").agg(
        F.min("place").alias("first"), F.count(F.lit(1)).alias("lines")
    ).withColumn("skip", heads)
    earlier = Window.orderBy("path", "block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(F.col("lines") - F.col("skip")).over(earlier), F.lit(0))
    numbered = lines.join(splits.withColumn("before", before), ["path", "block"])
    place = F.col("place") - F.col("first") - F.col("skip")
    return numbered.filter(place >= 0).select(
        (F.col("before") + place + 1).cast("string").alias("key"), "value"
    )
