"""The few Hadoop FileSystem calls that have no DataFrame form: resolving,
renaming and deleting. They touch names only, never file contents."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def filesystem(spark: SparkSession, path: str):
    return hadoop_path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified_name(spark: SparkSession, path: str) -> str:
    """The path with its scheme and host, made absolute; special characters stand
    as they are."""
    return filesystem(spark, path).makeQualified(hadoop_path(spark, path)).toString()


def absolute_name(spark: SparkSession, path: str) -> str:
    """The path without scheme and host, made absolute."""
    qualified = filesystem(spark, path).makeQualified(hadoop_path(spark, path))
    return qualified.toUri().getPath()


def copy_file(spark: SparkSession, pattern: str, target: str) -> None:
    """Copy the one file that matches the pattern."""
    source = hadoop_path(spark, pattern)
    (found,) = filesystem(spark, pattern).globStatus(source)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(
        filesystem(spark, pattern), found.getPath(), filesystem(spark, target),
        hadoop_path(spark, target), False, spark._jsc.hadoopConfiguration(),
    )
