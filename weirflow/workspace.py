"""Intermediate tables in the folder that all executors share.

The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
single-process session without that setting gets a temporary folder, which goes
when the process ends.

Inside `intermediates(spark)` everything made here is owned by the block and
removed at its end. Outside, the tables stay, because a returned DataFrame still
reads them.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from weirflow.session import is_local

_local_roots: dict[str, str] = {}
_owners: list[list[str]] = []


def shared_root(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="weirflow-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path nobody has used yet; the writer creates the folder."""
    path = f"{shared_root(spark)}/weirflow/{label}-{uuid.uuid4().hex}"
    if _owners:
        _owners[-1].append(path)
    return path


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Own the intermediate tables made in the block; they are removed at its
    end, so read what is needed of them before."""
    owned: list[str] = []
    _owners.append(owned)
    try:
        yield
    finally:
        _owners.remove(owned)
        for path in owned:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back, so that later steps see one fixed
    result even when executors are lost and tasks run again."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
