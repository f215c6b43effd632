"""Recursive file inventories, listed level by level in tasks.

The folders of a level are a table. Each task lists some of them and writes what
they hold to the next part of a manifest table, whose folders are the next level.
The driver learns how many folders a level has and nothing else, so a tree may
have any number of files; a very large folder is passed on in batches.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from weirflow.session import ship_package
from weirflow.sources.hadoop import qualified_name
from weirflow.workspace import new_path

ENTRIES = "parent string, name string, is_folder boolean, length long, modified timestamp"
FOLDERS_PER_TASK = 16
BATCH_ENTRIES = 10_000

_ARROW = pa.schema([
    ("parent", pa.string()), ("name", pa.string()), ("is_folder", pa.bool_()),
    ("length", pa.int64()), ("modified", pa.timestamp("us", "UTC")),
])

Entry = tuple[str, bool, int, datetime | None]


def _local_entries(folder: str) -> Iterator[Entry]:
    """Entries of a folder of a mounted file system, one at a time. A link to a
    folder is not followed and not listed. The checksums that Hadoop keeps in
    `.name.crc` beside a file are part of that file."""
    with os.scandir(folder) as found:
        for entry in found:
            checked = re.fullmatch(r"\.(.+)\.crc", entry.name, re.DOTALL)
            if checked and os.path.lexists(os.path.join(folder, checked[1])):
                continue
            if entry.is_symlink() and entry.is_dir():
                continue
            known = entry.stat()
            modified = datetime.fromtimestamp(known.st_mtime_ns // 1000 / 1e6, timezone.utc)
            is_folder = entry.is_dir()
            yield entry.name, is_folder, 0 if is_folder else known.st_size, modified


def _store_entries(uri: str) -> Iterator[Entry]:
    """Entries of a folder of any other store, through its Arrow file system."""
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    for entry in store.get_file_info(fs.FileSelector(path)):
        is_folder = entry.type == fs.FileType.Directory
        yield entry.base_name, is_folder, 0 if is_folder else entry.size, entry.mtime


def entries_of(root: str, parent: str) -> Iterator[Entry]:
    """What a folder holds; one that has gone since its level was listed holds
    nothing, but the root must exist."""
    folder = f"{root.rstrip('/')}/{parent}" if parent else root
    local = re.fullmatch(r"file:(?://[^/]*)?(/.*)", folder, re.DOTALL)
    try:
        yield from _local_entries(local[1]) if local else _store_entries(folder)
    except FileNotFoundError:
        if not parent:
            raise


def _list_folders(root: str):
    def as_batch(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW
        )

    def run(batches):
        held = []
        for batch in batches:
            for parent in batch.column("parent").to_pylist():
                for entry in entries_of(root, parent):
                    held.append((parent, *entry))
                    if len(held) == BATCH_ENTRIES:
                        yield as_batch(held)
                        held = []
        if held:
            yield as_batch(held)

    return run


def list_tree(
    spark: SparkSession, root: str, *, depth: int | None = None, folders: str | None = None
) -> DataFrame:
    """(parent, name, is_folder, length, modified) of everything below `root`, hidden
    names and empty files included; `parent` is relative, "" for the root itself.

    `depth` levels are listed, all without it; `folders` is a pattern that the
    relative path of a folder must match to be entered. The table is written once
    and stays as it was at the call. Names are those of the store: a name that is
    not valid UTF-8 fails the job.
    """
    ship_package(spark)
    base, manifest = qualified_name(spark, root), new_path(spark, "manifest")
    level, count = spark.range(1).select(F.lit("").alias("parent")), 1
    number = 0
    while count and (depth is None or number < depth):
        seen = Observation("folders")
        tasks = -(-count // FOLDERS_PER_TASK)
        listed = level.repartition(tasks).mapInArrow(_list_folders(base), ENTRIES)
        listed.observe(seen, F.count_if("is_folder").alias("n")).write.parquet(
            f"{manifest}/level={number}"
        )
        inner = F.when(F.col("parent") == "", F.col("name")).otherwise(F.concat_ws("/", "parent", "name"))
        level = spark.read.schema(ENTRIES).parquet(f"{manifest}/level={number}").filter(
            "is_folder"
        ).select(inner.alias("parent"))
        count = seen.get["n"]
        if folders is not None and count:
            level = level.filter(F.col("parent").rlike(folders))
            count = level.count()
        number += 1
    return spark.read.schema(ENTRIES).option("recursiveFileLookup", True).parquet(manifest)
