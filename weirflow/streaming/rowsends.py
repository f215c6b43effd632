"""Rows of a stream sent from the executors, each partition of a batch once.

An outbox takes the rows of one (batch, partition) at a time and shows them all when
they are complete, or none. When a task or a whole batch runs again after it was
sent, the outbox refuses it at its start and no row is sent twice.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from typing import Protocol

from pyspark import TaskContext
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql.streaming import StreamingQuery

from weirflow.session import ship_package
from weirflow.sources.hadoop import qualified_name
from weirflow.streaming.microbatch import BatchSink, batch_name, for_each_batch


# `json.dumps` with options makes a new one for every row.
_ENCODER = json.JSONEncoder(default=str)


class Outbox(Protocol):
    def begin(self, name: str) -> bool:
        """Start a delivery; false if one of this name has been completed."""

    def send(self, row: Row) -> None: ...

    def commit(self) -> None:
        """Complete the delivery; of two attempts at one name only the first counts."""

    def abort(self) -> None: ...


def fenced_sink(connect: Callable[[], Outbox]) -> BatchSink:
    """Sends the rows of each micro-batch from the executors, one delivery for each
    batch and partition.

    The rows of a partition must be the same when its batch runs again. They are if
    the stream goes from the source to the sink without a shuffle, as the splits of a
    batch are fixed by its files or offsets; adaptive execution may deal shuffled
    rows otherwise. (`writeStream.foreach` would not do: its `close` gets no error
    when the rows stop because of a failure before the sink, and so a delivery could
    be completed that is not whole.)
    """

    def sink(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        batch.foreachPartition(
            lambda rows: deliver(connect(), f"{name}-{TaskContext.get().partitionId()}", rows)
        )

    return sink


def deliver(box: Outbox, name: str, rows: Iterable[Row]) -> None:
    """Send rows as one delivery, if there is none of the name."""
    if not box.begin(name):
        return
    try:
        for row in rows:
            box.send(row)
    except BaseException:
        box.abort()
        raise
    box.commit()


class FolderOutbox:
    """Deliveries as files of JSON lines in a folder that all executors reach. A file
    gets its name when it is complete; until then it has a hidden one of its own."""

    def __init__(self, folder: str) -> None:
        self.folder = folder

    def _store(self):
        from pyarrow import fs

        if self.folder.startswith("file:"):
            return fs.LocalFileSystem(), "/" + self.folder.removeprefix("file:").lstrip("/")
        return fs.FileSystem.from_uri(self.folder)

    def begin(self, name: str) -> bool:
        from pyarrow import fs

        self.store, folder = self._store()
        self.target, self.draft = f"{folder}/{name}.json", f"{folder}/.{name}-{uuid.uuid4().hex}"
        if self.store.get_file_info(self.target).type != fs.FileType.NotFound:
            return False
        self.store.create_dir(folder, recursive=True)
        self.stream = self.store.open_output_stream(self.draft, buffer_size=1 << 20)
        return True

    def send(self, row: Row) -> None:
        self.stream.write(_ENCODER.encode(row.asDict(True)).encode() + b"\n")

    def commit(self) -> None:
        self.stream.close()
        self.store.move(self.draft, self.target)

    def abort(self) -> None:
        self.stream.close()
        self.store.delete_file(self.draft)


def folder_outbox(spark: SparkSession, folder: str) -> Callable[[], FolderOutbox]:
    """How tasks open the outbox in a folder."""
    place = qualified_name(spark, folder)
    return lambda: FolderOutbox(place)


def send_rows(
    rows: DataFrame, connect: Callable[[], Outbox], checkpoint: str, *,
    period_seconds: float | None = None, available_now: bool = False,
) -> StreamingQuery:
    """Send every row of a stream through an outbox; see `fenced_sink`."""
    ship_package(rows.sparkSession)
    return for_each_batch(
        rows, fenced_sink(connect), checkpoint, period_seconds=period_seconds, available_now=available_now
    )
