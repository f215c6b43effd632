"""Per-folder compaction of small staged files by copying byte ranges."""

from __future__ import annotations

import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirflow.operators.ranking import number_rows
from weirflow.session import ship_package
from weirflow.sources.files import STAGE_FOLDER, STAGE_PART, list_files, staged_files
from weirflow.sources.hadoop import absolute_name, filesystem, hadoop_path, qualified_name
from weirflow.sources.stores import blocks, line_start, store_of
from weirflow.workspace import intermediates, materialize

TARGET_FILE_BYTES = 1 << 30
COPIED = "folder string, output int, taken long, written long, lines long"


def plan_pieces(files: DataFrame, target_file_bytes: int) -> DataFrame:
    """(folder, bytes, pieces, piece, output): the files every folder becomes,
    numbered from 0 over all folders. A folder becomes one file per started
    `target_file_bytes`; a folder of empty files becomes none."""
    sizes = files.groupBy("folder").agg(F.sum("length").alias("bytes")).filter("bytes > 0")
    pieces = F.ceil(F.col("bytes") / F.lit(target_file_bytes)).cast("int")
    planned = sizes.withColumn("pieces", pieces).withColumn(
        "piece", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    )
    numbered = number_rows(planned, [F.asc("folder"), F.asc("piece")], "output")
    return numbered.withColumn("output", (F.col("output") - 1).cast("int"))


def place_files(files: DataFrame) -> DataFrame:
    """Every file with the byte position its folder has reached before it."""
    by_name = Window.partitionBy("folder").orderBy("name").rowsBetween(
        Window.unboundedPreceding, -1
    )
    start = F.coalesce(F.sum("length").over(by_name), F.lit(0))
    return files.withColumn("start", start).filter(F.col("length") > 0).select(
        "relative_path", "folder", "length", "start"
    )


def plan_copies(files: DataFrame, pieces: DataFrame) -> DataFrame:
    """(output, piece, folder, relative_path, length, start, begin, end): the byte
    ranges of files that make up every piece. A file has one for each piece it
    reaches into, so there are at most as many as files and pieces together."""
    folders = pieces.filter("piece = 0").select(
        "folder", F.col("output").alias("first"),
        F.expr("(bytes + pieces - 1) div pieces").alias("step"),
    )
    # Spark joins by broadcast while the folders are few and by shuffle when not.
    reached = F.expr("sequence(start div step, (start + length - 1) div step)")
    cut = place_files(files).join(folders, "folder").withColumn("piece", F.explode(reached))
    return cut.select(
        (F.col("first") + F.col("piece")).cast("int").alias("output"),
        F.col("piece").cast("int").alias("piece"), "folder", "relative_path", "length", "start",
        F.greatest(F.lit(0), F.col("piece") * F.col("step") - F.col("start")).alias("begin"),
        F.least("length", (F.col("piece") + 1) * F.col("step") - F.col("start")).alias("end"),
    )


def _copy_piece(ranges: list[dict], source: str, target: str, lines: bool) -> tuple[int, int, int]:
    """Write one piece; returns the bytes taken from the parts, the bytes written
    and the newlines among them. With `lines` a range holds the lines that begin in
    it, and a part that ends without a newline gets one."""
    store, made = store_of(f"{target}/_attempts/{uuid.uuid4().hex}")
    store.create_dir(made.rsplit("/", 1)[0], recursive=True)
    taken = written = newlines = 0
    with store.open_output_stream(made, compression=None) as out:
        for part in ranges:
            origin, path = store_of(f"{source}/{part['relative_path']}")
            with origin.open_input_file(path) as file:
                length, begin, end = part["length"], part["begin"], part["end"]
                if lines:
                    begin = line_start(file, begin, length)
                    end = length if end == length else line_start(file, end, length)
                last = b""
                for data in blocks(file, begin, end):
                    out.write(data)
                    newlines += data.count(b"\n")
                    last = data[-1:]
                taken += max(0, end - begin)
                if lines and begin < end == length and last != b"\n":
                    out.write(b"\n")
                    newlines, written = newlines + 1, written + 1
    written += taken
    if written:
        first = ranges[0]
        _, folder = store_of(f"{target}/{first['folder']}")
        store.create_dir(folder, recursive=True)
        place = f"{folder}/part-{first['piece']:05d}{'.txt' if lines else ''}"
        # Another attempt of this task has written the same bytes.
        if store.get_file_info(place).is_file:
            store.delete_file(place)
        store.move(made, place)
    else:
        store.delete_file(made)
    return taken, written, newlines


def _copy(source: str, target: str, lines: bool):
    """Copy the ranges of a task, which come in order, one piece after the other."""

    def run(batches):
        held: list[dict] = []

        def finish():
            done = (held[0]["folder"], held[0]["output"], *_copy_piece(held, source, target, lines))
            return pa.RecordBatch.from_pydict(
                {c.split()[0]: pa.array([v], pa.string() if c.endswith("string") else
                                        pa.int32() if c.endswith("int") else pa.int64())
                 for c, v in zip(COPIED.split(", "), done)}
            )

        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0]["output"] != row["output"]:
                    yield finish()
                    held = []
                held.append(row)
        if held:
            yield finish()

    return run


def _delete(source: str):
    def run(batches):
        for batch in batches:
            for name in batch.column("relative_path").to_pylist():
                store, path = store_of(f"{source}/{name}")
                if store.get_file_info(path).is_file:
                    store.delete_file(path)
                folder, _, leaf = path.rpartition("/")
                checksum = f"{folder}/.{leaf}.crc"  # that Hadoop keeps beside local files
                if store.type_name == "local" and store.get_file_info(checksum).is_file:
                    store.delete_file(checksum)
            yield batch

    return run


def compact_folders(
    spark: SparkSession,
    source: str,
    target: str,
    *,
    target_file_bytes: int = TARGET_FILE_BYTES,
    delete_sources: bool = False,
    folder_pattern: str = STAGE_FOLDER,
    part_pattern: str = STAGE_PART,
    lines: bool = True,
) -> int:
    """Rewrite every matching folder of `source` below `target`; returns the
    number of lines written (newlines, if the files are not `lines`).

    One rule holds at every size: a folder of b bytes becomes
    ceil(b / `target_file_bytes`) files of about equal size. Which bytes of which
    part go where follows from the parts' lengths alone; a task copies the ranges
    of one new file, and contents are neither parsed, sorted nor shuffled. Part
    files are joined in name order and the new ones sort by name in that order (up
    to 100,000 files a folder). The first part's name is not kept. Folders of one
    level keep their names; one without a matching file is left out, one of empty
    files only ends up empty.

    With `lines` a cut moves on to the next line's beginning, and a part that does
    not end in a newline gets one; a file whose share holds no line's beginning is
    not written. Without, the new files together are the parts byte for byte, of any
    format that may be joined so.

    New files are made beside the target's folders. Once the bytes taken are those
    listed, each folder is replaced as a whole, so a second run leaves nothing of
    the first behind, and folders it does not have stay as they are.

    The parts are fixed when the call starts: later arrivals are neither copied
    nor deleted. Sources are deleted on request only, after the sizes of the new
    files have been compared with the bytes written.
    """
    if absolute_name(spark, source) == absolute_name(spark, target):
        raise ValueError("source and target must differ")
    ship_package(spark)
    with intermediates(spark):
        files = materialize(
            staged_files(spark, source, folder_pattern=folder_pattern, part_pattern=part_pattern),
            "parts",
        )
        if files.filter(F.col("folder").contains("/") | (F.col("folder") == "")).limit(1).count():
            raise ValueError("folders of one level are expected")
        if files.isEmpty():
            return 0
        pieces = materialize(plan_pieces(files, target_file_bytes), "pieces")
        outputs = pieces.count()
        copied = _write(spark, source, target, files, pieces, outputs, lines) if outputs else None
        _clear_empty(spark, target, files)
        if delete_sources:
            if outputs:
                _check_sizes(spark, target, copied)
            gone = files.select("relative_path").mapInArrow(
                _delete(qualified_name(spark, source).rstrip("/")), "relative_path string"
            )
            gone.write.format("noop").mode("overwrite").save()
        return copied.agg(F.sum("lines")).first()[0] if outputs else 0


def _write(spark, source, target, files, pieces, outputs, lines) -> DataFrame:
    """Copy into a folder of this run, then put the target's folders in place."""
    staging = f"{target.rstrip('/')}/_compacting-{uuid.uuid4().hex}"
    fs = filesystem(spark, target)
    copies = plan_copies(files, pieces).repartitionById(outputs, "output").sortWithinPartitions(
        "output", "start"
    )
    run = _copy(qualified_name(spark, source).rstrip("/"), qualified_name(spark, staging), lines)
    try:
        copied = materialize(copies.mapInArrow(run, COPIED), "copied")
        taken = copied.groupBy("folder").agg(F.sum("taken").alias("taken"))
        planned = pieces.filter("piece = 0").select("folder", "bytes")
        if planned.join(taken, "folder", "left").filter("NOT bytes <=> taken").limit(1).count():
            raise RuntimeError("parts changed while they were read; nothing was replaced")
        for row in planned.select("folder").toLocalIterator():
            made = hadoop_path(spark, f"{staging}/{row['folder']}")
            place = hadoop_path(spark, f"{target}/{row['folder']}")
            fs.delete(place, True)
            if not fs.rename(made, place):
                raise RuntimeError(f"{made} could not be moved to {place}")
        return copied
    finally:
        fs.delete(hadoop_path(spark, staging), True)


def _check_sizes(spark, target, copied) -> None:
    written = copied.groupBy("folder").agg(F.sum("written").alias("written"))
    found = list_files(spark, target, depth=2).groupBy("folder").agg(F.sum("length").alias("found"))
    if written.join(found, "folder", "left").filter("NOT written <=> found").limit(1).count():
        raise RuntimeError("new files do not have the size that was written; sources are kept")


def _clear_empty(spark, target, files) -> None:
    """Folders of empty files have no bytes to copy; what an earlier run left of
    them goes."""
    empty = files.groupBy("folder").agg(F.sum("length").alias("bytes")).filter("bytes = 0")
    fs = filesystem(spark, target)
    for row in empty.select("folder").toLocalIterator():
        folder = hadoop_path(spark, f"{target}/{row['folder']}")
        fs.delete(folder, True)
        fs.mkdirs(folder)
