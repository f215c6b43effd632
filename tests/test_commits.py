"""Both outputs of a micro-batch become visible at once, and once only."""

import pytest
from pyspark.sql import functions as F

from weirflow.sinks.messages import publish
from weirflow.sources.messages import MessageFolder, Reading, stream_messages
from weirflow.streaming.commits import committed_batches, committed_rows, committing
from weirflow.streaming.microbatch import batch_folder_sink, both_outputs, for_each_batch


def test_a_batch_that_stops_between_its_outputs(spark, tmp_path):
    topic, stop = MessageFolder(str(tmp_path / "t")), [1]
    good, bad, manifest, checkpoint = (str(tmp_path / n) for n in ("good", "bad", "manifest", "checkpoint"))
    for texts in (["a", "-b"], ["c", "-d", "e"]):
        publish(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), topic)
    bad_sink = batch_folder_sink(bad)

    def failing(batch, batch_id):
        if batch_id in stop:
            raise RuntimeError("stopped between the outputs")
        bad_sink(batch, batch_id)

    def split(batch):
        rows = batch.select(F.col("value").cast("string").alias("v"))
        return rows.filter("v NOT LIKE '-%'"), rows.filter("v LIKE '-%'")

    def run():
        messages = stream_messages(spark, topic, Reading(max_per_trigger=1))
        sink = committing(both_outputs(split, batch_folder_sink(good), failing), manifest)
        for_each_batch(messages, sink, checkpoint, available_now=True).awaitTermination()

    def seen(path):
        return sorted(r.v for r in committed_rows(spark.read.parquet(path), manifest).collect())

    assert committed_batches(spark, manifest).count() == 0
    with pytest.raises(Exception, match="between the outputs"):
        run()
    # The second batch's first part is on disk, but neither part is seen.
    assert spark.read.parquet(good).count() == 3
    assert (seen(good), seen(bad)) == (["a"], ["-b"])
    stop.clear()
    run()
    assert (seen(good), seen(bad)) == (["a", "c", "e"], ["-b", "-d"])
    assert committed_batches(spark, manifest).count() == 2


def test_a_committed_batch_is_not_run_again(spark, tmp_path):
    ran = []
    sink = committing(lambda batch, batch_id: ran.append(batch_id), str(tmp_path / "manifest"))
    for batch_id in (0, 0, 1):
        sink(spark.range(1), batch_id)
    assert ran == [0, 1]
