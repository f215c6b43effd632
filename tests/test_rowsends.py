"""Row sends: every partition of a batch is delivered once, whole or not at all."""

import pytest
from pyspark.sql import Row, functions as F

from weirflow.sinks.messages import publish
from weirflow.sources.messages import MessageFolder, Reading, stream_messages
from weirflow.streaming.rowsends import FolderOutbox, deliver, folder_outbox, send_rows


def lines(folder):
    return {p.name: p.read_text().splitlines() for p in folder.iterdir()} if folder.exists() else {}


def test_deliveries(tmp_path):
    box = tmp_path / "a box"

    def rows(*values, fail=False):
        yield from (Row(v=v) for v in values)
        if fail:
            raise RuntimeError("executor gone")

    def send(name, found):
        deliver(FolderOutbox(f"file:{box}"), name, found)

    send("5-0", rows("a", "é"))
    send("5-0", rows("a", "again"))
    with pytest.raises(RuntimeError):
        send("5-1", rows("lost", fail=True))
    assert lines(box) == {"5-0.json": ['{"v": "a"}', '{"v": "\\u00e9"}']}
    send("5-1", rows("b"))
    send("6-0", rows())
    assert lines(box) == {
        "5-0.json": ['{"v": "a"}', '{"v": "\\u00e9"}'], "5-1.json": ['{"v": "b"}'], "6-0.json": [],
    }


def test_two_attempts_at_once(tmp_path):
    """A slow attempt that ends after another replaces its file by the same rows."""
    slow, fast = (FolderOutbox(f"file:{tmp_path}/box") for _ in range(2))
    assert slow.begin("1-0") and fast.begin("1-0")
    for box in (slow, fast):
        box.send(Row(v=1))
    fast.commit()
    slow.commit()
    assert lines(tmp_path / "box") == {"1-0.json": ['{"v": 1}']}


def test_a_repeated_batch_adds_nothing(spark, tmp_path):
    topic, box, checkpoint = MessageFolder(str(tmp_path / "t")), tmp_path / "box", tmp_path / "checkpoint"
    for texts in (["a", "b"], ["c"], []):
        publish(spark.createDataFrame([(t,) for t in texts], "value string").coalesce(1), topic)

    def run():
        rows = stream_messages(spark, topic, Reading(max_per_trigger=1)).select(
            F.col("value").cast("string").alias("v"))
        send_rows(rows, folder_outbox(spark, str(box)), str(checkpoint), available_now=True).awaitTermination()

    run()
    before = lines(box)
    assert sorted(x for own in before.values() for x in own) == ['{"v": "a"}', '{"v": "b"}', '{"v": "c"}']
    # As if the query had died before it noted the end of its last batch.
    commits = sorted(p for p in (checkpoint / "commits").iterdir() if p.name.isdigit())
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink()
    run()
    assert lines(box) == before
    assert len([p for p in (checkpoint / "commits").iterdir() if p.name.isdigit()]) == len(commits)


def test_a_failing_row_delivers_nothing(spark, tmp_path):
    topic, box = MessageFolder(str(tmp_path / "t")), tmp_path / "box"
    publish(spark.createDataFrame([("1",), ("x",)], "value string").coalesce(1), topic)
    rows = stream_messages(spark, topic).select(F.col("value").cast("string").cast("int").alias("v"))
    with pytest.raises(Exception):
        send_rows(rows, folder_outbox(spark, str(box)), str(tmp_path / "c"), available_now=True).awaitTermination()
    assert lines(box) == {}


def test_a_batch_is_sent_by_several_tasks(spark, tmp_path):
    from weirflow.plans.streams import stream_foreach_rows

    made = spark.range(2000).selectExpr(
        "id AS event_id", "id % 7 AS user_id", "IF(id % 5 = 0, NULL, 'view') AS event_type", "id / 8 AS value"
    )
    made.write.parquet(str(tmp_path / "events.parquet"))
    sent = stream_foreach_rows(spark, str(tmp_path))
    assert sorted(map(tuple, sent.collect()), key=str) == sorted(map(tuple, made.collect()), key=str)
    deliveries = [f.rsplit("/", 1)[1].removesuffix(".json").split("-")[-2:] for f in sent.inputFiles()]
    batches = [batch for batch, _ in deliveries]
    assert set(batches) == {"0", "1", "2"}
    assert all(batches.count(b) > 1 for b in set(batches))
