"""Tails of folder topics through the index of their offsets."""

import random

import pytest

from helpers import tuples
from weirflow.sinks.messages import publish
from weirflow.sources import offsets
from weirflow.sources.messages import MessageFolder, read_messages, read_tail
from weirflow.sources.offsets import index_offsets, read_offsets, tail_files

SCHEMA = "value string, topic string, partition int, offset long"


def send(spark, topic, rows):
    publish(spark.createDataFrame(rows, SCHEMA).coalesce(1), topic)


def messages(partition, first, last, name="t"):
    return [(f"{name}{partition}-{i}", name, partition, i) for i in range(first, last)]


def plain_tail(spark, topic, n):
    rows = [(r.topic, r.partition, r.offset, r.value) for r in read_messages(spark, topic).collect()]
    found = []
    for key in {r[:2] for r in rows}:
        own = [r for r in rows if r[:2] == key]
        found += sorted(own, key=lambda r: (r[2] is None, -(r[2] or 0)))[:n]
    return sorted(found, key=str)


def tail(spark, topic, n):
    return sorted(map(tuple, read_tail(spark, topic, n).select("topic", "partition", "offset", "value").collect()),
                  key=str)


@pytest.fixture
def topic(spark, tmp_path):
    """Ten files in offset order for two partitions, one partition in the first file
    only, one with three messages in all."""
    topic = MessageFolder(str(tmp_path / "a topic"))
    for k in range(10):
        rows = messages(0, 100 * k, 100 * k + 100) + messages(1, 10 * k, 10 * k + 4)
        send(spark, topic, rows + (messages(2, 0, 50) if k == 0 else []) + (messages(3, 0, 3) if k == 4 else []))
    return topic


def test_only_files_with_the_tail_are_read(spark, topic):
    assert tail_files(spark, topic.path, 5) is None
    want = plain_tail(spark, topic, 5)
    assert tail(spark, topic, 5) == want
    assert index_offsets(spark, topic.path) == 10 and index_offsets(spark, topic.path) == 0
    assert read_messages(spark, topic).count() == 10 * 104 + 53
    got = read_tail(spark, topic, 5)
    # The newest two for partition 1, the newest for 0, the first for 2, the fifth for 3.
    assert len(got.inputFiles()) == 4
    assert tail(spark, topic, 5) == want
    for n in (1, 4, 101, 10_000):
        assert tail(spark, topic, n) == plain_tail(spark, topic, n)


def test_files_that_come_and_go(spark, topic, tmp_path):
    index_offsets(spark, topic.path)
    send(spark, topic, messages(0, 1000, 1002) + messages(5, 0, 1))
    assert tail_files(spark, topic.path, 5) is None
    assert tail(spark, topic, 5) == plain_tail(spark, topic, 5)
    assert index_offsets(spark, topic.path) == 1
    assert len(read_tail(spark, topic, 5).inputFiles()) == 5
    newest = read_offsets(spark, topic.path).filter("low = 1000").first()["relative_path"]
    (tmp_path / "a topic" / newest).unlink()
    assert tail(spark, topic, 5) == plain_tail(spark, topic, 5)
    assert (5,) not in tuples(read_tail(spark, topic, 5).select("partition"))


def test_overlaps_gaps_and_missing_offsets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(offsets, "FILES_PER_PASS", 3)
    topic, rng = MessageFolder(str(tmp_path / "t")), random.Random(4)
    everything = rng.sample(range(10_000), 300)
    for k in range(8):
        rows = [(str(i), "t" if i % 2 else None, i % 3, i) for i in everything[k * 30:k * 30 + rng.randint(1, 30)]]
        send(spark, topic, rows + [("none", "t", 7, None)])
    send(spark, topic, [])
    assert index_offsets(spark, topic.path) >= 8
    for n in (1, 5, 40):
        assert tail(spark, topic, n) == plain_tail(spark, topic, n)


def test_empty_topic(spark, tmp_path):
    (tmp_path / "t").mkdir()
    topic = MessageFolder(str(tmp_path / "t"))
    assert index_offsets(spark, topic.path) == 0 and tail(spark, topic, 5) == []
