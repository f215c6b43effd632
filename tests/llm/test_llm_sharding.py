import zlib

import pytest
from pyspark.sql import functions as F

from llm_cases import odd_documents, no_documents
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows
from weirflow.llm.sharding import rendezvous, shard_rows


def test_query(spark, sf, documents):
    got = all_queries()["op7_sharding"](spark, sf)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    slots = {}
    rows = got.collect()
    assert len(rows) == len(texts)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(data) + 8, zlib.crc32(data), "key")
        assert 0 <= r["shard"] < 24 and r["grown_shard"] in (r["shard"], 24)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_even_and_moving_little(spark):
    keys = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    before, after = [1.0] * 8, [1.0] * 9
    rows = keys.select(rendezvous(F.col("k"), before).alias("a"), rendezvous(F.col("k"), after).alias("b"))
    counts = {r["a"]: r["count"] for r in rows.groupBy("a").count().collect()}
    assert len(counts) == 8 and max(counts.values()) < 1.08 * 5000
    moved = rows.filter("a <> b").collect()
    assert {r["b"] for r in moved} == {8} and 0.09 < len(moved) / 40_000 < 0.13


def test_weights_are_shares(spark):
    keys = spark.range(40_000).select(F.col("id").cast("string").alias("k"))
    counts = {r["s"]: r["count"] for r in
              keys.groupBy(rendezvous(F.col("k"), [1.0, 3.0]).alias("s")).count().collect()}
    assert 2.8 < counts[1] / counts[0] < 3.2
    with pytest.raises(ValueError):
        rendezvous(F.col("k"), [1.0, 0.0])
    assert keys.filter(rendezvous(F.col("k"), [1.0]) != 0).count() == 0


def test_odd_documents(spark):
    docs = odd_documents(spark)
    got = shard_rows(as_rows(docs), key="doc_id", weights=[1.0] * 3).collect()
    assert len(got) == docs.count()
    shards, slots = {}, {}
    for r in got:
        shards.setdefault(r["row"]["doc_id"], set()).add(r["shard"])
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(len(s) == 1 for s in shards.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert shard_rows(as_rows(no_documents(spark)), key="doc_id", weights=[1.0]).count() == 0
