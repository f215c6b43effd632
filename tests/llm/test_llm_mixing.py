import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_cases import no_documents, odd_documents
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows
from weirflow.llm.mixing import (
    block_texts, count_words, mix_sources, permuted, source_targets, words_taken,
)

WORD = re.compile("[^\x20\x09-\x0d]+")


def shared_out(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Targets by handing out the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), share * sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        free = [s for s in names if s not in full]
        part = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if part[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else part[s] for s in names}
        full |= over


def test_query(spark, sf, documents):
    got = all_queries()["op11_mixing"](spark, sf)
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    docs = {r["doc_id"]: r for r in documents.collect()}
    size = {i: len(WORD.findall(r["text"] or "")) for i, r in docs.items()}
    sizes = Counter()
    for i, r in docs.items():
        sizes[r["source"]] += size[i]
    targets, taken = shared_out(sizes), Counter()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        source = docs[r["doc_id"]]["source"]
        assert (r["size"], r["source_size"]) == (size[r["doc_id"]], sizes[source])
        assert r["target"] == pytest.approx(targets[source])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[source] += r["taken"]
    assert all(abs(taken[s] - t) <= 0.5 for s, t in targets.items())
    again = all_queries()["op11_mixing"](spark, sf).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 1, "b": 1000, None: 10}, {"a": 5}, {None: 7, "b": 0},
    {"a": 0}, {chr(97 + i): (i * 37) % 11 * 10**(i % 4) for i in range(13)},
])
def test_targets(spark, sizes):
    rows = [("" if s is None else "=" + s, n) for s, n in sizes.items()]
    table = spark.createDataFrame(rows, "part string, source_size long")
    got = source_targets(table, weights=(3, 1, 2), share=1.5, most=2).collect()
    found = {r["part"][1:] if r["part"] else None: r["target"] for r in got}
    assert found == pytest.approx(shared_out(sizes))


@pytest.mark.parametrize("size", [1, 2, 3, 10, 257, 1000])
def test_permutations(spark, size):
    rows = spark.range(size).select(
        permuted(F.col("id"), F.lit(size), F.lit("a")).alias("a"),
        permuted(F.col("id"), F.lit(size), F.lit("b")).alias("b"),
    ).collect()
    for c in "ab":
        assert sorted(r[c] for r in rows) == list(range(size))
    if size > 100:
        assert sum(r["a"] == r["b"] for r in rows) < 12


def mixed(docs, **options):
    rows = as_rows(docs.withColumn("words", count_words(F.col("text"))))
    return mix_sources(rows, source="source", key="doc_id", size="words", **options)


def test_blocks_are_whole_and_used_evenly(spark, documents):
    docs = documents.withColumn("source", F.when(F.col("doc_id") % 3 > 0, F.col("lang")))
    mix = mixed(docs, block_words=64, shard_slots=100)
    texts = {r["uid"]: WORD.findall(r["row"]["text"] or "") for r in mix.rows.collect()}
    part = {r["uid"]: r["part"] for r in mix.rows.collect()}
    blocks, times = defaultdict(list), defaultdict(Counter)
    for p in mix.pieces.collect():
        blocks[p["shard"], p["place"]].append(p)
        for w in range(p["first"], p["first"] + p["words"]):
            times[p["uid"]][w] += 1
    # Every word is taken once or twice, or by a source that isn't used up, never.
    assert max(n for c in times.values() for n in c.values()) <= 2
    shards = defaultdict(set)
    for (shard, place), pieces in blocks.items():
        pieces.sort(key=lambda p: p["offset"])
        at = 0
        for p in pieces:
            assert p["offset"] == at
            at += p["words"]
        assert at <= 64 and len({part[p["uid"]] for p in pieces}) == 1
        shards[shard].add(place)
    assert sorted(shards) == list(range(len(shards)))
    sizes = [len(shards[s]) for s in sorted(shards)]
    assert set(sizes[:-1]) <= {100} and all(shards[s] == set(range(len(shards[s]))) for s in shards)
    # The mixture's texts are the pieces' words.
    got = {(r["shard"], r["place"]): r["text"] for r in block_texts(mix, "text").collect()}
    want = {
        k: " ".join(w for p in pieces for w in texts[p["uid"]][p["first"]:p["first"] + p["words"]])
        for k, pieces in blocks.items()
    }
    assert got == want
    # Shards vary as draws do, and differ from one another.
    counts = Counter((s, part[pieces[0]["uid"]]) for (s, _), pieces in blocks.items())
    for name in set(part.values()):
        drawn = [counts[s, name] for s in range(len(sizes) - 1)]
        assert len(drawn) < 4 or len(set(drawn)) > 1


def test_not_bound_to_the_split(spark, documents):
    one = mixed(documents.repartition(1), block_words=32)
    many = mixed(documents.repartition(7), block_words=32)
    taken = [
        sorted((r["row"]["doc_id"], r["taken"]) for r in words_taken(m).collect()) for m in (one, many)
    ]
    assert taken[0] == taken[1]


def test_odd_documents(spark):
    docs = odd_documents(spark).withColumn(
        "source", F.when(F.col("doc_id") == 8, "big").when(F.col("doc_id").isNotNull(), "src")
    )
    mix = mixed(docs, block_words=50, shard_slots=16)
    rows = words_taken(mix).collect()
    assert len(rows) == docs.count() and set(rows[0]["row"].asDict()) >= set(docs.columns)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        row = r["row"]
        n = len(WORD.findall(row["text"] or ""))
        sizes[row["source"]] += n
        taken[row["source"]] += r["taken"]
        target[row["source"]] = r["target"]
        assert r["taken"] <= 2 * n
    assert target == pytest.approx(shared_out(sizes))
    assert all(abs(taken[s] - t) <= 0.5 for s, t in target.items())


def test_no_documents(spark):
    mix = mixed(no_documents(spark))
    assert words_taken(mix).count() == 0 and block_texts(mix, "text").count() == 0
    blank = spark.createDataFrame([(1, " ", "s"), (2, None, None)], "doc_id long, text string, source string")
    assert [r["taken"] for r in words_taken(mixed(blank)).collect()] == [0, 0]


def test_one_key_has_most_rows(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(7).alias("doc_id"),
        F.lit("a b c d e").alias("text"), F.lit("s").alias("source"),
    )
    rows = words_taken(mixed(docs, block_words=16)).collect()
    assert sum(r["taken"] for r in rows) == 3000 * 5 * 1.5 and max(r["taken"] for r in rows) <= 10


def test_wrong_arguments(spark, documents):
    with pytest.raises(ValueError):
        mixed(documents, weights=(1, 0))
    with pytest.raises(ValueError):
        mixed(documents, share=3.0)
