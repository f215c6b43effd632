import re

import numpy as np
import pytest
import xxhash

from llm_cases import ids, no_documents, odd_documents
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows
from weirflow.llm.simhash import (
    components, fingerprint, keep_one_of_each, linked_pairs, simhash_groups, start_nodes,
)


def plain_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    size = min(3, len(words))
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + size]).encode(), 42)
              for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, distance=3):
    """Component of each fingerprint, by comparing all pairs."""
    values = np.array(sorted(set(prints)), np.uint64)
    label = list(range(len(values)))

    def find(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= distance) + i + 1:
            a, b = find(i), find(int(j))
            label[max(a, b)] = min(a, b)
    return {int(values[i]): int(values[find(i)]) for i in range(len(values))}


@pytest.mark.parametrize("text", [None, "", " \t", "One", "Two words", "É Ünïcode 　 space", "a b c d " * 500])
def test_fingerprint(text):
    assert fingerprint(text) == plain_fingerprint(text)


def test_query_equals_brute_force(spark, sf, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    got = all_queries()["op6_simhash"](spark, sf).collect()
    assert len(got) == len(texts)
    prints = {i: plain_fingerprint(t) for i, t in texts.items()}
    root = groups_of(prints.values())
    smallest = {}
    for i, p in prints.items():
        smallest[root[p]] = min(smallest.get(root[p], i), i)
    for r in got:
        assert int(r["fingerprint"], 16) == prints[r["doc_id"]] and len(r["fingerprint"]) == 16
        assert r["component_id"] == smallest[root[prints[r["doc_id"]]]]


@pytest.mark.parametrize("bucket_rows, block_rows", [(4, 3), (4, 1000), (1024, 1000)])
def test_dense_groups_are_split_and_stay_whole(spark, bucket_rows, block_rows):
    rng = np.random.default_rng(3)
    prints = set()
    for base in rng.integers(0, 1 << 63, 12, dtype=np.uint64):
        for _ in range(50):
            value = int(base)
            for bit in rng.integers(0, 64, rng.integers(0, 7)):
                value ^= 1 << int(bit)
            prints.add(value)
    signed = [(int(np.uint64(p).view(np.int64)),) for p in prints]
    df = spark.createDataFrame(signed, "fp long")
    roots = {r["node"]: r["root"] for r in components(linked_pairs(df, 3, bucket_rows, block_rows)).collect()}
    expected = groups_of(prints)
    by_root, by_expected = {}, {}
    for p in prints:
        s = int(np.uint64(p).view(np.int64))
        by_root.setdefault(roots.get(s, s), set()).add(p)
        by_expected.setdefault(expected[p], set()).add(p)
    assert sorted(map(sorted, by_root.values())) == sorted(map(sorted, by_expected.values()))


def test_one_large_cluster_is_dealt_to_bounded_nodes(spark):
    """Fingerprints that agree in all but eleven low bits, started in blocks."""
    prints = [(i,) for i in range(0, 2048, 3)]
    df = spark.createDataFrame(prints, "fp long")
    sizes = start_nodes(df, 3, 8, 10).groupBy("path", "node").count().collect()
    assert max(r["count"] for r in sizes) <= 45
    assert max(r["count"] for r in start_nodes(df, 3, 8).groupBy("path", "node").count().collect()) > 300
    links = linked_pairs(df, 3, 8, 10)
    roots = {r["node"]: r["root"] for r in components(links).collect()}
    expected = groups_of([p for p, in prints])
    assert {p: roots.get(p, p) for p, in prints} == expected


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(60)], "a long, b long")
    assert {r["root"] for r in components(edges).collect()} == {0}


def test_odd_documents(spark):
    docs = odd_documents(spark)
    groups = simhash_groups(as_rows(docs))
    rows = groups.rows.join(groups.prints, "fp").collect()
    assert len(rows) == docs.count()
    blank = [r for r in rows if not (r["row"]["text"] or "").split()]
    assert {r["component_id"] for r in blank} == {3} and {r["fp"] for r in blank} == {0}
    kept = keep_one_of_each(spark, docs, "")
    assert kept.columns == docs.columns
    # One of each: copies of 1, of 2 and of the blank ones go; the row without id stays.
    assert ids(kept) == [1, 2, 3, 7, 8, 9, 10, None]


def test_no_documents(spark):
    assert keep_one_of_each(spark, no_documents(spark), "").count() == 0
