import random
import re
from pathlib import Path

import duckdb

from llm_cases import CLASHING, ids, no_documents, odd_documents, prose
from weirflow.llm import decontamination as d
from weirflow.llm.catalog import all_oracles, all_queries
from weirflow.llm.common import as_rows


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{Path(sf) / name}.parquet'")
    got = all_queries()["op4_decontamination"](spark, sf).toPandas()
    want = con.execute(all_oracles()["op4_decontamination"]).df()[list(got.columns)]
    assert sorted(map(tuple, got.values.tolist())) == sorted(map(tuple, want.values.tolist()))
    assert got["contaminated"].any()


def plain(text, items, window=13):
    split = lambda t: re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = split(text), set(), set()
    for name, item in items:
        own = split(item)
        size = min(window, len(own))
        grams = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in grams:
                hit |= set(range(i, i + size))
                found.add(name)
    return len(words), len(hit), sorted(map(str, found))


def test_random_texts_and_blocks(spark):
    rnd = random.Random(5)
    vocabulary = ["a", "b", "c", "Dé", "e1", "f"]
    text = lambda n: "".join(rnd.choice(vocabulary) + rnd.choice([" ", "-", ", "]) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 5, 9]))) for i in range(8)] + [(2, "a b c Dé e1")]
    docs = [(i, text(rnd.choice([0, 2, 30, 200])), ) for i in range(40)]
    rows = as_rows(spark.createDataFrame(docs, "doc_id long, text string"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (1 << 20, 150):
        got = d.find_contamination(rows, bench, window=4, block_bytes=block_bytes).collect()
        assert len(got) == len(docs)
        for r in got:
            hits = r["result"]["hits"]
            n_hit = sum(hits[1::2]) - sum(hits[::2])
            expected = plain(r["row"]["text"], items, 4)
            assert (r["result"]["n_words"], n_hit, r["result"]["items"]) == expected


def test_longest_matches(spark):
    passage = prose(4, 40)
    docs = spark.createDataFrame(
        [(1, "start " + passage), (2, prose(4, 20)), (3, None)], "doc_id long, text string"
    )
    bench = spark.createDataFrame([(7, "other words " + passage)], "item_id long, text string")
    best = d.longest_matches(docs, bench).collect()
    assert [tuple(r) for r in best] == [("7", 40, 2, "1", 1)]


def test_longest_matches_over_blocks(spark):
    """Items of every block are searched, and documents get their longest match."""
    rnd = random.Random(8)
    text = lambda n: " ".join(rnd.choice("abcdef") for _ in range(n))
    items = [(i, text(rnd.choice([2, 6, 30]))) for i in range(12)] + [(3, text(25)), (20, "a a a a q " * 3)]
    docs = [(i, text(rnd.choice([3, 40, 150])) + rnd.choice(["", " " + items[i % 14][1]])) for i in range(25)]

    def best(one, other, size):  # longest match of at least the item's window
        a, b = one.split(), other.split()
        row, most = [0] * (len(b) + 1), 0
        for x in a:
            row = [0] + [row[j] + 1 if x == y else 0 for j, y in enumerate(b)]
            most = max(most, *row)
        return most if most >= min(size, len(b)) else 0

    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    by_item = {}
    for name, item in items:
        by_item[str(name)] = max(by_item.get(str(name), 0), *(best(t, item, 5) for _, t in docs))
    for block_bytes in (1 << 20, 300):
        got = {r["item"]: r for r in d.longest_matches(
            frame, bench, window=5, block_bytes=block_bytes).collect()}
        assert {k: r["words"] for k, r in got.items()} == {k: v for k, v in by_item.items() if v}
        for r in d.find_contamination(as_rows(frame), bench, window=5, block_bytes=block_bytes).collect():
            most, x = max(best(r["row"]["text"], i, 5) for _, i in items), r["result"]["longest"]
            assert (x["words"] if x else 0) == most
            if x:
                words = r["row"]["text"].split()[x["doc_word"] :][: x["words"]]
                assert any(i.split()[x["item_word"] :][: x["words"]] == words
                           for name, i in items if str(name) == x["item"])


def test_odd_cases(spark, tmp_path):
    docs = odd_documents(spark)
    bench = spark.createDataFrame(
        [(1, prose(2)), (None, prose(1)), (3, None), (4, ""), (4, "...")], "item_id long, text string"
    )
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    found = {(r["row"]["doc_id"], r["row"]["text"]): r["result"] for r in
             d.find_contamination(as_rows(docs), bench).collect()}
    assert found[(1, prose(1))]["nameless"] and found[(1, prose(1))]["items"] == []
    assert found[(9, prose(2))]["items"] == ["1"]
    assert found[(3, None)]["n_words"] == 0 == len(found[(3, None)]["hits"])
    kept = d.remove_contaminated(spark, docs, str(tmp_path))
    assert kept.columns == docs.columns and set(CLASHING) < set(kept.columns)
    assert ids(kept) == [3, 4, 6, 7, 8, 9, 10, None, None]


def test_empty_tables(spark, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    none.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd_documents(spark)
    assert d.remove_contaminated(spark, docs, str(tmp_path)).count() == docs.count()
    assert d.remove_contaminated(spark, no_documents(spark), str(tmp_path)).count() == 0
