import random
import re
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from llm_cases import no_documents, odd_documents
from weirflow.llm import collocations as module
from weirflow.llm.catalog import all_oracles, all_queries
from weirflow.llm.collocations import HatTrie, Limits, Words, byte_values, mine_collocations, pack_run, unpack_run

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def pieces_of(text):
    pieces = re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER))
    return [re.findall("[^\x20\x09]+", p) for p in pieces]


def brute_force(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for words in pieces_of(text):
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    hidden = set()
    for (lang, words), a in found.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                if a >= f[lang, words[i:i + k]]:
                    hidden.add((lang, words[i:i + k]))
    result = []
    for lang in n:
        rows = []
        for (own, words), a in found.items():
            if own == lang and (lang, words) not in hidden:
                cuts = [(1000 * a * n[lang] // (f[lang, words[:k]] * f[lang, words[k:]]), k)
                        for k in range(1, len(words))]
                score, k = min(cuts)
                phrase = " ".join(words)
                rows.append((-score, -a, phrase.encode(), phrase, f[lang, words[:k]], f[lang, words[k:]]))
        for rank, (s, a, _, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            result.append((lang, rank, phrase, -a, l, r, n[lang], -s))
    return sorted(result)


def mined(spark, rows, least, top=2000, limits=Limits()):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, ids string, n int")
    got = mine_collocations(df.repartition(3), text="text", lang="lang", least=least, top=top, limits=limits)
    assert got.columns == COLUMNS
    return sorted(map(tuple, got.collect()))


def random_texts(seed, texts=60, words=120, vocabulary=14):
    rng = random.Random(seed)
    names = [w + rng.choice(["", "é", "X"]) for w in "a b c d e f g h i j k l m n".split()[:vocabulary]]
    weights = [1 / (i + 1) for i in range(len(names))]
    ends = [" ", " ", " ", "\t", "  ", ". ", ",", "\n", " ;"]
    return [
        (rng.choice(["en", "de", None]),
         "".join(w + rng.choice(ends) for w in rng.choices(names, weights, k=rng.randint(0, words))))
        for _ in range(texts)
    ]


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01"])
def test_query(spark, name):
    folder = f"/root/testdata/{name}"
    connection = duckdb.connect()
    file = Path(folder) / "documents.parquet"
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{file}'")
    want = connection.execute(all_oracles()["op13_collocations"]).df()[COLUMNS]
    got = all_queries()["op13_collocations"](spark, folder)
    assert [t for _, t in got.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    rows = sorted(map(tuple, got.collect()))
    assert rows and rows == sorted(want.itertuples(index=False, name=None))


@pytest.mark.parametrize("seed, least, top", [(1, 5, 2000), (2, 2, 2000), (3, 3, 7)])
def test_brute_force(spark, seed, least, top):
    rows = random_texts(seed)
    assert mined(spark, rows, least, top) == brute_force(rows, least, top) != []


def test_bursts_spills_and_hot_words(spark):
    """Small limits: containers burst, subtrees are spilled again and again, frequent
    words deepen the prefix partitions, and texts are cut into chunks."""
    limits = Limits(
        chunk_bytes=64, bitmap_bits=128, burst=5, entries=40, hot_words=50, partition_windows=300
    )
    rows = random_texts(5)
    assert mined(spark, rows, 3, limits=limits) == brute_force(rows, 3, 2000) != []


def test_ids_that_clash(spark, monkeypatch):
    """Under the first seed all bytes weigh the same."""
    real = module.byte_values
    monkeypatch.setattr(module, "byte_values", lambda seed: real(seed) if seed else np.ones(256, np.uint64))
    rows = random_texts(7, texts=20)
    df = spark.createDataFrame(rows, "lang string, text string")
    _, values = module.word_table(df.fillna("und", ["lang"]), Limits())
    assert (values == real(1)).all()
    assert mined(spark, rows, 4) == brute_force(rows, 4, 2000)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["lang"], r["text"]) for r in docs.collect()]
    rows += [(None, "to be  or\tnot to be. To be or not to be"), ("und", "TO BE or not\rto be"), ("é", "x" * 70_000)]
    assert mined(spark, rows, 2) == brute_force(rows, 2, 2000) != []
    assert mine_collocations(no_documents(spark), text="text", lang="lang").count() == 0
    assert mined(spark, [(None, None), ("en", ""), ("en", "a"), ("en", ". ,")], 1) == []


def test_one_phrase_everywhere(spark):
    rows = [("en", "the same line again and again")] * 300 + [("en", "the end of the line")] * 3
    assert mined(spark, rows, 100) == brute_force(rows, 100, 2000) != []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["en", "de"]), st.text("aB é.\t\n,Ü\U0001f600", max_size=30)), max_size=6),
       st.sampled_from([3, 1 << 21]))
def test_words(rows, chunk):
    texts = pa.array(["skipped", *[t for _, t in rows]], pa.string())[1:]
    words = Words([x for x, _ in rows], texts, byte_values(0), chunk)
    want, piece = [], 0
    for row, (_, text) in enumerate(rows):
        for own in pieces_of(text):
            want += [(row, piece, w) for w in own]
            piece += 1
    got = [(int(words.row[i]), words.text(i)) for i in range(len(words.ids))]
    assert got == [(r, w) for r, _, w in want]
    same = [a[1] == b[1] for a, b in zip(want, want[1:])]
    assert (np.diff(words.piece) == 0).tolist() == same
    ids = {}
    for (row, _, w), i in zip(want, words.ids.tolist()):
        assert ids.setdefault((rows[row][0], w), i) == i
    assert len(set(ids.values())) == len(ids)


@pytest.mark.parametrize("width", [2, 3, 5])
def test_trie_counts_and_spills(width):
    rng = np.random.default_rng(3)
    trie, want, got = HatTrie(width, burst=10), Counter(), Counter()
    for _ in range(8):
        windows = rng.integers(1, 4 if width > 2 else 40, (200, width)).astype(np.uint64)
        want.update(map(tuple, windows.tolist()))
        trie.add(windows)
        rows, counts = unpack_run(pack_run(*trie.spill(100)))
        assert trie.entries <= 100 and rows.tolist() == sorted(rows.tolist())
        got.update(dict(zip(map(tuple, rows.tolist()), counts.tolist())))
    rows, counts = trie.spill(0)
    assert trie.entries == 0 and not trie.root
    for r, n in zip(map(tuple, rows.tolist()), counts.tolist()):
        got[r] += n
    assert got == want
