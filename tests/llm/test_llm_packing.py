import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from llm_cases import no_documents, odd_documents
from weirflow.llm import packing as p
from weirflow.llm.catalog import all_queries


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def expected_pieces(rows, tokenizer):
    pieces = []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for number, start in enumerate(range(0, len(ids), 2048)):
            own = ids[start : start + 2048]
            pieces.append((doc, number, start, len(own), zlib.crc32(own.tobytes())))
    return sorted(pieces, key=str)


def check_packed(packed, rows, tokenizer):
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in packed]
    assert sorted(got, key=str) == expected_pieces(rows, tokenizer)
    ends = {}
    for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert all(end <= 2048 for end in ends.values())
    return len(ends)


def best_fit_decreasing(sizes, capacity):
    gaps, bins = [], 0
    for size in sorted(sizes, reverse=True):
        i = bisect_left(gaps, size)
        if i == len(gaps):
            bins += 1
            insort(gaps, capacity - size)
        else:
            insort(gaps, gaps.pop(i) - size)
    return bins


def test_plan_is_whole_and_no_worse_than_best_fit_decreasing():
    rnd = random.Random(2)
    for _ in range(200):
        capacity = rnd.choice([7, 30, 100, 2048])
        most = rnd.choice([capacity, max(1, capacity // 2), max(1, capacity // 6)])
        sizes = [rnd.randint(1, most) for _ in range(rnd.choice([0, 1, 5, 50, 400]))]
        bins = p.plan_bins(Counter(sizes), capacity)
        inside = Counter()
        for b in bins:
            assert b.count > 0 and b.gap >= 0
            assert sum(n * e for n, e in b.content) + b.gap == capacity
            assert sum(e for n, e in b.content if 3 * n > capacity) <= 2
            for length, each in b.content:
                inside[length] += each * b.count
        assert inside == Counter(sizes)
        assert sum(b.count for b in bins) <= best_fit_decreasing(sizes, capacity)


def test_plan_size_does_not_follow_the_number_of_pieces():
    rnd = random.Random(1)
    few = Counter(min(2048, int(rnd.lognormvariate(6, 1)) + 1) for _ in range(50_000))
    many = Counter({length: 1000 * n for length, n in few.items()})
    assert len(p.plan_places(p.plan_bins(many))) < 3 * len(p.plan_places(p.plan_bins(few))) < 60_000


def test_query(spark, sf, documents, tokenizer):
    packed = all_queries()["op1_packing"](spark, sf).collect()
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    bins = check_packed(packed, rows, tokenizer)
    assert bins <= 1.02 * -(-sum(r["length"] for r in packed) // 2048) + 1


def test_odd_documents(spark, tokenizer):
    docs = odd_documents(spark)
    extra = [(20, "a\x1cb \x1f c"), (21, "x" * 5000), (22, "<|endoftext|> a<|startoftext|>b"),
             (23, "it's\x85we'll　Éé ΣΑΣ 1234 !?"), (24, "é ̈ İstanbul İ, ªº ǅ ŉ ß. ẞ"), (25, "don't! a's, b'LL 'tis, x.y z- ﬁ ² ½ naïve, à! b,́")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string"), True)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    check_packed(p.pack(spark, docs, "").collect(), rows, tokenizer)


def test_no_documents(spark):
    assert p.pack(spark, no_documents(spark), "").count() == 0


def test_cache_is_bounded(monkeypatch, tokenizer):
    monkeypatch.setattr(p, "CACHED_WORDS", 5)
    own = p.WordTokenizer(None)
    for text in ("a b c d", "e f g h i j k", "a a b " + "long" * 40):
        own.learn([text])
        assert len(own.words) <= 7
        own.forget_long()
        (words,) = own.learn([text])
        assert own.ids(text, words).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_sequences_are_rebuilt_without_a_tokenizer(spark, tokenizer, monkeypatch):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    stream = lambda pieces: b"".join(bytes(r["ids"]) for r in pieces)
    for rows_sent in (p.BROADCAST_ROWS, 0):
        monkeypatch.setattr(p, "BROADCAST_ROWS", rows_sent)
        packed = p.pack_documents(docs).collect()
        assert all(len(r["ids"]) == 4 * r["length"] for r in packed)
        sequences = {}
        for r in sorted(packed, key=lambda r: (r["sequence_id"], r["offset"])):
            sequences[r["sequence_id"]] = sequences.get(r["sequence_id"], b"") + bytes(r["ids"])
            assert len(sequences[r["sequence_id"]]) == 4 * (r["offset"] + r["length"])
        long = sorted((r for r in packed if r["doc_id"] == 8), key=lambda r: r["piece"])
        (text,) = [t for d, t in rows if d == 8]
        assert np.frombuffer(stream(long), "<u4").tolist() == [
            *tokenizer.encode(text, add_special_tokens=False).ids, 0]


def test_lower_case_and_set_off_marks_change_no_id(tokenizer):
    own = p.WordTokenizer(None)
    rnd = random.Random(4)
    signs = list("aZéÉßø09½²ªº.,!?'\"-_()<>|/ \t\n\xa0¿«»€ŉǅİ") + [
        "<|endoftext|>", "<|ENDOFTEXT|>", "'s", "'LL", "n't", "Word", "e\u0301", "...", "\x1c"]
    for _ in range(3000):
        text = "".join(rnd.choices(signs, k=rnd.randint(0, 25)))
        if rnd.random() < 0.7:
            text = text.replace("İ", "").replace("e\u0301", "").replace("<|", "")
        (words,) = own.learn([text])
        assert own.ids(text, words).tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
