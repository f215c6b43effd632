import hashlib
import random

import numpy as np

from llm_cases import no_documents, odd_documents, prose
from weirflow.llm import syncmers as y
from weirflow.llm.catalog import all_queries


def plain_places(text):
    places = []
    for i in range(len(text) - y.K + 1):
        inner = [int(y._rolling(y.code_points(text[i + j : i + j + y.S]), y.S)[0])
                 for j in range(y.K - y.S + 1)]
        if min(inner) in (inner[0], inner[-1]):
            places.append(i)
    return places


def test_rolling_hash_is_the_polynomial():
    points = y.code_points("some text é\U0001f600 here and there")
    for width in (1, 2, 5, 12, 13):
        one = [int(y._rolling(points[i : i + width], width)[0]) for i in range(len(points) - width + 1)]
        assert one == y._rolling(points, width).tolist()


def test_anchors_equal_brute_force_and_ignore_neighbours():
    texts = [prose(1, 30), "short", "", "x" * 40, prose(2, 10)]
    for text, (hashes, places) in zip(texts, y.anchors(texts)):
        if len(text) >= y.K:
            assert places.tolist() == plain_places(text)
        else:
            assert len(hashes) == (1 if text else 0)
    alone, inside = y.anchors([texts[0], "before it " + texts[0] + " after"])
    shifted = dict(zip((inside[1] - 10).tolist(), inside[0].tolist()))
    assert all(shifted[p] == h for h, p in zip(*map(np.ndarray.tolist, alone)))
    a, b = y.sketch(alone), y.sketch(inside)
    assert {int(d) for d in np.diff(y.positional_matches(a, b))} == {10}


def test_likeness():
    a, b, none = (y.sketches([t])[0][0] for t in (prose(1, 300), prose(3, 300), ""))
    assert y.likeness(a, a) == 1 == y.likeness(none, none) and y.likeness(a, none) == 0
    half = y.sketches([y.edited(prose(1, 300), "".join(random.Random(1).choices("qwxz ", k=2000)))])[0][0]
    assert 0.3 < y.likeness(a, half) < 0.7 and y.likeness(a, half) == y.likeness(half, a)
    assert 0 <= y.likeness(a, b) < 0.9


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""),
                     reverse=True)
    out = []
    for (doc, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1]):
        new = y.edited(text or "", following or "")
        own, changed, nxt = (s[0] for s in y.sketches([text or "", new, following or ""]))
        out.append((doc, len(text or ""), hashlib.sha256(new.encode()).hexdigest(),
                    y.fingerprint_text(own), y.fingerprint_text(changed), y.likeness(own, changed),
                    y.likeness(own, nxt)))
    return sorted(out, key=str)


def test_query(spark, sf, documents):
    got = all_queries()["op10_syncmers"](spark, sf).collect()
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert sorted(map(tuple, got), key=str) == expected(rows)
    long = [r for r in got if r["n_chars"] > 500 and r["near_next"] < 0.1]
    assert sum(0.3 < r["near_edited"] < 0.7 for r in long) > 0.9 * len(long)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(prints) == 1 for prints in by_text.values())


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted(map(tuple, y.compare_with_next(docs).collect()), key=str) == expected(rows)
    assert y.compare_with_next(no_documents(spark)).count() == 0
    for only in (docs.filter("doc_id is null"), docs.filter("doc_id = 4"), docs.filter("doc_id = 1")):
        rows = [(r["doc_id"], r["text"]) for r in only.collect()]
        assert sorted(map(tuple, y.compare_with_next(only).collect()), key=str) == expected(rows)


def test_fingerprints_of_a_table(spark):
    got = y.fingerprint_documents(odd_documents(spark)).collect()
    assert len(got) == odd_documents(spark).count()
    assert all(len(r["hashes"]) == len(r["places"]) for r in got)
    assert max(len(r["hashes"]) for r in got) > y.SKETCH  # all anchors, no sketch
    small = y.fingerprint_documents(odd_documents(spark), size=y.SKETCH).collect()
    assert max(len(r["hashes"]) for r in small) == y.SKETCH
    assert all(8 * len(r["hashes"]) == len(r["fingerprint"]) for r in got)


def test_long_documents_keep_all_anchors(spark):
    """A passage that two long documents share, and an edit anywhere, count in full."""
    word = lambda rnd: "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz", k=rnd.randint(3, 8)))
    a, b, c = (" ".join(word(random.Random(1000 * i + j)) for j in range(4000)) for i in range(3))
    passage = c[:300]
    docs = spark.createDataFrame([(2, a + passage + a), (1, b + passage)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in y.compare_with_next(docs).collect()}
    (own, _), (nxt, _), (common, _) = y.sketches([a + passage + a, b + passage, passage])
    assert got[2]["near_next"] >= 2 * (len(common) - 4) / (len(own) + len(nxt))
    assert len(got[2]["fingerprint"]) == 8 * len(plain_places(a + passage + a))
    whole = {r["key"]: r for r in y.fingerprint_documents(docs).collect()}
    assert whole[2]["fingerprint"] == got[2]["fingerprint"]
    assert whole[2]["places"] == plain_places(a + passage + a)


def test_matching_is_the_longest_common_subsequence(monkeypatch):
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, z in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == z else max(row[j], row[j + 1])
        return row[-1]

    rnd = random.Random(3)
    for trial in range(300):
        kinds = rnd.choice([1, 2, 5, 100])
        a, b = ([rnd.randrange(kinds) for _ in range(rnd.choice([0, 1, 20, 90]))] for _ in range(2))
        monkeypatch.setattr(y, "MASK_BYTES", rnd.choice([0, 1 << 20]))
        assert y.matched(np.array(a, np.int64), np.array(b, np.int64)) == plain(a, b)
        at = {v: [j for j in range(len(b) - 1, -1, -1) if b[j] == v] for v in b}
        both = [v for v in a if v in at]
        assert y._by_pairs(both, at) == y._by_bits(both, at, len(b)) == plain(a, b)
    forth, back = np.arange(50), np.arange(50)[::-1]
    assert y.likeness(forth, back) == 0.02  # equal sets, but in another order


def test_ranges_hold_about_equal_bytes(spark, monkeypatch):
    """A stretch of ids with long texts is cut into more ranges, each its own task."""
    rows = [(i, prose(i, 2000 if 300 <= i < 400 else 5)) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bounds = []
    deal = y._deal
    monkeypatch.setattr(y, "_deal", lambda b: bounds.append(b) or deal(b))
    got = y.compare_with_next(docs)
    (cuts,) = bounds
    held = np.zeros(len(cuts), np.int64)
    for doc, text in rows:
        held[len(cuts) - 1 - np.searchsorted(cuts[::-1], doc)] += len(text)
    assert held.max() < 4 * held.sum() / len(cuts)
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows)
