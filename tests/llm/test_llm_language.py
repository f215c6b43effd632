import zlib

from pyspark.sql import functions as F

from llm_cases import ids, no_documents, odd_documents
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows
from weirflow.llm.language import (
    HASHES, LanguageModel, fit_languages, identify_languages, keep_identified, ngrams, slots,
)


def test_ngrams_around_every_letter():
    hashes, owners, letters = ngrams(["ab", "", "7", "b a"])
    assert letters.tolist() == [2, 0, 0, 2]
    assert [int((owners == i).sum()) for i in range(4)] == [8, 0, 0, 8]
    again, _, _ = ngrams(["AB"])
    assert sorted(again) == sorted(hashes[owners == 0])


def test_filters_answer_with_all_languages(spark):
    import numpy as np

    grams = ngrams(["zwölf"])[0]
    planes = np.zeros((1, 1 << 20), np.uint64)
    for at in slots(grams):
        planes[0][at] |= np.uint64(0b101)
    model = LanguageModel(["a", "b", "c"], planes)
    hits = model.hits(grams, np.zeros(len(grams), np.int64), 1)
    assert hits[:, 0].tolist() == [len(grams), 0, len(grams)]
    assert len(slots(grams)) == HASHES


def test_held_out_accuracy(spark, sf, documents):
    found = all_queries()["op9_language"](spark, sf)
    assert found.count() == documents.count()
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").collect()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert 0 <= r["score"] <= 1
    held = [r for r in rows if r["held_out"] and r["lang"]]
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.97 * len(held)


def test_a_rare_language_is_learned(spark):
    """The sample is taken per language, so a frequent one crowds out no other."""
    rows = [(i, f"the quiet river and a lazy dog number {'x' * (i % 7)}", "en") for i in range(4000)]
    rows += [(10_000 + i, "zwölf süße Äpfel fürs Frühstück", "de") for i in range(5)]
    rows += [(None, f"words without any id {'y' * (i % 50)}", "en") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = fit_languages(docs, training_documents=20)
    assert model.languages == ["de", "en"]
    assert model.predict(["süße Äpfel"])[0]["lang_pred"] == "de"


def test_odd_documents(spark):
    docs = odd_documents(spark)
    model = fit_languages(docs)
    found = identify_languages(as_rows(docs), model).select("row.doc_id", "row.text", "result.*")
    for r in found.collect():
        letters = r["text"] is not None and any(c.isalpha() for c in r["text"])
        assert r["lang_pred"] == ("en" if letters else "und")
        assert r["score"] == 0 or letters
    kept = keep_identified(spark, docs, "")
    assert kept.columns == docs.columns
    assert ids(kept) == [1, 1, 2, 8, 9, 9, 10, None]


def test_nothing_to_learn(spark):
    model = fit_languages(no_documents(spark))
    assert model.languages == []
    docs = odd_documents(spark)
    found = identify_languages(as_rows(docs), model)
    assert found.filter(F.col("result.lang_pred") != "und").count() == 0
    assert keep_identified(spark, no_documents(spark), "").count() == 0
