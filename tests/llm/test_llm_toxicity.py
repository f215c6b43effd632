import numpy as np
from pyspark.sql import functions as F

from llm_cases import no_documents, odd_documents
from weirflow.llm import toxicity as t
from weirflow.llm.catalog import all_queries
from weirflow.llm.common import as_rows


def test_ordinal_fit_shares_weights_and_orders_thresholds():
    rng = np.random.default_rng(1)
    vectors = [sorted(np.flatnonzero(rng.random(6) < 0.4).tolist()) for _ in range(3000)]
    true = np.array([3.0, -2.0, 1.5, 0.0, 0.0, 2.0])
    margin = np.array([true[v].sum() for v in vectors]) + rng.logistic(size=3000)
    grades = np.searchsorted([1.0, 3.0, 5.0], margin)
    weights, thresholds = t.fit_ordinal(vectors, grades, 6, 4)
    assert np.all(np.diff(thresholds) > 0)
    assert np.abs(weights - true).max() < 0.5 and np.abs(thresholds - [1, 3, 5]).max() < 0.5


def test_probabilities():
    model = t.SeverityModel({"x": 0}, np.array([4.0]), np.array([1.0, 2.0, 6.0]))
    chance, grade, expected = model.predict(model.vectors(["x", "y", None]))
    assert chance[0] > 0.5 > chance[1] == chance[2]
    assert grade.tolist() == [2, 0, 0] and expected[0] > expected[1] > 0


def test_held_out_accuracy(spark, sf):
    sf = sf.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "labels"))
    held = F.expr("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1")
    model = t.fit_severity(docs, labels.filter(~held))
    found = t.grade_toxicity(as_rows(docs.select("doc_id", "text")), model)
    rows = found.select("row.doc_id", "result.*").join(labels.filter(held), "doc_id").collect()
    said = [(r["p_toxic"] >= 0.5, r["toxic"] == 1) for r in rows]
    assert sum(s and y for s, y in said) >= 0.75 * sum(y for _, y in said)
    assert sum(s and not y for s, y in said) <= 0.03 * sum(not y for _, y in said)
    assert all(0 <= r["expected_severity"] <= t.GRADES - 1 and 0 <= r["severity"] < t.GRADES for r in rows)


def test_query_covers_all_documents(spark, sf, documents):
    got = all_queries()["op2_toxicity"](spark, sf)
    assert got.count() == documents.count()
    assert got.filter("toxic").count() > 0


def test_odd_tables(spark):
    docs = odd_documents(spark)
    labels = spark.createDataFrame([(1, 1), (None, 1), (3, 0), (2, None), (2, 0), (9, 0), (1, 1)],
                                   "doc_id long, toxic int")
    model = t.fit_severity(docs, labels)
    assert t.grade_toxicity(as_rows(docs), model).count() == docs.count()
    none = t.fit_severity(docs, labels.limit(0))
    assert t.grade_toxicity(as_rows(docs), none).filter("result.severity > 0").count() == 0
    assert t.grade_toxicity(as_rows(no_documents(spark)), model).count() == 0


def test_long_words_are_told_apart():
    a, b = "x" * 40, "x" * 39 + "y"
    assert not (t.features(a) & t.features(b)) - {"xxxx*", "xxxxx*", "xxxxxx*"}
    assert t.features(a) - t.features(b) and len(max(t.features(a), key=len)) < 40
    model = t.SeverityModel({t.bases(a)[0]: 0, t.bases(b)[0] + "2": 1}, np.zeros(2), np.array([0.0]))
    assert model.vectors([a, b, f"{b} {b}", None]) == [[0], [], [1], []]
