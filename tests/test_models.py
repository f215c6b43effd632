import random

import pytest
from pyspark.sql import functions as F

from weirflow.ml.training import (
    assemble, fit_label_index, load_model, restore_labels, save_model, split_rows,
    train_classifier, train_text_classifier,
)

FEATURES = ["a", "b"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(1)
    data = []
    for i in range(600):
        kind = ("low", "middle", "high")[i % 3]
        data.append((i, draw.gauss(10 * (i % 3), 1.0), draw.random(), kind, i % 3))
    columns = "id int, a double, b double, kind string, code int"
    return spark.createDataFrame(data, columns).repartition(4)


def test_index_is_by_frequency_then_name(spark):
    df = spark.createDataFrame([(x,) for x in "bbaaccc"], "k string")
    indexer = fit_label_index(df, "k")
    assert indexer.labels == ["c", "a", "b"]
    back = restore_labels(indexer, "class", "again").transform(indexer.transform(df))
    assert back.filter("k <> again").count() == 0


@pytest.mark.parametrize("key", [None, ["id"]])
def test_split_is_disjoint_whole_and_repeatable(rows, key):
    train, test = split_rows(rows, key=key)
    a, b = ({r.id for r in part.collect()} for part in (train, test))
    assert not a & b and len(a | b) == 600
    assert 0.6 < len(a) / 600 < 0.8
    again, _ = split_rows(rows, key=key)
    assert {r.id for r in again.collect()} == a


def test_split_by_key_ignores_partitioning(rows):
    one, _ = split_rows(rows, key=["id"])
    two, _ = split_rows(rows.repartition(9, "b"), key=["id"])
    assert {r.id for r in one.collect()} == {r.id for r in two.collect()}


def test_text_classifier_saved_and_loaded(rows, tmp_path):
    trained = train_text_classifier(
        rows, features=FEATURES, label="kind", predicted="predicted", key=["id"]
    )
    assert trained.metrics.first().accuracy > 0.95
    for _ in range(2):  # the second save replaces the first
        save_model(trained.model, str(tmp_path / "m"))
    model = load_model(str(tmp_path / "m"))
    scored = model.transform(rows.drop("kind"))  # scoring rows have no label
    assert {"rawPrediction", "probability", "prediction", "predicted"} <= set(scored.columns)
    joined = scored.join(rows.select("id", "kind"), "id")
    assert joined.filter("kind = predicted").count() / 600 > 0.95


def test_numeric_classifier(rows):
    trained = train_classifier(rows, features=FEATURES, label="code", seed=3)
    metrics = trained.metrics.first()
    assert metrics.accuracy > 0.95 and metrics.false_positive_rate < 0.05


def test_assembler_refuses_nulls(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="null"):
        assemble(FEATURES).transform(df).select(F.col("features")).collect()
