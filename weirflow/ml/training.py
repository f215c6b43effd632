"""Classifier training and storage with Spark ML."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from weirflow.operators.labels import label_metrics


@dataclass(frozen=True)
class Trained:
    """`metrics` are those of the test part; `removed` counts the rows that a job
    left out before training."""

    model: PipelineModel
    metrics: DataFrame
    test: DataFrame
    removed: int = 0


def fit_label_index(df: DataFrame, label: str, index: str = "class") -> StringIndexerModel:
    """Most frequent label gets 0; equally frequent ones go by name."""
    return StringIndexer(inputCol=label, outputCol=index).fit(df)


def restore_labels(indexer: StringIndexerModel, index: str, output: str) -> IndexToString:
    return IndexToString(inputCol=index, outputCol=output, labels=indexer.labels)


def assemble(features: Sequence[str], output: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=list(features), outputCol=output)


def split_rows(
    df: DataFrame, *, train_share: float = 0.7, seed: int = 42, key: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(training rows, test rows), disjoint and complete.

    With a unique `key` a row's side follows from a hash of it: no sort, and
    the same side in every run whatever the partitioning. Without, Spark's
    seeded random split, which sorts each partition first.
    """
    if key is None:
        train, test = df.randomSplit([train_share, 1 - train_share], seed)
        return train, test
    share = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(1_000_000)) < int(train_share * 1_000_000)
    return df.filter(share), df.filter(~share)


def bounded_sample(df: DataFrame, rows: int, key: Sequence[str]) -> DataFrame:
    """About `rows` rows, chosen by a hash of the key over the whole table; all
    rows of a smaller one."""
    share = min(1.0, rows / max(1, df.count()))
    place = F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 40))
    return df.filter(place < F.lit(int(share * (1 << 40))))


def train_text_classifier(
    df: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    predicted: str = "predictedSpecies",
    seed: int = 42,
    key: Sequence[str] | None = None,
    most_rows: int | None = None,
) -> Trained:
    """Tree over a text label: index, assemble, tree, label text back.

    The label index covers all rows, so that a class missing from the training
    part still has its number. Scoring rows need no label column. With `most_rows`
    (and a key) the tree is fitted and tested on a sample of about that size.
    """
    indexer = fit_label_index(df, label)
    if most_rows is not None:
        df = bounded_sample(df, most_rows, key or [])
    tree = DecisionTreeClassifier(labelCol="class", featuresCol="features", seed=seed)
    stages = [indexer, assemble(features), tree, restore_labels(indexer, "prediction", predicted)]
    return _fit(df, Pipeline(stages=stages), "class", seed, key)


def train_classifier(
    df: DataFrame,
    *,
    features: Sequence[str],
    label: str,
    seed: int = 42,
    key: Sequence[str] | None = None,
) -> Trained:
    """Tree over a numeric label 0, 1, …"""
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="features", seed=seed)
    return _fit(df, Pipeline(stages=[assemble(features), tree]), label, seed, key)


def _fit(df: DataFrame, stages: Pipeline, label: str, seed: int, key) -> Trained:
    train, test = split_rows(df, seed=seed, key=key)
    model = stages.fit(train)
    metrics = label_metrics(model.transform(test), label=label, prediction="prediction")
    return Trained(model, metrics, test)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
