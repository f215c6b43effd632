"""Feature, training and evaluation queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from weirflow.ml.training import (
    assemble, fit_label_index, load_model, restore_labels, save_model, split_rows,
    train_text_classifier,
)
from weirflow.operators.labels import class_balance, label_metrics
from weirflow.plans.registry import Registry, table
from weirflow.workspace import new_path

plans = Registry()

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _indexed(spark, sf):
    events = table(spark, sf, "events").select("event_id", "event_type")
    indexer = fit_label_index(events, "event_type")
    return indexer, indexer.transform(events)


@plans.query(
    "label_index",
    """SELECT event_type, CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE)
        AS class
    FROM events GROUP BY event_type""",
)
def label_index(spark, sf):
    _, indexed = _indexed(spark, sf)
    return indexed.select("event_type", "class").distinct()


@plans.query("index_roundtrip", "SELECT event_id, event_type AS restored FROM events")
def index_roundtrip(spark, sf):
    indexer, indexed = _indexed(spark, sf)
    return restore_labels(indexer, "class", "restored").transform(indexed).select(
        "event_id", "restored"
    )


@plans.query(
    "class_balance",
    """SELECT CAST(row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS DOUBLE) AS class,
        event_type AS label, count(*) AS num_rows
    FROM events GROUP BY event_type""",
)
def balance(spark, sf):
    _, indexed = _indexed(spark, sf)
    return class_balance(indexed, label="event_type", index="class")


@plans.query(
    "assemble_features",
    f"SELECT l_orderkey, l_linenumber, {', '.join(FEATURES)} FROM lineitem",
)
def assemble_features(spark, sf):
    """Columns to a vector and back to columns."""
    items = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *FEATURES)
    cells = vector_to_array("features")
    return (
        assemble(FEATURES).transform(items)
        .select("l_orderkey", "l_linenumber", cells.alias("cells"))
        .select(
            "l_orderkey",
            "l_linenumber",
            *[F.col("cells")[i].alias(name) for i, name in enumerate(FEATURES)],
        )
    )


_SPLIT = """SELECT count(*) AS num_rows, count(*) AS num_in_one_part, 0 AS num_in_both,
    1 AS is_near_share FROM events"""


def _split_report(train, test):
    both = train.select("event_id", F.lit(1).alias("a"), F.lit(0).alias("b")).unionByName(
        test.select("event_id", F.lit(0).alias("a"), F.lit(1).alias("b"))
    )
    rows = both.groupBy("event_id").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    return rows.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(F.col("a") + F.col("b") == 1).alias("num_in_one_part"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).cast("int").alias("num_in_both"),
        # Within five standard deviations of the share for this many rows.
        (F.abs(F.avg("a") - 0.7) <= 5 * F.sqrt(0.21 / F.count(F.lit(1)))).cast("int")
        .alias("is_near_share"),
    )


@plans.query("train_split", _SPLIT)
def train_split(spark, sf):
    """70/30 by a hash of the row's key."""
    return _split_report(*split_rows(table(spark, sf, "events"), key=["event_id"]))


@plans.query("train_split_random", _SPLIT)
def train_split_random(spark, sf):
    """70/30 by Spark's seeded random split."""
    return _split_report(*split_rows(table(spark, sf, "events")))


def with_price_class(items):
    """Three text classes a tree can learn from the price."""
    price = F.col("l_extendedprice")
    return items.withColumn(
        "price_class",
        F.when(price > 60_000, "high").when(price > 20_000, "middle").otherwise("low"),
    )


#: Lines the tree is fitted and tested on at most (about).
LABELLED_LINES = 2_000_000


@plans.query(
    "tree_fit_predict",
    """SELECT CASE WHEN l_extendedprice > 60000 THEN 'high' WHEN l_extendedprice > 20000 THEN 'middle'
        ELSE 'low' END AS price_class, count(*) AS num_rows, 1 AS is_accurate
    FROM lineitem GROUP BY 1""",
)
def tree_fit_predict(spark, sf):
    """Fit, save, load, predict: rows per class, and whether nine in ten of
    those held out from training were recognised."""
    key = ["l_orderkey", "l_linenumber", "l_partkey"]
    items = with_price_class(table(spark, sf, "lineitem"))
    path = new_path(spark, "model")
    trained = train_text_classifier(
        items, features=FEATURES, label="price_class", predicted="predicted", key=key,
        most_rows=LABELLED_LINES,
    )
    save_model(trained.model, path)
    model = load_model(path)
    held_out = model.transform(trained.test).groupBy("price_class").agg(
        F.avg((F.col("price_class") == F.col("predicted")).cast("int")).alias("hit")
    )
    rows = model.transform(items).groupBy("price_class").agg(F.count(F.lit(1)).alias("num_rows"))
    return rows.join(held_out, "price_class", "left").select(
        "price_class", "num_rows", (F.coalesce("hit", F.lit(0.0)) > 0.9).cast("int").alias("is_accurate")
    )


@plans.query(
    "classification_metrics",
    """SELECT round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
        round(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1.0 ELSE 0.0 END)
            / sum(CASE WHEN toxic = 0 THEN 1.0 ELSE 0.0 END), 6) AS precision,
        round(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1.0 ELSE 0.0 END)
            / sum(CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END), 6) AS recall,
        round(sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1.0 ELSE 0.0 END)
            / sum(CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END), 6) AS true_positive_rate,
        round(sum(CASE WHEN quality <> 0 AND toxic = 0 THEN 1.0 ELSE 0.0 END)
            / sum(CASE WHEN quality <> 0 THEN 1.0 ELSE 0.0 END), 6) AS false_positive_rate
    FROM labels""",
)
def classification_metrics(spark, sf):
    """Five metrics of label 0 with quality as truth and toxic as prediction."""
    metrics = label_metrics(table(spark, sf, "labels"), label="quality", prediction="toxic")
    return metrics.select(*[F.round(c, 6).alias(c) for c in metrics.columns])
