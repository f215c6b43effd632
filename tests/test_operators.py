import json
import math

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from helpers import tuples
from weirflow.operators.documents import pack_json_arrays, rows_per_document
from weirflow.operators.labels import class_balance, label_metrics
from weirflow.operators.metrics import as_metric_rows, null_profile, summary_metrics
from weirflow.operators.ranking import first_and_last, number_rows, tail_per_partition, top_k
from weirflow.sinks.files import save_json_array


def test_metrics_sample_and_population(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (None,)], "d double")
    sample = summary_metrics(df, "d").first()
    assert tuple(sample)[:4] == (3.0, 1.0, 4.0, 7 / 3)
    assert math.isclose(sample.dist_std_dev, math.sqrt(7 / 3))
    population = summary_metrics(df, "d", population=True).first()
    assert math.isclose(population.dist_std_dev, math.sqrt(14 / 9))
    rows = dict(tuples(as_metric_rows(summary_metrics(df, "d"))))
    assert list(rows) == ["total_rides", "dist_min", "dist_max", "dist_average", "dist_std_dev"]
    assert rows["total_rides"] == 3.0


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, None, "y")], "a int, b int, `c d` string")
    assert dict(tuples(null_profile(df))) == {"a": 1, "b": 2, "c d": 0}


def test_top_k_ties_and_first_last(spark):
    df = spark.createDataFrame([("b", 1), ("a", 1), ("c", 3), ("d", 0)], "k string, v int")
    order = [F.desc("v"), F.asc("k")]
    assert tuples(top_k(df, order, 3)) == [("c", 3), ("a", 1), ("b", 1)]
    ends = first_and_last(df, order=order, reverse=[F.asc("v"), F.desc("k")])
    assert tuples(ends) == [("first", "c", 3), ("last", "d", 0)]


def test_tail_of_partitions_of_all_sizes(spark):
    sizes = {1: 3, 2: 5, 3: 12}
    rows = [(p, o) for p, n in sizes.items() for o in range(n)]
    tail = tail_per_partition(
        spark.createDataFrame(rows, "p int, o long"), partition=["p"], position="o", n=5
    )
    got = {(r.p, r.o) for r in tail.collect()}
    assert got == {(p, o) for p, n in sizes.items() for o in range(max(n - 5, 0), n)}
    assert {r.num_from_end for r in tail.filter("p = 3").collect()} == {1, 2, 3, 4, 5}


def test_number_rows_is_global_and_gapless(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 7919 % 5000).alias("v"))
    numbered = number_rows(df, [F.asc("v")])
    assert sorted(tuples(numbered)) == [(i, i + 1) for i in range(5000)]
    assert number_rows(df.limit(0), [F.asc("v")]).count() == 0


def test_json_documents_keep_rows_and_bound(spark, tmp_path):
    df = spark.range(0, 1003, 1, 3)
    (whole,) = pack_json_arrays(df.coalesce(1), 1003).collect()
    assert [o["id"] for o in json.loads(whole["value"])] == list(range(1003))
    assert rows_per_document(df, 130) == 10 and rows_per_document(df.limit(0), 130) > 1
    parts = [json.loads(r["value"]) for r in pack_json_arrays(df, 100).collect()]
    assert max(map(len, parts)) <= 100
    assert sorted(o["id"] for p in parts for o in p) == list(range(1003))
    save_json_array(df.limit(0), str(tmp_path / "none"), rows_per_document=10)
    assert [r[0] for r in spark.read.text(str(tmp_path / "none")).collect()] == ["[]"]


def test_label_metrics_equal_the_evaluator(spark):
    pairs = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 4 + [(1, 0)] * 3 + [(2, 2)] * 2 + [(2, 0)]
    df = spark.createDataFrame(pairs, "label int, p int")
    ours = label_metrics(df, label="label", prediction="p").first().asDict()
    names = {
        "accuracy": "accuracy",
        "precision": "precisionByLabel",
        "recall": "recallByLabel",
        "true_positive_rate": "truePositiveRateByLabel",
        "false_positive_rate": "falsePositiveRateByLabel",
    }
    typed = df.select(F.col("label").cast("double"), F.col("p").cast("double"))
    for mine, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(
            labelCol="label", predictionCol="p", metricName=theirs, metricLabel=0.0
        )
        assert math.isclose(ours[mine], evaluator.evaluate(typed)), mine


def test_label_metrics_without_the_label(spark):
    df = spark.createDataFrame([(1, 1)], "label int, p int")
    assert tuple(label_metrics(df, label="label", prediction="p").first()) == (1, 0, 0, 0, 0)


def test_class_balance(spark):
    df = spark.createDataFrame([("x", 0.0), ("x", 0.0), ("y", 1.0)], "species string, class double")
    assert sorted(tuples(class_balance(df, label="species", index="class"))) == [
        (0.0, "x", 2), (1.0, "y", 1),
    ]


def test_preview_prints_rows_whole(spark, capfd):
    from weirflow.sinks.console import preview

    preview(spark.createDataFrame([("x" * 40, 1)], "a string, b int"))
    assert "x" * 40 in capfd.readouterr().out
