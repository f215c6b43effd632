"""Physical plans: what is scanned, what is shuffled, and what is not."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from weirflow.functions.parsing import parse_json_messages, split_usable
from weirflow.operators.ranking import tail_per_partition, top_k
from weirflow.schemas import IRIS_MEASURES

QUERIES = entry.queries()


def plan(df, execute=False):
    if execute:
        df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", ["popular_dims", "popular_dims_sql"])
def test_facts_are_counted_before_any_shuffle(spark, sf, no_broadcast, name):
    text = plan(QUERIES[name](spark, sf))
    assert "SortMergeJoin" in text or "ShuffledHashJoin" in text
    # One exchange per side, reused by the join, and one for the final order.
    assert text.count("Exchange hashpartitioning") == 2
    assert text.count("Exchange rangepartitioning") == 1
    assert re.search(r"Exchange hashpartitioning\(l_suppkey.*\n[^\n]*partial_count", text)
    assert "ReadSchema: struct<l_suppkey:bigint>" in text


def test_small_dimension_is_broadcast_by_measured_size(spark, sf):
    assert "BroadcastHashJoin" in plan(QUERIES["popular_dims"](spark, sf))


def test_reconciliation_scans_the_facts_once(spark, sf):
    assert plan(QUERIES["reconcile_counts"](spark, sf)).count("l_suppkey:bigint>") == 1


def test_first_and_last_share_the_aggregation(spark, sf):
    df = QUERIES["first_last_rows"](spark, sf)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("+- == Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert "TakeOrderedAndProject" in final


def test_tail_keeps_n_rows_per_task_before_the_shuffle(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    text = plan(tail_per_partition(events, partition=["user_id"], position="event_id", n=5))
    assert text.index("WindowGroupLimit") < text.index("Exchange")
    assert re.search(r"Exchange hashpartitioning.*\n[^\n]*WindowGroupLimit.*Partial", text)


def test_top_k_never_sorts_the_table(spark, sf):
    part = spark.read.parquet(f"{sf}/part.parquet")
    text = plan(top_k(part.filter("p_type = 'ECONOMY'"), [F.desc("p_retailprice")]))
    assert "TakeOrderedAndProject" in text and "Exchange" not in text
    assert "EqualTo(p_type,ECONOMY)" in text


def test_counts_by_class_hash(spark, sf):
    text = plan(QUERIES["class_balance"](spark, sf))
    lowest = text[text.rindex("Exchange"):]
    assert "HashAggregate" in lowest and "SortAggregate" not in lowest


def test_messages_are_parsed_once(spark):
    df = spark.createDataFrame([("{}",)], "value string").repartition(2)
    good, _ = split_usable(parse_json_messages(df, IRIS_MEASURES), IRIS_MEASURES.fieldNames())
    assert plan(good).count("from_json(") == 1


def test_no_query_joins_everything_with_everything(spark, sf):
    for name in ("popular_dims", "reconcile_counts", "number_rows", "nested_json_topk"):
        text = plan(QUERIES[name](spark, sf))
        assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_inventory_brings_no_name_through_the_plan(spark, sf):
    """Only the manifest is scanned: no list of names as a literal or local table."""
    text = plan(QUERIES["file_inventory"](spark, sf))
    assert text.count("FileScan parquet") == 1 and "/manifest-" in text
    assert not re.search("LocalTableScan|explode|OneRowRelation|Scan ExistingRDD", text)
