import sqlite3

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import tuples
from weirflow.operators.datamart import append_snapshot, create_datamart, next_snapshot_id
from weirflow.sources import dbtable
from weirflow.sources.jdbc import (
    append_table, chunk_starts, execute, read_query, read_table, read_table_by_ranges,
)
from weirflow.sources.ranges import identifier, range_predicates

# Negative keys, keys above 32 bits, one key a third of all rows, NULLs.
KEYS = [-5, -1, 0, 7, 2**40, 2**40 + 1, *range(100, 140), *[55] * 30, None, None]


@settings(max_examples=80, deadline=None)
@given(
    keys=st.lists(st.one_of(st.none(), st.integers(-50, 50)), max_size=60),
    starts=st.lists(st.integers(-60, 60), max_size=12),
    tie=st.booleans(),
)
def test_predicates_cover_every_row_once(keys, starts, tie):
    database = sqlite3.connect(":memory:")
    database.execute("CREATE TABLE t (k INTEGER, tie INTEGER)")
    rows = [(k, None if i % 7 == 0 else i - 30) for i, k in enumerate(keys)]
    database.executemany("INSERT INTO t VALUES (?, ?)", rows)
    predicates = range_predicates(
        "k", sorted(starts), has_nulls=None in keys, tie_column="tie" if tie else None,
        modulo="({0} % {1})",
    )
    got = [r for p in predicates for r in database.execute(f"SELECT k, tie FROM t WHERE {p}")]
    assert sorted(got, key=str) == sorted(rows, key=str)


def test_chunk_starts_mark_heavy_keys():
    assert chunk_starts([3, 9, 9, 9, 20]) == [4, 9, 9, 9, 21]
    assert range_predicates("k", [4, 9, 9], has_nulls=False, tie_column="t")[1] == "k >= 4 AND k < 9"


@pytest.mark.parametrize("name", ["a b", "t; DROP TABLE x", "", "1a", 'a"b'])
def test_identifiers_are_plain(name):
    with pytest.raises(ValueError):
        identifier(name)


def users(spark, derby, rows, name="users"):
    execute(spark, derby, f"CREATE TABLE {name} (user_id BIGINT, user_name VARCHAR(64), n INTEGER)")
    append_table(spark.createDataFrame(rows, "user_id long, user_name string, n int"), derby, name)


def test_range_scan_of_fifty_users_has_six_chunks(spark, derby):
    users(spark, derby, [(i, f"user_{i}", i) for i in range(1, 51)])
    scan = read_table_by_ranges(spark, derby, "users", column="user_id", rows_per_chunk=9)
    assert scan.rdd.getNumPartitions() == 6
    assert sorted(r[0] for r in scan.collect()) == list(range(1, 51))
    sizes = [r["count"] for r in scan.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) <= 9


@pytest.mark.parametrize("tie", [None, "n"])
def test_range_scan_of_awkward_keys(spark, derby, tie):
    users(spark, derby, [(k, f"u{k}", i) for i, k in enumerate(KEYS)])
    scan = read_table_by_ranges(
        spark, derby, "users", column="user_id", rows_per_chunk=8, tie_column=tie
    )
    got = [r[0] for r in scan.collect()]
    assert sorted(got, key=str) == sorted(KEYS, key=str)
    if tie:
        heavy = scan.filter("user_id = 55").groupBy(F.spark_partition_id()).count()
        assert heavy.count() >= 3


def test_range_scan_without_size_or_column(spark, derby):
    users(spark, derby, [(1, "a", 1)])
    assert read_table_by_ranges(spark, derby, "users").rdd.getNumPartitions() == 1
    assert read_table_by_ranges(
        spark, derby, "users", column="user_id", rows_per_chunk=-1
    ).count() == 1
    with pytest.raises(ValueError):
        read_table_by_ranges(spark, derby, "users", rows_per_chunk=5)


def test_jdbc_prunes_and_pushes_down(spark, derby):
    users(spark, derby, [(i, f"user_{i}", i) for i in range(20)])
    scan = read_table_by_ranges(spark, derby, "users", column="user_id", rows_per_chunk=5)
    plan = scan.filter("n > 3").select("user_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(N,3)" in plan and "ReadSchema: struct<USER_ID:bigint>" in plan


def test_datamart_snapshots(spark, derby):
    create_datamart(spark, derby)
    rows = [("total_rides", 3.0), ("dist_min", 0.0)]
    metrics = spark.createDataFrame(rows, "metric string, value double")
    assert next_snapshot_id(spark, derby) == 0
    assert [append_snapshot(metrics, derby) for _ in range(2)] == [0, 1]
    stats = read_query(spark, derby, "SELECT MAX(id) AS m, COUNT(*) AS n FROM rides_datamart")
    assert tuples(stats) == [(1, 4)]
    # The same id twice violates the key, and nothing of the second write stays.
    clash = metrics.selectExpr("1 AS id", "metric", "value").unionByName(
        spark.createDataFrame([(1, "new", 1.0)], "id int, metric string, value double")
    )
    with pytest.raises(Exception, match="duplicate|SQLIntegrity|BatchUpdate"):
        append_table(clash.coalesce(1), derby, "rides_datamart")
    assert read_table(spark, derby, "rides_datamart").count() == 4


def create(options, table="users", columns="user_id BIGINT, user_name VARCHAR(64), n INTEGER"):
    dbtable.execute({**options, "tableName": table}, f"CREATE TABLE {table} ({columns})")
    return {**options, "tableName": table}


def reader(spark, options, **extra):
    return spark.read.format(dbtable.FORMAT).options(**options).options(**extra)


@pytest.fixture
def store(spark, sqlite):
    dbtable.register(spark)
    return create(sqlite)


def fill(options, rows):
    with sqlite3.connect(options["url"]) as database:
        database.executemany("INSERT INTO users VALUES (?, ?, ?)", rows)


def test_table_format_default_schema_and_chunks(spark, store):
    fill(store, [(i, f"user_{i}", i) for i in range(1, 51)])
    scan = reader(spark, store, partitioningColumn="user_id", partitionSize="9").load()
    assert scan.schema.simpleString() == "struct<user_id:bigint,user_name:string>"
    assert scan.rdd.getNumPartitions() == 6
    sizes = [r["count"] for r in scan.groupBy(F.spark_partition_id()).count().collect()]
    assert sorted(sizes) == [5, 9, 9, 9, 9, 9]
    assert reader(spark, store).load().rdd.getNumPartitions() == 1


@pytest.mark.parametrize("tie", [{}, {"tieColumn": "n"}])
def test_table_format_awkward_keys(spark, store, tie):
    fill(store, [(k, None, i) for i, k in enumerate(KEYS)])
    scan = reader(spark, store, partitioningColumn="user_id", partitionSize="8", **tie).load()
    got = [r[0] for r in scan.collect()]
    assert sorted(got, key=str) == sorted(KEYS, key=str)


def test_table_format_rejects_bad_options(spark, store):
    for options in ({"partitionSize": "5"}, {"tableName": "a; b"}, {"driver": ""}):
        with pytest.raises(Exception, match="partition|identifier|missing"):
            reader(spark, {**store, **options}).load().collect()


def test_table_format_append_is_whole(spark, store):
    rows = spark.range(60, 71).selectExpr("id AS user_id", "concat('user_', id) AS user_name")
    rows.repartition(3).write.format(dbtable.FORMAT).options(**store).mode("append").save()
    assert sorted(tuples(reader(spark, store).load())) == [(i, f"user_{i}") for i in range(60, 71)]
    with sqlite3.connect(store["url"]) as database:
        names = [r[0] for r in database.execute("SELECT name FROM sqlite_master")]
    assert names == ["users"]


def test_table_format_failed_write_leaves_nothing(spark, store):
    fail = F.when(F.col("id") == 9, F.raise_error(F.lit("broken row"))).otherwise("x")
    rows = spark.range(0, 10, 1, 4).select(F.col("id").alias("user_id"), fail.alias("user_name"))
    with pytest.raises(Exception, match="broken row"):
        rows.write.format(dbtable.FORMAT).options(**store).mode("append").save()
    assert reader(spark, store).load().count() == 0
    with sqlite3.connect(store["url"]) as database:
        assert database.execute("SELECT COUNT(*) FROM sqlite_master").fetchone() == (1,)


def test_table_format_does_not_overwrite(spark, store):
    with pytest.raises(Exception, match="appends only"):
        spark.range(1).selectExpr("id AS user_id").write.format(dbtable.FORMAT).options(
            **store
        ).mode("overwrite").save()
