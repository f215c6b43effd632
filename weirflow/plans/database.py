"""Queries that go through a database.

The database is the one the session names (see the settings below). Without
it, the JDBC queries use a database inside the process of a local session, and
fail with a clear message on a cluster, whose executors could not see it; the
queries of the named table format use a database file in the shared folder.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession, functions as F

from weirflow.operators.datamart import append_snapshot, create_datamart
from weirflow.operators.metrics import as_metric_rows, summary_metrics
from weirflow.plans.popularity import METRIC_ROWS
from weirflow.plans.registry import Registry, table
from weirflow.plans.scans import CUSTOMER
from weirflow.session import is_local
from weirflow.sources import dbtable
from weirflow.sources.jdbc import (
    JdbcDatabase, append_table, execute, read_table, read_table_by_ranges,
)
from weirflow.workspace import shared_root

plans = Registry()

JDBC_URL = "spark.weirflow.jdbc.url"
DBAPI_URL = "spark.weirflow.dbapi.url"


def jdbc_database(spark: SparkSession) -> JdbcDatabase:
    url = spark.conf.get(JDBC_URL, None)
    if url:
        prefix = JDBC_URL.removesuffix("url")
        return JdbcDatabase(
            url,
            driver=spark.conf.get(f"{prefix}driver", None),
            user=spark.conf.get(f"{prefix}user", None),
            password=spark.conf.get(f"{prefix}password", None),
        )
    if not is_local(spark):
        raise RuntimeError(f"set {JDBC_URL} to a database that all executors can reach")
    return JdbcDatabase(
        f"jdbc:derby:memory:weirflow{uuid.uuid4().hex};create=true",
        driver="org.apache.derby.jdbc.EmbeddedDriver",
    )


def dbapi_options(spark: SparkSession) -> dict[str, str]:
    url = spark.conf.get(DBAPI_URL, None)
    if url:
        prefix = DBAPI_URL.removesuffix("url")
        names = ("driver", "user", "password", "connectOptions")
        found = {n: spark.conf.get(f"{prefix}{n}", None) for n in names}
        return {"url": url, **{k: v for k, v in found.items() if v}}
    # A database file in the shared folder, where that is a plain folder.
    folder = shared_root(spark).removeprefix("file:")
    if ":" in folder.split("/", 1)[0]:
        raise RuntimeError(f"set {DBAPI_URL} to a database that all executors can reach")
    os.makedirs(f"{folder}/weirflow", exist_ok=True)
    # Tasks write at the same time; each waits for its turn.
    return {
        "driver": "sqlite3",
        "url": f"{folder}/weirflow/{_unique('tables')}.db",
        "connectOptions": '{"timeout": 600}',
    }


def _unique(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


@plans.query(
    "datamart_append",
    f"""SELECT CAST(id AS INTEGER) AS id, metric, value
    FROM ({METRIC_ROWS}) m, (SELECT 0 AS id UNION ALL SELECT 1) ids""",
)
def datamart_append(spark, sf):
    """The metrics of the fact table, appended twice."""
    database, mart = jdbc_database(spark), _unique("rides_datamart")
    create_datamart(spark, database, mart)
    rows = as_metric_rows(summary_metrics(table(spark, sf, "lineitem"), "l_quantity"))
    for _ in range(2):
        append_snapshot(rows, database, mart)
    stored = read_table(spark, database, mart)
    names = {c.lower(): c for c in stored.columns}
    return stored.select(
        F.col(names["id"]).alias("id"),
        F.col(names["metric"]).alias("metric"),
        F.round(names["value"], 3).alias("value"),
    )


_CUSTOMER_COLUMNS = (
    "c_custkey BIGINT NOT NULL PRIMARY KEY, c_name VARCHAR(64), c_nationkey INTEGER, "
    "c_acctbal DOUBLE PRECISION, c_mktsegment VARCHAR(32)"
)
_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@plans.query("range_partition_scan", _CUSTOMER)
def range_partition_scan(spark, sf):
    """Customers stored in the database, read back in key ranges."""
    database, name = jdbc_database(spark), _unique("customer")
    execute(spark, database, f"CREATE TABLE {name} ({_CUSTOMER_COLUMNS})")
    append_table(table(spark, sf, "customer").select(*CUSTOMER.fieldNames()), database, name)
    stored = read_table_by_ranges(
        spark,
        database,
        name,
        column="c_custkey",
        rows_per_chunk=_chunk_size(spark, sf, "customer"),
    )
    return stored.toDF(*CUSTOMER.fieldNames())


@plans.query("connector_scan", _CUSTOMER)
def connector_scan(spark, sf):
    """The same through the named table format, cut by the database itself."""
    reader = _stored_customers(spark, sf)
    size = _chunk_size(spark, sf, "customer")
    return reader.schema(CUSTOMER).options(
        partitioningColumn="c_custkey", partitionSize=str(size)
    ).load()


@plans.query(
    "connector_roundtrip",
    "SELECT c_custkey AS user_id, c_name AS user_name FROM customer",
)
def connector_roundtrip(spark, sf):
    """Users written through the named table format in two appends, read whole."""
    dbtable.register(spark)
    options = {**dbapi_options(spark), "tableName": _unique("users")}
    _create(options, "user_id BIGINT PRIMARY KEY, user_name VARCHAR(64) NOT NULL")
    users = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("user_name")
    )
    for side in (F.col("user_id") % 2 == 0, F.col("user_id") % 2 == 1):
        users.filter(side).write.format(dbtable.FORMAT).options(**options).mode("append").save()
    return spark.read.format(dbtable.FORMAT).options(**options).load()


def _stored_customers(spark, sf):
    dbtable.register(spark)
    options = {**dbapi_options(spark), "tableName": _unique("customer")}
    _create(options, _CUSTOMER_COLUMNS)
    rows = table(spark, sf, "customer").select(*CUSTOMER.fieldNames())
    rows.write.format(dbtable.FORMAT).options(**options).mode("append").save()
    return spark.read.format(dbtable.FORMAT).options(**options)


def _create(options: dict[str, str], columns: str) -> None:
    dbtable.execute(options, f"CREATE TABLE {options['tableName']} ({columns})")


def _chunk_size(spark, sf, name) -> int:
    """At least eight chunks, and none above a million rows."""
    return max(1, min(1_000_000, table(spark, sf, name).count() // 8))
