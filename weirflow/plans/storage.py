"""Tables, views, overwrites, compaction and inventories."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators.compaction import TARGET_FILE_BYTES, compact_folders
from weirflow.operators.metrics import as_metric_rows, summary_metrics
from weirflow.plans.popularity import METRIC_ROWS
from weirflow.plans.registry import Registry, table
from weirflow.plans.scans import CUSTOMER
from weirflow.sinks.files import save_csv, save_parquet
from weirflow.sources.catalog import (
    columnar_copy, create_database, external_parquet_table, external_text_table,
)
from weirflow.operators.chunks import key_chunks
from weirflow.sources.hadoop import copy_file
from weirflow.sources.rangetable import read_key_range, write_range_table
from weirflow.sources.files import data_files, list_files, read_parquet
from weirflow.workspace import new_path

plans = Registry()


def _database(spark):
    location = new_path(spark, "catalog")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, location)
    return name


@plans.query(
    "external_table",
    "SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders",
)
def external_table(spark, sf):
    """A table over files that stay where they are. The result holds the files,
    so the table and its database go at once."""
    database = _database(spark)
    external_parquet_table(spark, f"{database}.orders", f"{sf.rstrip('/')}/orders.parquet")
    orders = spark.table(f"{database}.orders")
    result = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    spark.sql(f"DROP DATABASE {database} CASCADE")
    return result


@plans.query(
    "text_table_to_orc",
    "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def text_table_to_orc(spark, sf):
    """Delimited text with header → external table → managed ORC table."""
    path = new_path(spark, "customer-text")
    save_csv(table(spark, sf, "customer").select(*CUSTOMER.fieldNames()), path)
    database = _database(spark)
    external_text_table(spark, f"{database}.customer_raw", path, CUSTOMER)
    columnar_copy(spark, f"{database}.customer", f"{database}.customer_raw", CUSTOMER)
    return spark.table(f"{database}.customer")


@plans.query(
    "parquet_overwrite",
    f"SELECT metric, value, 1 AS num_files FROM ({METRIC_ROWS}) m",
)
def parquet_overwrite(spark, sf):
    """Five metric rows, written twice to the same place as one file."""
    path = new_path(spark, "metrics")
    rows = as_metric_rows(summary_metrics(table(spark, sf, "lineitem"), "l_quantity"))
    for attempt in (rows.limit(1), rows):
        save_parquet(attempt, path, mode="overwrite", single_file=True)
    files = data_files(list_files(spark, path)).agg(F.count(F.lit(1)).cast("int").alias("num_files")).first()[0]
    return read_parquet(spark, path).select(
        "metric", F.round("value", 3).alias("value"), F.lit(files).alias("num_files")
    )


def _dated_lines(spark, sf):
    """(date, value, half): events as delimited lines."""
    return table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.to_csv(F.struct("event_id", "user_id", "event_type", "props")).alias("value"),
        (F.col("event_id") % 2).alias("half"),
    )


def _stage_events(spark, sf):
    """Event lines in date folders of small files, with strays among them."""
    path = new_path(spark, "stage")
    lines = _dated_lines(spark, sf)
    # Two rounds of arrivals leave at least two parts in most folders.
    for half in (0, 1):
        lines.filter(F.col("half") == half).drop("half").write.mode("append").partitionBy(
            "date"
        ).text(path)
    # Not named like a finished part, so neither read nor counted.
    lines.filter(F.col("value").contains("error")).drop("half").write.mode("append").option(
        "compression", "gzip"
    ).partitionBy("date").text(path)
    return path


_FINISHED = r"^part-\d{5}-.*\.txt$"
# A field with quotes is quoted, and its quotes get a backslash.
_EVENT_LINE = r"""coalesce(CAST(event_id AS VARCHAR), '') || ',' || coalesce(CAST(user_id AS VARCHAR), '')
    || ',' || coalesce(event_type, '') || ',' || coalesce('"' || replace(props, '"', '\"') || '"', '')"""


@plans.query(
    "compact_partitions",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS date, {_EVENT_LINE} AS line FROM events""",
)
def compact_partitions(spark, sf):
    stage, target = _stage_events(spark, sf), new_path(spark, "ods")
    compact_folders(spark, stage, target, part_pattern=_FINISHED)
    lines = spark.read.option("lineSep", "\n").text(target)
    return lines.select(F.date_format("date", "yyyy-MM-dd").alias("date"), F.col("value").alias("line"))


@plans.query(
    "compact_file_counts",
    f"""SELECT strftime(ts, '%Y-%m-%d') AS date,
        CAST(ceil(sum(strlen({_EVENT_LINE}) + 1) / {TARGET_FILE_BYTES}.0) AS INTEGER) AS num_files
    FROM events GROUP BY 1""",
)
def compact_file_counts(spark, sf):
    """A compacted folder holds one file for each started target size."""
    stage, target = _stage_events(spark, sf), new_path(spark, "ods")
    compact_folders(spark, stage, target, part_pattern=_FINISHED, delete_sources=True)
    return data_files(list_files(spark, target)).groupBy(
        F.substring_index("folder", "=", -1).alias("date")
    ).agg(F.count(F.lit(1)).cast("int").alias("num_files"))


@plans.query(
    "file_inventory",
    f"""SELECT 'root/date=' || strftime(ts, '%Y-%m-%d') || '/event_type=' || event_type AS folder,
        CAST(count(DISTINCT name) AS INTEGER) AS num_names, CAST(sum(bytes) AS BIGINT) AS num_bytes
    FROM (SELECT ts, event_type, 'lines' AS name, strlen({_EVENT_LINE}) + 1 AS bytes FROM events) e GROUP BY 1
    UNION ALL SELECT 'root/.hidden/_lists', 1, CAST(sum(strlen(r_name) + 1) AS BIGINT) FROM region
    UNION ALL SELECT 'root', 1, 0 UNION ALL SELECT 'empty', 2, 0""",
)
def file_inventory(spark, sf):
    """Names and bytes per folder of a generated tree, from file listings alone:
    data files three levels down, a hidden file in hidden folders, empty files and
    the markers of finished jobs. All parts of a folder count as one name."""
    top = new_path(spark, "tree")
    lines = table(spark, sf, "events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("date"), "event_type",
        F.to_csv(F.struct("event_id", "user_id", "event_type", "props")).alias("value"),
    )
    lines.write.partitionBy("date", "event_type").text(f"{top}/root")
    spark.range(0).select(F.lit("").alias("value")).write.text(f"{top}/empty")
    names = table(spark, sf, "region").select(F.col("r_name").alias("value"))
    hidden = new_path(spark, "names")
    names.coalesce(1).write.text(hidden)
    copy_file(spark, f"{hidden}/part-*", f"{top}/root/.hidden/_lists/.regions")
    name = F.regexp_replace("name", "^part-.*", "part")
    return list_files(spark, top).groupBy("folder").agg(
        F.countDistinct(name).cast("int").alias("num_names"), F.sum("length").alias("num_bytes")
    )


_CHUNK_ROWS = 700


@plans.query(
    "key_chunks",
    f"""WITH ranked AS (
        SELECT o_custkey, o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1 AS place,
            count(*) OVER () AS n FROM orders),
    sized AS (SELECT *, CAST(ceil(n / {_CHUNK_ROWS}.0) AS BIGINT) AS chunks FROM ranked),
    placed AS (SELECT *, ((place + 1) * chunks + n - 1) // n - 1 AS chunk FROM sized)
    SELECT CAST(chunk AS INTEGER) AS chunk, arg_min(o_custkey, place) AS first_key,
        arg_min(o_orderkey, place) AS first_tie, arg_max(o_custkey, place) AS last_key,
        arg_max(o_orderkey, place) AS last_tie, count(*) AS num_rows
    FROM placed GROUP BY chunk""",
)
def equal_chunks(spark, sf):
    """Orders by customer in chunks of equal size, ties by order."""
    return key_chunks(table(spark, sf, "orders"), key="o_custkey", tie="o_orderkey", size=_CHUNK_ROWS)


_RANGED = """SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 40 WHEN c_custkey % 11 = 0 THEN NULL
    ELSE c_custkey END AS part_key FROM customer"""


@plans.query(
    "range_index_scan",
    f"""SELECT * REPLACE (coalesce(part_key, -1) AS part_key) FROM ({_RANGED}) c
    WHERE part_key BETWEEN 20 AND 500 OR part_key IS NULL""",
)
def range_index_scan(spark, sf):
    """A closed range of a table kept by key ranges, with the rows that have no key.
    A third of the rows have one key."""
    path = new_path(spark, "ranges")
    rows = table(spark, sf, "customer").withColumn(
        "part_key", F.when(F.col("c_custkey") % 3 == 0, 40).when(F.col("c_custkey") % 11 != 0, F.col("c_custkey"))
    )
    write_range_table(rows, path, key="part_key", tie="c_custkey", rows_per_range=100)
    found = read_key_range(spark, path, 20, 500, nulls=True)
    return found.withColumn("part_key", F.coalesce("part_key", F.lit(-1)))
