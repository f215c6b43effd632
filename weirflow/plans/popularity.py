"""Rankings, counts, metrics and top-k over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.operators.metrics import as_metric_rows, null_profile, summary_metrics
from weirflow.operators.popularity import count_by_hour, rank_by_popularity, reconcile_counts
from weirflow.operators.ranking import first_and_last, number_rows, tail_per_partition, top_k
from weirflow.plans.registry import Registry, table
from weirflow.sources.catalog import create_database, create_view, external_parquet_table
from weirflow.workspace import new_path

plans = Registry()

_POPULAR = """
    SELECT s_suppkey, count(*) AS num_lines, min(s_name) AS s_name, min(s_nationkey) AS s_nationkey
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
    GROUP BY s_suppkey"""


def _popular(spark, sf):
    return rank_by_popularity(
        table(spark, sf, "lineitem"),
        table(spark, sf, "supplier"),
        fact_key="l_suppkey",
        dim_key="s_suppkey",
        attributes=["s_name", "s_nationkey"],
        count_name="num_lines",
    )


@plans.query("popular_dims", _POPULAR)
def popular_dims(spark, sf):
    return _popular(spark, sf)


@plans.query("popular_dims_sql", _POPULAR)
def popular_dims_sql(spark, sf):
    """The ranking as a persistent view over external tables. The lines are
    counted per supplier before the join, so that only counts are shuffled."""
    location = new_path(spark, "catalog")
    name = location.rsplit("/", 1)[-1].replace("-", "_")
    create_database(spark, name, location)
    for each in ("lineitem", "supplier"):
        external_parquet_table(spark, f"{name}.{each}", f"{sf.rstrip('/')}/{each}.parquet")
    create_view(
        spark,
        f"{name}.popular_suppliers",
        f"""
        SELECT s.s_suppkey, l.num_lines * s.copies AS num_lines, s.s_name, s.s_nationkey
        FROM (SELECT l_suppkey, count(l_suppkey) AS num_lines
              FROM {name}.lineitem GROUP BY l_suppkey) l
        JOIN (SELECT s_suppkey, count(*) AS copies, min(s_name) AS s_name,
                     min(s_nationkey) AS s_nationkey
              FROM {name}.supplier GROUP BY s_suppkey) s
        ON (l.l_suppkey = s.s_suppkey)
        ORDER BY num_lines DESC, s_suppkey""",
    )
    return spark.table(f"{name}.popular_suppliers")


@plans.query(
    "reconcile_counts",
    """SELECT raw.n AS num_raw, joined.n AS num_joined, raw.n = joined.n AS is_equal
    FROM (SELECT count(*) AS n FROM lineitem) raw,
         (SELECT count(*) AS n FROM lineitem JOIN supplier ON l_suppkey = s_suppkey) joined""",
)
def reconcile(spark, sf):
    return reconcile_counts(
        table(spark, sf, "lineitem"),
        table(spark, sf, "supplier"),
        fact_key="l_suppkey",
        dim_key="s_suppkey",
    )


_HOURS = "SELECT hour(ts) AS event_hour, count(*) AS num_events FROM events GROUP BY hour(ts)"


@plans.query("popular_hours", _HOURS)
def popular_hours(spark, sf):
    hours = count_by_hour(
        table(spark, sf, "events"), "ts", hour_name="event_hour", count_name="num_events"
    )
    return hours.withColumn("event_hour", F.col("event_hour").cast("long"))


@plans.query("popular_hours_sql", _HOURS)
def popular_hours_sql(spark, sf):
    return spark.sql(
        """SELECT CAST(event_hour AS BIGINT) AS event_hour, count(event_time) AS num_events
        FROM (SELECT hour(e.ts) AS event_hour, e.ts AS event_time FROM {events} e) parts
        GROUP BY event_hour
        ORDER BY event_hour ASC""",
        events=table(spark, sf, "events"),
    )


def _metrics_sql(deviation: str) -> str:
    return f"""SELECT CAST(count(l_quantity) AS DOUBLE) AS total_rides,
        min(l_quantity) AS dist_min, max(l_quantity) AS dist_max,
        round(avg(l_quantity), 6) AS dist_average,
        round({deviation}(l_quantity), 6) AS dist_std_dev
    FROM lineitem"""


def _rounded_metrics(spark, sf, population):
    summary = summary_metrics(table(spark, sf, "lineitem"), "l_quantity", population=population)
    return summary.withColumns(
        {c: F.round(c, 6) for c in ("dist_average", "dist_std_dev")}
    )


@plans.query("quantity_metrics", _metrics_sql("stddev_samp"))
def quantity_metrics(spark, sf):
    return _rounded_metrics(spark, sf, population=False)


@plans.query("quantity_metrics_pop", _metrics_sql("stddev_pop"))
def quantity_metrics_pop(spark, sf):
    return _rounded_metrics(spark, sf, population=True)


METRIC_ROWS = """
    SELECT 'total_rides' AS metric, CAST(count(l_quantity) AS DOUBLE) AS value FROM lineitem
    UNION ALL SELECT 'dist_min', min(l_quantity) FROM lineitem
    UNION ALL SELECT 'dist_max', max(l_quantity) FROM lineitem
    UNION ALL SELECT 'dist_average', round(avg(l_quantity), 3) FROM lineitem
    UNION ALL SELECT 'dist_std_dev', round(stddev_samp(l_quantity), 3) FROM lineitem"""


@plans.query("metrics_unpivot", METRIC_ROWS)
def metrics_unpivot(spark, sf):
    rows = as_metric_rows(summary_metrics(table(spark, sf, "lineitem"), "l_quantity"))
    return rows.select("metric", F.round("value", 3).alias("value"))


@plans.query(
    "first_last_rows",
    f"""(SELECT 'first' AS position, * FROM ({_POPULAR}) p
        ORDER BY num_lines DESC, s_suppkey ASC LIMIT 1)
    UNION ALL
    (SELECT 'last' AS position, * FROM ({_POPULAR}) p
        ORDER BY num_lines ASC, s_suppkey DESC LIMIT 1)""",
)
def first_last_rows(spark, sf):
    return first_and_last(
        _popular(spark, sf),
        order=[F.desc("num_lines"), F.asc("s_suppkey")],
        reverse=[F.asc("num_lines"), F.desc("s_suppkey")],
    )


@plans.query(
    "topk_filtered",
    """SELECT p_partkey, p_name, p_retailprice FROM part WHERE p_type = 'ECONOMY'
    ORDER BY p_retailprice DESC, p_partkey LIMIT 10""",
)
def topk_filtered(spark, sf):
    parts = table(spark, sf, "part").filter(F.col("p_type") == "ECONOMY")
    return top_k(parts, [F.desc("p_retailprice"), F.asc("p_partkey")]).select(
        "p_partkey", "p_name", "p_retailprice"
    )


@plans.query(
    "null_profile",
    """WITH e AS (SELECT event_id, CASE WHEN event_type <> 'error' THEN event_type END AS event_type,
        CASE WHEN value >= 1 THEN value END AS value, props FROM events)
    SELECT 'event_id' AS column_name, count(*) - count(event_id) AS num_nulls FROM e
    UNION ALL SELECT 'event_type', count(*) - count(event_type) FROM e
    UNION ALL SELECT 'value', count(*) - count(value) FROM e
    UNION ALL SELECT 'props', count(*) - count(props) FROM e""",
)
def nulls(spark, sf):
    return null_profile(
        table(spark, sf, "events").select(
            "event_id",
            F.when(F.col("event_type") != "error", F.col("event_type")).alias("event_type"),
            F.when(F.col("value") >= 1, F.col("value")).alias("value"),
            "props",
        )
    )


@plans.query(
    "tail_n_per_key",
    """SELECT user_id, event_id, event_type, num_from_end FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS num_from_end
        FROM events) t
    WHERE num_from_end <= 5""",
)
def tail_n_per_key(spark, sf):
    tail = tail_per_partition(
        table(spark, sf, "events"), partition=["user_id"], position="event_id", n=5
    )
    return tail.select(
        "user_id", "event_id", "event_type", F.col("num_from_end").cast("long").alias("num_from_end")
    )


@plans.query(
    "tail_task_sizes",
    """SELECT user_id, greatest(n - 5, 0) AS start_position, n AS end_position,
        n - greatest(n - 5, 0) AS num_items
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) s""",
)
def tail_task_sizes(spark, sf):
    """Start, end and size of each partition's tail read."""
    sizes = table(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("end_position"))
    begin = F.greatest(F.col("end_position") - 5, F.lit(0))
    return sizes.select(
        "user_id",
        begin.alias("start_position"),
        "end_position",
        (F.col("end_position") - begin).alias("num_items"),
    )


_LINE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


@plans.query(
    "number_rows",
    f"""SELECT * REPLACE (CAST(l_shipdate AS VARCHAR) AS l_shipdate),
        row_number() OVER (ORDER BY {', '.join(_LINE_ORDER)}) AS row_num FROM lineitem""",
)
def numbered(spark, sf):
    rows = table(spark, sf, "lineitem")
    rows = rows.withColumn("l_shipdate", F.col("l_shipdate").cast("string"))
    return number_rows(rows, [F.asc(c) for c in _LINE_ORDER])


@plans.query("limit_rows", "SELECT count(*) AS num_rows FROM (SELECT * FROM orders LIMIT 10) t")
def limit_rows(spark, sf):
    return table(spark, sf, "orders").limit(10).agg(F.count(F.lit(1)).alias("num_rows"))


@plans.query(
    "tail_totals",
    """SELECT count(*) AS num_partitions, CAST(sum(least(n, 5)) AS BIGINT) AS num_items
    FROM (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) s""",
)
def tail_totals(spark, sf):
    """Number of partitions and total of their tail read sizes."""
    return tail_task_sizes(spark, sf).agg(
        F.count(F.lit(1)).alias("num_partitions"), F.sum("num_items").alias("num_items")
    )
