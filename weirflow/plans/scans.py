"""Text formats: written from the given tables, read back with declared schemas."""

from __future__ import annotations

from pyspark.sql import functions as F

from weirflow.functions.calendar import SECONDS_PATTERN, date_parts, parse_timestamp, time_parts
from weirflow.functions.parsing import (
    parse_csv_messages, parse_json_messages, split_usable,
)
from weirflow.operators.documents import rows_per_document
from weirflow.plans.registry import Registry, table
from weirflow.schemas import COUNTRIES, struct_of
from weirflow.sinks.files import (
    save_by_partition, save_csv, save_json_array, save_json_document,
)
from weirflow.sinks.messages import as_messages
from weirflow.sources.files import read_csv, read_day, read_json_arrays, read_lines_numbered
from weirflow.sources.records import read_csv_quoted_lines, read_json_array_split
from weirflow.workspace import new_path

plans = Registry()

CUSTOMER = struct_of(
    c_custkey="long",
    c_name="string",
    c_nationkey="int",
    c_acctbal="double",
    c_mktsegment="string",
)
SENSOR_LINE = struct_of(
    date="string",
    event_id="long",
    user_id="long",
    event_type="string",
    value="double",
)
EVENT_LAKE = struct_of(
    event_id="long",
    user_id="long",
    event_type="string",
    value="double",
    hour="int",
    minute="int",
    second="int",
)


def event_lines(events):
    """Events as delimited text, one line each, timestamps cut to seconds. A
    NULL is an empty field, and separators within a field are quoted."""
    time = F.date_format("ts", SECONDS_PATTERN).alias("date")
    return F.to_csv(F.struct(time, *[events[c] for c in SENSOR_LINE.fieldNames()[1:]]))


_CUSTOMER = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"


@plans.query("csv_scan", _CUSTOMER)
def csv_scan(spark, sf):
    path = new_path(spark, "customer-csv")
    save_csv(table(spark, sf, "customer").select(*CUSTOMER.fieldNames()), path)
    return read_csv(spark, path, CUSTOMER)


@plans.query(
    "csv_typed_failfast",
    "SELECT c_name AS key, c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def csv_typed_failfast(spark, sf):
    """CSV rows under strict types, sent as JSON under the name, parsed back."""
    path = new_path(spark, "customer-feed")
    save_csv(table(spark, sf, "customer").select(*CUSTOMER.fieldNames()), path)
    messages = as_messages(read_csv(spark, path, CUSTOMER, strict=True), key="c_name")
    return parse_json_messages(messages, CUSTOMER, keep=["key"]).select(
        "key", "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment"
    )


@plans.query(
    "json_day_scan",
    """SELECT event_id, user_id, event_type, value, hour(ts) AS hour, minute(ts) AS minute,
        second(ts) AS second, year(ts) AS year, month(ts) AS month, day(ts) AS day
    FROM events WHERE ts >= TIMESTAMP '2024-01-15' AND ts < TIMESTAMP '2024-01-16'""",
)
def json_day_scan(spark, sf):
    """All events land in a lake by day; one day is read through its root."""
    path = new_path(spark, "event-lake")
    rows = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", "value", *time_parts("ts"), *date_parts("ts")
    )
    save_by_partition(rows, path, ["year", "month", "day"])
    day = read_day(spark, path, EVENT_LAKE, "2024-01-15")
    return day.withColumns(
        {c: F.col(c).cast("long") for c in ("hour", "minute", "second", "year", "month", "day")}
    )


@plans.query(
    "nested_json_topk",
    """SELECT upper(c_name) AS name, coalesce(capital, '<Undefined>') AS capital, area FROM (
        SELECT c_name, c_acctbal AS area,
            CASE WHEN c_custkey % 3 > 0 THEN n_name END AS capital
        FROM customer JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'AFRICA') t
    ORDER BY area DESC, upper(c_name) LIMIT 10""",
)
def nested_json_topk(spark, sf):
    """Customers as country-like nested documents: the ten richest of a region,
    written as one JSON array and read back."""
    from weirflow.jobs.batch import largest_countries

    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    documents = (
        table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.struct(F.col("c_name").alias("common"), F.upper("c_name").alias("official")).alias(
                "name"
            ),
            F.col("r_name").alias("region"),
            F.col("c_acctbal").alias("area"),
            F.when(F.col("c_custkey") % 3 == 0, F.array().cast("array<string>"))
            .when(F.col("c_custkey") % 3 == 1, F.array("n_name"))
            .otherwise(F.array("n_name", "r_name"))
            .alias("capital"),
        )
    )
    source, report = new_path(spark, "documents"), new_path(spark, "report")
    save_json_array(documents, source, rows_per_document=rows_per_document(documents))
    top = largest_countries(read_json_arrays(spark, source, COUNTRIES), region="AFRICA", k=10)
    save_json_array(top, report, rows_per_document=10)
    answer = struct_of(name="string", capital="string", area="double")
    return read_json_arrays(spark, report, answer)


@plans.query(
    "parse_json_col",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def parse_json_col(spark, sf):
    events = table(spark, sf, "events").withColumn("value", F.col("props").cast("binary"))
    schema = struct_of(k="long")
    return parse_json_messages(events, schema, keep=["event_id"]).select("event_id", "k")


@plans.query(
    "parse_csv_col",
    """SELECT event_id, user_id, event_type, value, year(ts) AS year, month(ts) AS month,
        day(ts) AS day, hour(ts) AS hour, minute(ts) AS minute, second(ts) AS second
    FROM events""",
)
def parse_csv_col(spark, sf):
    """Events as CSV text, parsed to a struct, with the calendar parts of the
    parsed time."""
    from weirflow.streaming.landing import measurements

    events = table(spark, sf, "events")
    messages = events.select(event_lines(events).cast("binary").alias("value"))
    parts = ("year", "month", "day", "hour", "minute", "second")
    rows, _ = measurements(messages, SENSOR_LINE)
    return rows.withColumns({c: F.col(c).cast("long") for c in parts})


@plans.query(
    "to_json_rows",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey, o_custkey, o_orderstatus,
        o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, o_orderpriority FROM orders""",
)
def to_json_rows(spark, sf):
    """Orders packed to (key, JSON value) and, for the check, parsed back."""
    schema = struct_of(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="string",
        o_orderpriority="string",
    )
    orders = table(spark, sf, "orders")
    rows = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    messages = as_messages(rows, key="o_orderkey")
    return parse_json_messages(messages, schema, keep=["key"]).drop("raw_message")


@plans.query(
    "bad_message_split",
    """SELECT event_type, count(*) AS num_messages,
        CAST(sum(CASE WHEN event_type = 'error' THEN 0 ELSE 1 END) AS BIGINT) AS num_usable
    FROM events GROUP BY event_type""",
)
def bad_message_split(spark, sf):
    """Every message is routed to exactly one output. Error events arrive with
    an unparsable time and number."""
    events = table(spark, sf, "events")
    broken = F.col("event_type") == "error"
    line = F.to_csv(F.struct(
        F.when(broken, F.lit("no time")).otherwise(F.date_format("ts", SECONDS_PATTERN)).alias("date"),
        "event_id", "user_id", "event_type",
        F.when(broken, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
    ))
    rows = parse_csv_messages(events.select(line.alias("value")), SENSOR_LINE).withColumn(
        "timestamp", parse_timestamp("date", SECONDS_PATTERN)
    )
    good, bad = split_usable(rows, ["timestamp", "value"])
    kind = F.split("raw_message", ",")[3].alias("event_type")
    both = good.select(kind, F.lit(1).alias("usable")).unionByName(
        bad.select(kind, F.lit(0).alias("usable"))
    )
    return both.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("num_messages"), F.sum("usable").alias("num_usable")
    )


@plans.query(
    "numbered_lines",
    """SELECT CAST(row_number() OVER (ORDER BY event_id) AS VARCHAR) AS key,
        concat_ws(',', event_id, user_id, event_type) AS value FROM events""",
)
def numbered_lines(spark, sf):
    """A text feed with header, replayed as messages keyed by running number."""
    path = new_path(spark, "feed")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    save_csv(events.orderBy("event_id"), path)
    return read_lines_numbered(spark, path)


@plans.query("json_array_split_scan", "SELECT * FROM customer")
def json_array_split_scan(spark, sf):
    """All customers as one JSON array, cut at its top-level commas by the tasks that
    read it. A column and a nested one hold what the scan must not cut at."""
    customer = table(spark, sf, "customer")
    path = new_path(spark, "customer-array")
    odd = F.concat(F.lit('],{"\\"['), "c_name", F.lit("\n,}]"))
    rows = customer.withColumns({"odd": odd, "nested": F.array(F.struct("c_nationkey", "c_name"))})
    save_json_document(rows, path)
    back = read_json_array_split(spark, path, rows.schema, parts=True)
    intact = (F.col("odd") == odd) & (F.col("nested")[0]["c_name"] == F.col("c_name"))
    return back.filter(intact).select(*customer.columns)


@plans.query(
    "json_document_parts",
    """SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders""",
)
def json_document_parts(spark, sf):
    """Orders as one JSON array in ordered parts, whatever its size, read back."""
    path = new_path(spark, "orders-document")
    orders = table(spark, sf, "orders")
    rows = orders.withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    save_json_document(rows, path, order=[F.asc("o_orderkey")])
    return read_json_array_split(spark, path, rows.schema, parts=True)


@plans.query("csv_quoted_lines_scan", "SELECT * FROM documents")
def csv_quoted_lines_scan(spark, sf):
    """Documents as delimited text; their texts hold line ends, commas and quotes."""
    documents, path = table(spark, sf, "documents"), new_path(spark, "documents-csv")
    documents.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return read_csv_quoted_lines(spark, path, documents.schema, strict=True)
