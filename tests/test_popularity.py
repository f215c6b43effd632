from datetime import datetime

from helpers import tuples
from weirflow.operators.popularity import count_by_hour, rank_by_popularity, reconcile_counts
from weirflow.schemas import TAXI_ZONES

ZONES = [(1, "Bronx", "A", "Boro"), (2, "Queens", "B", "YELLOW"), (3, "EWR", "C", "EWR")]


def zones(spark, rows=ZONES):
    return spark.createDataFrame(rows, TAXI_ZONES)


def facts(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "PULocationID int")


def ranked(f, z):
    return rank_by_popularity(
        f, z, fact_key="PULocationID", dim_key="LocationID",
        attributes=["Borough", "Zone", "service_zone"],
    )


def test_counts_order_and_ties(spark):
    # 9 has no zone, NULL matches nothing, 3 has no fact, 1 and 2 tie.
    result = ranked(facts(spark, [2, 1, 1, 2, 9, None]), zones(spark))
    assert result.columns == ["LocationID", "num_pickups", "Borough", "Zone", "service_zone"]
    assert tuples(result) == [(1, 2, "Bronx", "A", "Boro"), (2, 2, "Queens", "B", "YELLOW")]


def test_repeated_dimension_key_multiplies_like_a_row_join(spark):
    f, z = facts(spark, [1, 1, 2]), zones(spark, ZONES + [(1, "Bronx", "A2", "Boro")])
    expected = {
        r.LocationID: r["count"]
        for r in f.join(z, f.PULocationID == z.LocationID).groupBy("LocationID").count().collect()
    }
    assert {r.LocationID: r.num_pickups for r in ranked(f, z).collect()} == expected == {1: 4, 2: 1}


def test_reconciliation_sees_orphans(spark):
    def report(keys):
        return tuples(
            reconcile_counts(
                facts(spark, keys), zones(spark), fact_key="PULocationID", dim_key="LocationID"
            )
        )

    assert report([1, 2, 2]) == [(3, 3, True)]
    assert report([1, 2, 9, None]) == [(4, 2, False)]
    assert report([]) == [(0, 0, True)]


def test_hours_are_utc_in_any_session_zone(spark):
    times = [(datetime(2024, 1, 1, 0, 30),), (datetime(2024, 1, 1, 23, 59),), (None,)]
    naive = spark.createDataFrame(times, "t timestamp_ntz")
    zoned = naive.selectExpr("CAST(t AS timestamp) AS t")
    seconds = zoned.selectExpr("unix_seconds(t) AS s").collect()
    stored = spark.createDataFrame(seconds, "s long").selectExpr("timestamp_seconds(s) AS t")
    expected = [(None, 1), (0, 1), (23, 1)]
    assert tuples(count_by_hour(naive, "t")) == expected
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        assert tuples(count_by_hour(stored, "t")) == expected
        assert tuples(count_by_hour(naive, "t")) == expected
        before_epoch = spark.sql("SELECT timestamp_seconds(-1800L) AS t")
        assert tuples(count_by_hour(before_epoch, "t")) == [(23, 1)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
