import json
from datetime import datetime

from weirflow.jobs.batch import (
    country_report, distance_datamart, popular_hours, popular_zones, publish_books, publish_lines,
)
from weirflow.operators.datamart import create_datamart
from weirflow.schemas import TAXI_FACTS
from weirflow.sources.jdbc import read_table
from weirflow.sources.messages import MessageFolder, read_messages


def taxi_facts(spark, path):
    rides = [(237, 1.0, 8), (237, 2.0, 8), (251, 6.0, 23), (237, 3.0, 0)]
    rows = [
        (1, datetime(2018, 1, 25, h), datetime(2018, 1, 25, h), 1, d, 1, "N", zone, 1, 1,
         *[1.0] * 7)
        for zone, d, h in rides
    ]
    spark.createDataFrame(rows, TAXI_FACTS).write.parquet(path)
    return path


def test_popular_zones_job(spark, tmp_path):
    facts, out = taxi_facts(spark, str(tmp_path / "facts")), tmp_path / "out"
    (tmp_path / "zones.csv").write_text(
        'LocationID,Borough,Zone,service_zone\n251,"North Isle","Old Mill","GREEN"\n'
        '237,"South Shore","Harbour Gate","BLUE"\n'
    )
    for _ in range(2):
        counts = popular_zones(spark, facts, str(tmp_path / "zones.csv"), str(out))
        assert counts == {"raw": 4, "joined": 4}
    assert [tuple(r) for r in spark.read.parquet(str(out)).orderBy("LocationID").collect()] == [
        (237, 3, "South Shore", "Harbour Gate", "BLUE"),
        (251, 1, "North Isle", "Old Mill", "GREEN"),
    ]


def test_popular_hours_job(spark, tmp_path):
    facts = taxi_facts(spark, str(tmp_path / "facts"))
    popular_hours(spark, facts, str(tmp_path / "out"))
    got = [tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert got == [(0, 1), (8, 2), (23, 1)]


def test_distance_datamart_job(spark, derby, tmp_path):
    facts = taxi_facts(spark, str(tmp_path / "facts"))
    create_datamart(spark, derby)
    assert [distance_datamart(spark, facts, derby) for _ in range(2)] == [0, 1]
    stored = read_table(spark, derby, "rides_datamart")
    last = {r.METRIC: round(r.VALUE, 3) for r in stored.filter("ID = 1").collect()}
    assert last == {
        "total_rides": 4.0, "dist_min": 1.0, "dist_max": 6.0, "dist_average": 3.0,
        "dist_std_dev": 2.16,
    }


def test_country_report_job(spark, tmp_path):
    countries = [
        {"name": {"common": f"C{i:02d}", "official": f"State of C{i:02d}"},
         "region": "Africa" if i % 2 else "Europe", "area": float(i // 4), "capital":
         [] if i == 29 else [f"Town {i}", "Second"]}
        for i in range(30)
    ]
    (tmp_path / "countries.json").write_text(json.dumps(countries))
    country_report(spark, str(tmp_path / "countries.json"), str(tmp_path / "out"))
    (document,) = (tmp_path / "out").glob("part-*")
    report = json.loads(document.read_text())
    expected = sorted(
        (c for c in countries if c["region"] == "Africa"),
        key=lambda c: (-c["area"], c["name"]["official"]),
    )[:10]
    assert report == [
        {"name": c["name"]["official"], "capital": (c["capital"] or ["<Undefined>"])[0],
         "area": c["area"]}
        for c in expected
    ]


def test_publish_books_job(spark, tmp_path):
    (tmp_path / "books.csv").write_text(
        "Name,Author,User Rating,Reviews,Price,Year,Genre\n"
        '"One, Two",A. Author,3.5,210,12,2031,Essay\n'
    )
    topic = MessageFolder(str(tmp_path / "books"))
    publish_books(spark, str(tmp_path / "books.csv"), topic)
    row = read_messages(spark, topic).first()
    assert row.key.decode() == "One, Two"
    assert json.loads(row.value) == {
        "Name": "One, Two", "Author": "A. Author", "UserRating": 3.5, "Reviews": 210,
        "Price": 12.0, "Year": 2031, "Genre": "Essay",
    }


def test_publish_lines_job(spark, tmp_path):
    (tmp_path / "feed.csv").write_text("header\na,1\nb,2\n")
    topic = MessageFolder(str(tmp_path / "feed"))
    publish_lines(spark, str(tmp_path / "feed.csv"), topic)
    got = {r.key.decode(): r.value.decode() for r in read_messages(spark, topic).collect()}
    assert got == {"1": "a,1", "2": "b,2"}
