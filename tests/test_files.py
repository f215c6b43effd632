import json

import pyarrow as pa
import pytest
from pyspark.sql import functions as F, types as T

from helpers import tuples
from weirflow.operators.compaction import compact_folders
from weirflow.schemas import COUNTRIES, OCCUPANCY_LAKE, TAXI_ZONES
from weirflow.sinks.files import save_by_partition, save_json_array, save_parquet
from weirflow.sources.catalog import (
    columnar_copy, create_database, create_view, external_parquet_table, external_text_table,
)
from weirflow.sources.files import (
    data_files, in_listing_order, list_files, read_csv, read_day, read_json_arrays,
    read_lines_numbered, staged_lines,
)

ZONES = 'LocationID,Borough,Zone,service_zone\n1,"EWR","Newark","EWR"\n2,"Queens","Bay, Far","bOrO"\n'


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_csv_header_quotes_and_case(spark, tmp_path):
    write(tmp_path / "zones.csv", ZONES)
    assert tuples(read_csv(spark, str(tmp_path), TAXI_ZONES)) == [
        (1, "EWR", "Newark", "EWR"), (2, "Queens", "Bay, Far", "bOrO"),
    ]


def test_csv_bad_number_is_null_or_fails(spark, tmp_path):
    write(tmp_path / "zones.csv", ZONES + 'x,"a","b","c"\n')
    assert read_csv(spark, str(tmp_path), TAXI_ZONES).filter("LocationID IS NULL").count() == 1
    with pytest.raises(Exception, match="FAILFAST"):
        read_csv(spark, str(tmp_path), TAXI_ZONES, strict=True).collect()


def test_text_table_view_and_orc_copy(spark, tmp_path):
    write(tmp_path / "raw" / "zones.csv", ZONES)
    name = f"zones_{abs(hash(str(tmp_path)))}"
    create_database(spark, name, str(tmp_path / "db"))
    external_text_table(spark, f"{name}.raw", str(tmp_path / "raw"), TAXI_ZONES)
    columnar_copy(spark, f"{name}.zones", f"{name}.raw", TAXI_ZONES)
    create_view(spark, f"{name}.queens", f"SELECT Zone FROM {name}.zones WHERE Borough = 'Queens'")
    assert tuples(spark.table(f"{name}.queens")) == [("Bay, Far",)]
    assert "orc" in spark.sql(f"SHOW CREATE TABLE {name}.zones").first()[0].lower()
    spark.range(3).write.parquet(str(tmp_path / "ids"))
    external_parquet_table(spark, f"{name}.ids", str(tmp_path / "ids"))
    spark.sql(f"DROP TABLE {name}.ids")
    assert spark.read.parquet(str(tmp_path / "ids")).count() == 3


def test_parquet_overwrite_single_file(spark, tmp_path):
    for n in (10, 4):
        save_parquet(spark.range(0, n, 1, 4), str(tmp_path / "out"), single_file=True)
    assert len(list((tmp_path / "out").glob("*.parquet"))) == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 4


def test_json_array_documents(spark, tmp_path):
    countries = [
        {"name": {"common": "A", "official": "Republic A"}, "region": "Africa", "area": 5.5,
         "capital": []},
        {"name": {"common": "B", "official": "Republic B"}, "region": "Asia", "area": 1,
         "capital": ["X", "Y"], "unknown": {"deep": 1}},
    ]
    write(tmp_path / "in" / "c.json", json.dumps(countries, indent=2))
    rows = read_json_arrays(spark, str(tmp_path / "in"), COUNTRIES)
    assert [(r.name.official, r.area, r.capital) for r in rows.collect()] == [
        ("Republic A", 5.5, []), ("Republic B", 1.0, ["X", "Y"]),
    ]
    save_json_array(rows, str(tmp_path / "many"), rows_per_document=1)
    assert len(list((tmp_path / "many").glob("part-*"))) == 2
    again = read_json_arrays(spark, str(tmp_path / "many"), COUNTRIES)
    assert again.exceptAll(rows).count() == 0 and again.count() == 2
    write(tmp_path / "bad" / "c.json", "[{")
    with pytest.raises(Exception, match="FAILFAST"):
        read_json_arrays(spark, str(tmp_path / "bad"), COUNTRIES).collect()


def test_day_scan_prunes_and_restores_partitions(spark, tmp_path):
    columns = "Temperature double, Humidity double, Light double, CO2 double, " \
        "HumidityRatio double, Occupancy int, hour int, minute int, second int, " \
        "year int, month int, day int"
    rows = [(1.0, 2.0, 3.0, 4.0, 5.0, 1, 7, 8, 9, 2015, 2, d) for d in (3, 4, 4)]
    lake = str(tmp_path / "lake")
    save_by_partition(spark.createDataFrame(rows, columns), lake, ["year", "month", "day"])
    day = read_day(spark, lake, OCCUPANCY_LAKE, "2015-02-04")
    assert tuples(day.select("hour", "year", "month", "day")) == [(7, 2015, 2, 4)] * 2
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    with pytest.raises(ValueError):
        read_day(spark, lake, OCCUPANCY_LAKE, "04.02.2015")


def test_inventory_keeps_hidden_and_empty_files(spark, tmp_path):
    write(tmp_path / "t" / "a" / "empty.txt", "")
    write(tmp_path / "t" / "b c+d" / "full %41é#?.txt", "123")
    write(tmp_path / "t" / ".git" / "_objects" / ".pack", "12345")
    write(tmp_path / "t" / "a" / ".empty.txt.crc", "checksum")
    write(tmp_path / "t" / "a" / ".own.crc", "12")
    (tmp_path / "t" / "none" / "below").mkdir(parents=True)
    (tmp_path / "t" / "loop").symlink_to(tmp_path / "t")
    for root in (str(tmp_path / "t"), f"file:{tmp_path}/t/"):
        listed = list_files(spark, root)
        assert sorted(tuples(listed.select("relative_path", "length"))) == [
            (".git/_objects/.pack", 5), ("a/.own.crc", 2), ("a/empty.txt", 0),
            ("b c+d/full %41é#?.txt", 3),
        ]
        assert listed.filter("modified IS NULL OR modified > now() + INTERVAL 1 DAY").count() == 0
        assert {r[0] for r in tuples(listed.select("path"))} == {
            f"{tmp_path}/t/{p}" for p in
            (".git/_objects/.pack", "a/.own.crc", "a/empty.txt", "b c+d/full %41é#?.txt")
        }
        assert tuples(data_files(listed).select("name").orderBy("name")) == [
            ("empty.txt",), ("full %41é#?.txt",),
        ]


def test_paths_of_lines_are_those_of_the_inventory(spark, tmp_path):
    for name in ("b c+d %41é#/part-0000.csv", "x=1/part-0001.csv"):
        write(tmp_path / "t" / name, "line\n")
    lines = staged_lines(spark, str(tmp_path / "t")).select("path")
    assert sorted(tuples(lines)) == sorted(tuples(list_files(spark, str(tmp_path / "t")).select("path")))


def test_inventory_goes_down_level_by_level(spark, tmp_path):
    for i in range(40):
        write(tmp_path / f"d{i % 5}" / f"e{i}" / "f" / f"{i}.txt", "x" * i)
    assert list_files(spark, str(tmp_path)).agg(F.sum("length")).first()[0] == sum(range(40))
    assert list_files(spark, str(tmp_path), depth=3).count() == 0
    assert list_files(spark, str(tmp_path), folders="^d[12]").count() == 16
    with pytest.raises(Exception, match="FileNotFoundError"):
        list_files(spark, str(tmp_path / "missing"))


def test_inventory_lists_a_folder_in_batches(spark, tmp_path):
    from weirflow.sources import inventory

    (tmp_path / "many").mkdir()
    for i in range(25):
        (tmp_path / "many" / f"{i}").touch()
    before, inventory.BATCH_ENTRIES = inventory.BATCH_ENTRIES, 10
    try:
        batch = pa.RecordBatch.from_pydict({"parent": ["", "many", "gone"]})
        found = list(inventory._list_folders(f"file:{tmp_path}")(iter([batch])))
    finally:
        inventory.BATCH_ENTRIES = before
    assert [b.num_rows for b in found] == [10, 10, 6]


def test_store_entries_through_arrow(tmp_path):
    from weirflow.sources.inventory import _store_entries

    write(tmp_path / "a" / "b.txt", "123")
    (tmp_path / "a" / "c").mkdir()
    assert sorted(e[:3] for e in _store_entries(f"file://{tmp_path}/a")) == [("b.txt", False, 3), ("c", True, 0)]


def test_inventory_order(spark, tmp_path):
    for name in ("b/z.txt", "b/a/x y.txt", "a.txt", "c.txt", "b/a.txt", "a/q.txt"):
        write(tmp_path / name, "12345")
    listed = in_listing_order(list_files(spark, str(tmp_path)))
    assert tuples(listed.select("relative_path", "folder", "name", "length")) == [
        ("a.txt", "", "a.txt", 5),
        ("c.txt", "", "c.txt", 5),
        ("a/q.txt", "a", "q.txt", 5),
        ("b/a.txt", "b", "a.txt", 5),
        ("b/z.txt", "b", "z.txt", 5),
        ("b/a/x y.txt", "b/a", "x y.txt", 5),
    ]


def test_lines_are_numbered_without_headers(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "head\nx\n\ny\n")
    write(tmp_path / "in" / "b.csv", "head\nhead\nz")
    got = read_lines_numbered(spark, str(tmp_path / "in"))
    assert sorted(tuples(got), key=lambda r: int(r[0])) == [
        ("1", "x"), ("2", ""), ("3", "y"), ("4", "head"), ("5", "z"),
    ]


@pytest.fixture
def stage(tmp_path):
    root = tmp_path / "stage"
    write(root / "date=2020-12-01" / "part-0000.csv.inprogress", "never\n")
    write(root / "date=2020-12-02" / "part-0000.csv.inprogress", "never\n")
    day = root / "date=2020-12-03"
    write(day / "part-0000.csv", 'a,"x, y"\nb')
    write(day / "part-0001.csv", "")
    write(day / "part-0002.csv", "c\n\nd\n")
    write(day / "part-0003.csv", "e")
    write(day / "part-10.csv", "never")
    write(root / "date=2020-12-04" / "part-0001.csv", "")
    write(root / "date=2020-12-05" / "part-0007.csv", "one")
    write(root / "stray" / "part-0000.csv", "never")
    write(root / "date=2020-12-06-old" / "part-0000.csv", "never")
    return root


def files_below(root):
    return sorted(
        str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and p.suffix != ".crc"
    )


def texts_below(root):
    """Per folder the text of its files in name order, and how many they are."""
    found = {}
    for name in files_below(root):
        if not name.startswith("_"):
            text, n = found.get(name.split("/")[0], ("", 0))
            found[name.split("/")[0]] = (text + (root / name).read_text(), n + 1)
    return found


def test_compaction(spark, stage, tmp_path):
    before, target = files_below(stage), tmp_path / "ods"
    assert compact_folders(spark, str(stage), str(target)) == 7
    assert texts_below(target) == {
        "date=2020-12-03": ('a,"x, y"\nb\nc\n\nd\ne\n', 1), "date=2020-12-05": ("one\n", 1),
    }
    assert (target / "date=2020-12-04").is_dir()
    assert files_below(stage) == before


def test_compaction_deletes_only_what_it_copied(spark, stage, tmp_path):
    compact_folders(spark, str(stage), str(tmp_path / "ods"), delete_sources=True)
    assert files_below(stage) == [
        "date=2020-12-01/part-0000.csv.inprogress",
        "date=2020-12-02/part-0000.csv.inprogress",
        "date=2020-12-03/part-10.csv",
        "date=2020-12-06-old/part-0000.csv",
        "stray/part-0000.csv",
    ]
    # A second run finds nothing and changes nothing.
    assert compact_folders(spark, str(stage), str(tmp_path / "ods"), delete_sources=True) == 0
    assert len(texts_below(tmp_path / "ods")) == 2


def test_a_smaller_second_run_leaves_nothing_of_the_first(spark, tmp_path):
    target = tmp_path / "ods"
    for n, days in ((1200, ("2021-01-01", "2021-01-02")), (100, ("2021-01-01",)), (0, ("2021-01-01",))):
        root = tmp_path / f"stage{n}"
        for day in days:
            write(root / f"date={day}" / "part-0000.csv", "".join(f"line {i}\n" for i in range(n)))
        compact_folders(spark, str(root), str(target), target_file_bytes=5_000)
        lines = {k: len(t.splitlines()) for k, (t, _) in texts_below(target).items()}
        assert lines.get("date=2021-01-01", 0) == n
        assert lines["date=2021-01-02"] == 1200


def test_compaction_leaves_no_intermediates(spark, stage, tmp_path):
    from pathlib import Path

    from weirflow.operators.ranking import number_rows
    from weirflow.workspace import intermediates, shared_root

    def left():
        return {str(p) for p in Path(shared_root(spark).removeprefix("file:")).glob("weirflow/*")}

    before = left()
    compact_folders(spark, str(stage), str(tmp_path / "ods"))
    assert left() == before
    with intermediates(spark):
        assert number_rows(spark.range(5), [F.desc("id")]).count() == 5
        assert left() != before
    assert left() == before


@pytest.fixture
def tiny_splits(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300b")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_large_folder_becomes_several_files_in_line_order(spark, tmp_path, tiny_splits):
    root, expected = tmp_path / "stage", []
    for part in range(6):
        lines = [f"{part}-{i}" for i in range(200)]
        expected += lines
        write(root / "date=2021-01-01" / f"part-{part:04d}.csv", "\n".join(lines))
    write(root / "date=2021-01-02" / "part-0000.csv", "small")
    size = sum(p.stat().st_size for p in (root / "date=2021-01-01").iterdir())
    compact_folders(spark, str(root), str(tmp_path / "ods"), target_file_bytes=900)
    found = texts_below(tmp_path / "ods")
    assert found["date=2021-01-01"][1] == -(-size // 900) and found["date=2021-01-02"][1] == 1
    assert found["date=2021-01-01"][0].splitlines() == expected
    # A file may run over by one split.
    sizes = [p.stat().st_size for p in (tmp_path / "ods").glob("date=*/*.txt")]
    assert max(sizes) <= 900 + 300 + 10


def test_numbered_lines_over_many_splits(spark, tmp_path, tiny_splits):
    lines = [f"line {i}" for i in range(300)]
    write(tmp_path / "feed.csv", "\n".join(["header", *lines]))
    got = read_lines_numbered(spark, str(tmp_path / "feed.csv"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
    assert sorted(tuples(got), key=lambda r: int(r[0])) == [
        (str(i + 1), line) for i, line in enumerate(lines)
    ]


def test_compaction_refuses_to_write_in_place(spark, stage):
    with pytest.raises(ValueError):
        compact_folders(spark, str(stage), f"file:{stage}/")


def test_compaction_joins_any_bytes(spark, tmp_path):
    root, parts = tmp_path / "stage", [bytes([n, 0, 10, 255]) * 500 for n in range(5)]
    for n, part in enumerate(parts):
        (root / "date=2021-01-01").mkdir(parents=True, exist_ok=True)
        (root / "date=2021-01-01" / f"part-{n:04d}.csv").write_bytes(part)
    compact_folders(spark, str(root), str(tmp_path / "ods"), target_file_bytes=3_000, lines=False)
    made = sorted((tmp_path / "ods" / "date=2021-01-01").iterdir())
    assert b"".join(p.read_bytes() for p in made) == b"".join(parts)
    assert [p.stat().st_size for p in made] == [2_500] * 4
    assert [p.name for p in (tmp_path / "ods").iterdir()] == ["date=2021-01-01"]


def test_compaction_cuts_at_lines_of_any_length(spark, tmp_path):
    root = tmp_path / "stage"
    text = "".join("x" * n + "\n" for n in (0, 5000, 1, 0, 40, 3000, 7)) + "é" * 900
    write(root / "date=2021-01-01" / "part-0000.csv", text)
    write(root / "date=2021-01-01" / "part-0001.csv", "last")
    assert compact_folders(spark, str(root), str(tmp_path / "ods"), target_file_bytes=100) == 9
    made = sorted((tmp_path / "ods" / "date=2021-01-01").iterdir())
    texts = [p.read_text() for p in made]
    assert "".join(texts) == f"{text}\nlast\n"
    assert all(t.endswith("\n") for t in texts)


def test_compaction_plans_from_lengths(spark, stage):
    from weirflow.operators.compaction import plan_copies, plan_pieces
    from weirflow.sources.files import staged_files

    files = staged_files(spark, str(stage))
    ranges = plan_copies(files, plan_pieces(files, 4)).orderBy("output", "start")
    got = [r for r in tuples(ranges.select("folder", "piece", "begin", "end", "start")) if "12-03" in r[0]]
    # 10, 5 and 1 bytes in pieces of 4.
    assert [(p, s + b, s + e) for _, p, b, e, s in got] == [
        (0, 0, 4), (1, 4, 8), (2, 8, 10), (2, 10, 12), (3, 12, 15), (3, 15, 16),
    ]


def test_compaction_keeps_the_target_when_a_part_changes(spark, stage, tmp_path, monkeypatch):
    from weirflow.operators import compaction

    target = tmp_path / "ods"
    compact_folders(spark, str(stage), str(target))
    before, plan = texts_below(target), compaction.plan_copies

    def shrink(files, pieces):
        write(stage / "date=2020-12-03" / "part-0000.csv", "a")
        return plan(files, pieces)

    monkeypatch.setattr(compaction, "plan_copies", shrink)
    with pytest.raises(Exception):
        compact_folders(spark, str(stage), str(target), delete_sources=True)
    assert texts_below(target) == before and (stage / "date=2020-12-05" / "part-0007.csv").exists()


def test_a_day_is_read_without_its_neighbours(spark, tmp_path):
    schema = T.StructType([T.StructField("a", T.IntegerType())])
    lake = tmp_path / "lake"
    write(lake / "year=2021" / "month=3" / "day=5" / "batch-0" / "x.json", '{"a": 1}\n')
    write(lake / "year=2021" / "month=03" / "day=05" / "y.json", '{"a": 2}\n')
    write(lake / "year=2021" / "month=3" / "day=6" / "z.json", '{"a": 3}\n')
    write(lake / "year=2021" / "month=3" / "day=5" / "x.json", '{"a": 4}\n')
    got = read_day(spark, str(lake), schema, "2021-03-05")
    assert sorted(tuples(got)) == [(1, 2021, 3, 5), (2, 2021, 3, 5), (4, 2021, 3, 5)]
    assert all("day=6" not in f for f in got.inputFiles())
    none = read_day(spark, str(lake), schema, "2021-03-07")
    assert none.columns == got.columns and none.count() == 0
