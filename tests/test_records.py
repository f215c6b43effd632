"""JSON arrays and quoted text cut by several tasks, against plain parsers."""

import csv
import io
import json

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F, types as T

from weirflow.schemas import struct_of
from weirflow.sinks.files import save_json_document
from weirflow.sources.records import (
    CHUNK_BYTES, JSON_ARRAY, _Quoting, _chunks, _effects, _seams, json_cut, json_effect,
    read_csv_quoted_lines, read_json_array_split, scan_chunks,
)

SIZES = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
ODD = ['],[{', '"', '\\', '\\\\"', "é\U0001f600", "\n,\t", "", "{}", "]", ',"', "x" * 300]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SIZES}
    for k, v in zip(SIZES, ("500b", "1b")):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def elements(n):
    return [{"a": i, "b": ODD[i % len(ODD)], "c": [i, [ODD[i % 3]], {"d": ODD[(i + 1) % len(ODD)]}]}
            for i in range(n)]


SCHEMA = T.StructType([*struct_of(a="long", b="string"), T.StructField("c", T.ArrayType(T.StringType()))])


@pytest.mark.parametrize("indent", [None, 1])
def test_json_array_of_many_splits(spark, tmp_path, small_splits, indent):
    rows = elements(40)
    (tmp_path / "one.json").write_text(" " + json.dumps(rows, indent=indent, ensure_ascii=False) + "\n")
    (tmp_path / "two.json").write_text(json.dumps([{"a": 99}]))
    (tmp_path / "three.json").write_text("[ \n]")
    got = read_json_array_split(spark, str(tmp_path), SCHEMA)
    assert scan_chunks(spark, str(tmp_path), ",", False).rdd.getNumPartitions() > 5
    assert sorted((r.a, r.b) for r in got.collect()) == sorted(
        [(r["a"], r["b"]) for r in rows] + [(99, None)], key=lambda r: r[0]
    )
    nested = {r.a: r.c for r in got.collect()}
    assert all(json.loads(nested[r["a"]][2]) == r["c"][2] for r in rows)


@pytest.mark.parametrize("text", ['[{"a":1},{"a":2}', '[{"a":1}]]', '{"a":1}', '[{"a":1}] x', '[{"a": "}]', '[{"a": {]'])
def test_broken_json_fails(spark, tmp_path, text):
    (tmp_path / "bad.json").write_text(text)
    with pytest.raises(Exception, match="FAILFAST|MALFORMED"):
        read_json_array_split(spark, str(tmp_path), SCHEMA).collect()


def test_permissive_json_gives_nulls(spark, tmp_path):
    (tmp_path / "bad.json").write_text('[{"a": 1}, {"a": nothing}, {"a": 3}]')
    got = read_json_array_split(spark, str(tmp_path), SCHEMA, mode="PERMISSIVE")
    assert sorted(str(r.a) for r in got.collect()) == ["1", "3", "None"]


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text('a",\\[]{}\n', max_size=6),
                    lambda x: st.lists(x, max_size=4) | st.dictionaries(st.text('k"[,', max_size=3), x, max_size=3)),
       st.integers(1, 5))
def test_json_cut_in_chunks(value, per_chunk):
    """Chunks of a few pieces between commas, each cut from its start state alone."""
    values = value if isinstance(value, list) else [value]
    pieces = json.dumps(values).split(",")
    chunks = [",".join(pieces[i:i + per_chunk]) + "," for i in range(0, len(pieces), per_chunk)]
    quoted = depth = 0
    texts, current = [], b""
    for chunk in map(str.encode, chunks):
        head, *rest = json_cut(chunk, quoted, depth)
        current += head
        for piece in rest:
            texts.append(current)
            current = piece
        fixed, flips, outside, inside = json_effect(chunk)
        depth += inside if quoted else outside
        quoted = (quoted + flips) % 2
    assert (quoted, depth) == (0, 0) and JSON_ARRAY.separator == ","
    assert [json.loads(t) for t in [*texts, current] if t.strip()] == values


def quoted_text(rows, **options):
    out = io.StringIO()
    csv.writer(out, lineterminator="\n", **options).writerows(rows)
    return out.getvalue()


FIELDS = ["plain", "two\nlines", 'a "quote"', ",", "\n", '"', "é,\n\U0001f600", 'end"\n', "\r\n within", "x" * 400, "5\" pipe"]


@pytest.mark.parametrize("quoting", [csv.QUOTE_MINIMAL, csv.QUOTE_ALL])
def test_quoted_lines_over_many_splits(spark, tmp_path, small_splits, quoting):
    rows = [(i, FIELDS[i % len(FIELDS)], FIELDS[i * 7 % len(FIELDS)] + "!") for i in range(60)]
    for n, part in enumerate((rows[:50], rows[50:])):
        (tmp_path / f"{n}.csv").write_text(quoted_text([("a", "b\nb", "c"), *part], quoting=quoting), newline="")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "head.csv").write_text('a,"b\nb",c')
    schema = struct_of(a="long", b="string", c="string")
    got = read_csv_quoted_lines(spark, str(tmp_path), schema, strict=True)
    assert scan_chunks(spark, str(tmp_path), "\n", False).rdd.getNumPartitions() > 5
    assert rows_of(got) == sorted(rows, key=str)


def test_stray_quotes_are_text(spark, tmp_path, small_splits):
    lines = [f'{i},5" pipe {"x" * (i * 5)}' if i % 3 else f'{i},"6"" and\n{i}"' for i in range(60)]
    (tmp_path / "a.csv").write_text("\n".join(lines) + "\r\n\n")
    got = read_csv_quoted_lines(spark, str(tmp_path), struct_of(a="long", b="string"), header=False, strict=True)
    want = [(i, f'5" pipe {"x" * (i * 5)}' if i % 3 else f'6" and\n{i}') for i in range(60)]
    assert rows_of(got) == sorted(want, key=str)


def test_backslash_escape_and_other_separator(spark, tmp_path, small_splits):
    rows = [(i, f'say \\"{i}\\"\nand;' + "y" * i) for i in range(40)]
    (tmp_path / "a.csv").write_text("".join(f'{i};"{t}"\n' for i, t in rows))
    got = read_csv_quoted_lines(
        spark, str(tmp_path), struct_of(a="long", b="string"), header=False, separator=";", escape="\\", strict=True
    )
    assert rows_of(got) == sorted([(i, t.replace('\\"', '"')) for i, t in rows], key=str)
    with pytest.raises(ValueError):
        read_csv_quoted_lines(spark, str(tmp_path), struct_of(a="long"), escape="'")


def test_bad_values_and_open_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,x\nno,y\n3,"open\nto the end\n')
    schema = struct_of(a="long", b="string")
    got = read_csv_quoted_lines(spark, str(tmp_path), schema)
    assert [r.a for r in got.orderBy(F.asc_nulls_last("a")).collect()] == [1, 3, None]
    with pytest.raises(Exception, match="FAILFAST"):
        read_csv_quoted_lines(spark, str(tmp_path), schema, strict=True).collect()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.text('a",\n', max_size=6), st.text('b",\n ', max_size=6)), min_size=1, max_size=8),
       st.integers(1, 4), st.booleans())
def test_quoted_cut_in_chunks(rows, per_chunk, everything):
    text = quoted_text(rows, quoting=csv.QUOTE_ALL if everything else csv.QUOTE_MINIMAL)
    quoting = _Quoting(",", '"')
    lines = text.removesuffix("\n").split("\n")
    quoted, records, current = 0, [], b""
    for i in range(0, len(lines), per_chunk):
        chunk = ("\n".join(lines[i:i + per_chunk]) + "\n").encode()
        head, *rest = quoting.cut(chunk, quoted, 0)
        current += head
        for piece in rest:
            records.append(current.decode())
            current = piece
        fixed, flips, _, _ = quoting.effect(chunk)
        quoted = ((quoted if fixed is None else fixed) + flips) % 2
    assert (quoted, current) == (0, b"")
    assert [tuple(r) for t in records for r in csv.reader(io.StringIO(t, newline=""))] == rows


@pytest.fixture
def small_partitions(spark):
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_document_in_parts(spark, tmp_path, small_partitions):
    rows = spark.range(0, 5000, 1, 7).select(
        F.col("id"), F.when(F.col("id") % 3 > 0, F.concat(F.lit('],"'), "id")).alias("text")
    )
    path = tmp_path / "doc"
    for _ in range(2):
        save_json_document(rows, str(path), order=[F.desc("id")])
    parts = sorted(path.glob("part-*"))
    whole = json.loads("".join(p.read_text() for p in parts))
    assert len(parts) > 1 and [r["id"] for r in whole] == list(range(4999, -1, -1))
    assert whole[0]["text"] == '],"4999' and whole[1] == {"id": 4998, "text": None}
    back = read_json_array_split(spark, str(path), rows.schema, parts=True)
    assert back.exceptAll(rows).count() == 0 and back.count() == 5000
    save_json_document(rows.limit(0), str(path))
    assert json.loads("".join(p.read_text() for p in sorted(path.glob("part-*")))) == []
    assert read_json_array_split(spark, str(path), rows.schema, parts=True).count() == 0


def test_a_task_holds_one_chunk_of_a_split(spark, tmp_path):
    """Chunks are bounded, and a split of many gives its effect as one row."""
    piece = '{"a": "],[' + "x" * 1_000_000 + '"}'
    pieces = ["[" + piece, *[piece] * 10, piece + "]"]
    values = ",".join(pieces).split(",")
    taken = []

    def batches():
        for i in range(0, len(values), 15):
            taken.append(i)
            some = values[i:i + 15]
            yield pa.RecordBatch.from_pydict({
                "path": [""] * len(some), "block": ["b"] * len(some), "quoted": pa.array([0] * len(some), pa.int32()),
                "depth": [0] * len(some), "value": some,
            })

    texts = [text for _, text in _chunks(batches(), ",")]
    assert b"".join(texts).decode() == ",".join(values) + ","
    assert len(texts) > 3 and max(map(len, texts)) <= CHUNK_BYTES + 1_000_100
    (row,) = [r for b in _effects(JSON_ARRAY)(batches()) for r in b.to_pylist()]
    fixed, flips, outside, inside = json_effect(b"".join(texts))
    assert row == {"path": "", "block": "b", "fixed": fixed, "flips": flips, "outside": outside, "inside": inside}
    taken.clear()
    first = next(iter(_seams(JSON_ARRAY)(batches())))
    assert taken == [0] and first.num_rows == 2

    (tmp_path / "one.json").write_text(",".join(pieces))
    got = read_json_array_split(spark, str(tmp_path), struct_of(a="string"))
    assert [len(r.a) for r in got.collect()] == [1_000_003] * 12
