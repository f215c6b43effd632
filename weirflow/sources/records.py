"""Large text documents cut into records by many tasks: JSON arrays at their
top-level commas, delimited text at line ends outside quotes.

Where a record ends depends on all that stands before: whether a quote is open
and, in JSON, how deep brackets are nested. Every task reads chunks of its split
and reduces each to its effect on that state, without knowing the state it starts
from. The effects of a split's chunks make up that of the split; a prefix scan over
these, one small row per split, gives the state at each start, and a second reading
cuts the chunks, each from the state the one before left. So a task holds one chunk
at a time, of bounded size, however large its split. What a chunk has before its
first and after its last bound joins with that of its neighbours; only these seams
are shuffled.

Splits are Spark's own, so the text may lie in any store. It is read three times:
for the effects, the seams and the whole records. The scans must find the same
splits, so files must not change meanwhile.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from weirflow.session import ship_package
from weirflow.workspace import materialize

EFFECT = "path string, block string, fixed int, flips int, outside long, inside long"
PIECE = "path string, block string, seq long, kind int, text string"
RECORD = "path string, text string"
#: Bytes of a chunk, if none of its pieces is longer.
CHUNK_BYTES = 4 << 20
HEAD, WHOLE, TAIL = 0, 1, 2

#: (fixed, flips, outside, inside): the state of the quote after the chunk, if it
#: is the same from any start, else whether it turns; what the depth changes by if
#: the chunk starts outside or inside of quotes.
Effect = tuple[int | None, int, int, int]


@dataclass(frozen=True)
class Grammar:
    """`separator` stands between the pieces that Spark reads; no quote's escape
    and no bound reaches across it. `effect` is that of a chunk, `cut` gives the
    bounds in a chunk (each the end of one record and the start of the next) and the
    chunk's text with what is not part of a record left out."""

    separator: str
    effect: Callable[[bytes], Effect]
    cut: Callable[[bytes, int, int], list[bytes]]


def _after(effect: Effect, quoted: int) -> int:
    fixed, flips, _, _ = effect
    return ((quoted if fixed is None else fixed) + flips) % 2


def _change(effect: Effect, quoted: int) -> int:
    return effect[3] if quoted else effect[2]


def _then(first: Effect, second: Effect) -> Effect:
    """The effect of two texts in a row."""
    between = [_after(first, q) for q in (0, 1)]
    ends = [_after(second, q) for q in between]
    outside, inside = (_change(first, q) + _change(second, between[q]) for q in (0, 1))
    if ends[0] == ends[1]:
        return ends[0], 0, outside, inside
    return None, ends[0], outside, inside


def _chunks(batches, separator: str) -> Iterator[tuple[dict, bytes]]:
    """(the columns beside the text, text) of each chunk: a run of pieces of one
    split, joined; a separator follows each piece."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column("value").cast(pa.binary())
        lengths = np.asarray(pc.binary_length(values)).astype(np.int64) + len(separator)
        new = np.diff(np.cumsum(lengths) // CHUNK_BYTES) > 0
        for name in ("path", "block"):
            place = batch.column(name)
            new |= np.asarray(pc.not_equal(place[1:], place[:-1]).to_numpy(zero_copy_only=False))
        starts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        others = batch.drop_columns(["value"])
        for s, e in zip(starts, starts[1:]):
            pieces = pa.ListArray.from_arrays([0, e - s], values.slice(s, e - s))
            text = pc.binary_join(pieces, separator.encode())[0].as_py() + separator.encode()
            yield others.slice(s, 1).to_pylist()[0], text


def scan_chunks(spark: SparkSession, path, separator: str, parts: bool) -> DataFrame:
    """(path, block, value): the pieces of every split in their order. `path` is
    the document, `block` orders its splits; with `parts` all files together are one
    document, in the order of their names."""
    ship_package(spark)
    file, start = F.col("_metadata.file_path"), F.col("_metadata.file_block_start")
    start = F.lpad(start.cast("string"), 20, "0")
    return spark.read.option("lineSep", separator).text(path).select(
        (F.lit("") if parts else file).alias("path"),
        (F.concat(file, F.lit("/"), start) if parts else start).alias("block"), "value",
    )


def _effects(grammar: Grammar):
    """One row per split: what its chunks do together."""

    def row(place: tuple[str, str], effect: Effect):
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64())
        columns = [pa.array([v], k) for v, k in zip((*place, *effect), kinds)]
        return pa.RecordBatch.from_arrays(
            columns, names=["path", "block", "fixed", "flips", "outside", "inside"]
        )

    def run(batches):
        last = total = None
        for at, text in _chunks(batches, grammar.separator):
            place, effect = (at["path"], at["block"]), grammar.effect(text)
            if place == last:
                total = _then(total, effect)
                continue
            if last:
                yield row(last, total)
            last, total = place, effect
        if last:
            yield row(last, total)

    return run


def _composed(df: DataFrame, group: list[str], order: str) -> DataFrame:
    """Add the effect on the quote of all rows before in the group (`fixed_before`,
    `flips_before`) and with the row itself (`fixed_to`, `flips_to`)."""
    whole = Window.partitionBy(*group).orderBy(order)
    rows = whole.rowsBetween(Window.unboundedPreceding, 0)
    turned = F.sum("flips").over(rows)
    at_fixed = F.when(F.col("fixed").isNotNull(), F.col("turned"))
    up_to = df.withColumn("turned", turned).withColumns({
        "fixed_to": F.last("fixed", ignorenulls=True).over(rows),
        "flips_to": F.col("turned") - F.coalesce(F.last(at_fixed, ignorenulls=True).over(rows), F.lit(0)),
    })
    return up_to.withColumns({
        "fixed_before": F.lag("fixed_to").over(whole),
        "flips_before": F.coalesce(F.lag("flips_to").over(whole), F.lit(0)),
    }).drop("turned")


def _summed(df: DataFrame, value: str, name: str) -> DataFrame:
    """Add the sum of `value` over all rows before, by (path, block, seq): within
    the split and over the splits before it."""
    earlier = (Window.unboundedPreceding, -1)
    in_block = Window.partitionBy("path", "block").orderBy("seq").rowsBetween(*earlier)
    in_path = Window.partitionBy("path").orderBy("block").rowsBetween(*earlier)
    blocks = df.groupBy("path", "block").agg(F.sum(value).alias("_sum")).select(
        "path", "block", F.coalesce(F.sum("_sum").over(in_path), F.lit(0)).alias("_before")
    )
    within = F.coalesce(F.sum(value).over(in_block), F.lit(0))
    return df.withColumn("_within", within).join(blocks, ["path", "block"]).withColumn(
        name, F.col("_before") + F.col("_within")
    ).drop("_before", "_within")


def start_states(effects: DataFrame) -> DataFrame:
    """(path, block, quoted, depth) at the start of every split, and the change of
    both through it (`quoted_after`, `change`). One row per split of a document
    passes through one task."""
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)

    def after(fixed, flips, start):
        return F.pmod(F.coalesce(fixed, start) + flips, F.lit(2))

    return _composed(effects, ["path"], "block").withColumn(
        "quoted", after(F.col("fixed_before"), F.col("flips_before"), F.lit(0))
    ).withColumns({
        "quoted_after": after(F.col("fixed"), F.col("flips"), F.col("quoted")),
        "change": F.when(F.col("quoted") == 1, F.col("inside")).otherwise(F.col("outside")),
    }).select(
        "path", "block", F.col("quoted").cast("int").alias("quoted"),
        F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"), "change", "quoted_after",
    )


def _placed(batches, grammar: Grammar) -> Iterator[tuple[str, str, int, list[bytes]]]:
    """(path, block, seq, pieces) of each chunk, from the state at its split's start."""
    last = None
    for at, text in _chunks(batches, grammar.separator):
        if (at["path"], at["block"]) != last:
            last, seq, quoted, depth = (at["path"], at["block"]), 0, at["quoted"], at["depth"]
        yield *last, seq, grammar.cut(text, quoted, depth)
        effect = grammar.effect(text)
        seq, depth, quoted = seq + 1, depth + _change(effect, quoted), _after(effect, quoted)


def _whole(grammar: Grammar):
    """The records within a chunk."""

    def run(batches):
        for path, _, _, pieces in _placed(batches, grammar):
            texts = pa.array(pieces[1:-1], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(path, pa.string()), len(texts)), texts], names=["path", "text"]
            )

    return run


def _seams(grammar: Grammar):
    """The pieces at the ends of chunks, one of kind WHOLE where a chunk has no bound
    at all."""

    def run(batches):
        for path, block, seq, pieces in _placed(batches, grammar):
            ends = [(WHOLE, pieces[0])] if len(pieces) == 1 else [(HEAD, pieces[0]), (TAIL, pieces[-1])]
            yield pa.RecordBatch.from_pydict({
                "path": pa.array([path] * len(ends), pa.string()),
                "block": pa.array([block] * len(ends), pa.string()),
                "seq": pa.array([seq] * len(ends), pa.int64()),
                "kind": pa.array([k for k, _ in ends], pa.int32()),
                "text": pa.array([t.decode() for _, t in ends], pa.string()),
            })

    return run


def cut_records(
    spark: SparkSession, path, grammar: Grammar, *, complete: bool, parts: bool = False
) -> DataFrame:
    """(path, number, text): the records. `number` is that of the seam a record
    lies in, 0 for the first of a document, and null for records within a chunk.

    `complete` fails if a document ends within quotes or brackets.
    """
    pieces = scan_chunks(spark, path, grammar.separator, parts)
    effects = materialize(pieces.mapInArrow(_effects(grammar), EFFECT), "effects")
    states = materialize(start_states(effects), "states")
    if complete:
        at_end = F.max_by(F.struct("quoted_after", (F.col("depth") + F.col("change")).alias("deep")),
                          "block")
        ends = states.groupBy("path").agg(at_end.alias("end"))
        broken = ends.filter("end.quoted_after <> 0 OR end.deep <> 0").first()
        if broken:
            raise ValueError(f"{broken['path'] or path} ends within quotes or brackets [FAILFAST]")
    # A broadcast, whatever the number of splits: it leaves the pieces in their order.
    starts = F.broadcast(states.select("path", "block", "quoted", "depth"))
    placed = pieces.join(starts, ["path", "block"]).select("path", "block", "quoted", "depth", "value")
    whole = placed.mapInArrow(_whole(grammar), RECORD)
    seams = materialize(placed.mapInArrow(_seams(grammar), PIECE), "seams")
    tails = seams.groupBy("path", "block", "seq").agg(F.count_if(F.col("kind") == TAIL).alias("tails"))
    numbers = _summed(tails, "tails", "before").select("path", "block", "seq", "before")
    number = F.col("before") + F.when(F.col("kind") == TAIL, 1).otherwise(0)
    ordered = F.array_sort(F.collect_list(F.struct("block", "seq", "kind", "text")))
    joined = (
        seams.join(numbers, ["path", "block", "seq"])
        .groupBy("path", number.alias("number"))
        .agg(F.array_join(F.transform(ordered, lambda p: p["text"]), "").alias("text"))
    )
    return whole.select("path", F.lit(None).cast("long").alias("number"), "text").unionByName(joined)


# JSON ------------------------------------------------------------------------

_QUOTE, _BACKSLASH, _COMMA = ord('"'), ord("\\"), ord(",")
_STEPS = np.zeros(256, np.int8)
_STEPS[[ord("["), ord("{")]] = 1
_STEPS[[ord("]"), ord("}")]] = -1


def _open_quotes(data: np.ndarray) -> np.ndarray:
    """Which bytes are quotes that no backslash escapes: those after an even run."""
    quotes = data == _QUOTE
    slashes = np.flatnonzero(data == _BACKSLASH)
    if len(slashes):
        first = np.flatnonzero(np.diff(slashes, prepend=-2) != 1)
        lengths = np.diff(np.append(first, len(slashes)))
        escaped = (slashes[first] + lengths)[lengths % 2 == 1]
        quotes[escaped[escaped < len(data)]] = False
    return quotes


def json_effect(text: bytes) -> Effect:
    data = np.frombuffer(text, np.uint8)
    turns = np.cumsum(_open_quotes(data), dtype=np.uint8)  # wraps, still odd or even
    steps, odd = _STEPS[data], turns % 2 == 1
    return None, int(turns[-1] % 2), int(steps[~odd].sum()), int(steps[odd].sum())


def json_cut(text: bytes, quoted: int, depth: int) -> list[bytes]:
    """Bounds are the array's own brackets and the commas between its elements. What
    stands outside the array must be blank."""
    data = np.frombuffer(text, np.uint8)
    outside = np.cumsum(_open_quotes(data), dtype=np.uint8) % 2 == quoted
    steps = np.where(outside, _STEPS[data], 0)
    depths = depth + np.cumsum(steps)
    opening, closing = (steps == 1) & (depths == 1), (steps == -1) & (depths == 0)
    if (data[opening] != ord("[")).any():
        raise ValueError("a JSON array is expected [FAILFAST]")
    commas = outside & (data == _COMMA) & (depths == 1)
    bounds = np.flatnonzero(opening | closing | commas)
    starts, ends = [0, *(bounds + 1).tolist()], [*bounds.tolist(), len(data)]
    pieces = [text[s:e] for s, e in zip(starts, ends)]
    for i, at_depth in enumerate([depth, *depths[bounds].tolist()]):
        if at_depth == 0 and not (i == 0 and quoted):
            if pieces[i].strip(b" \t\r\n,\xef\xbb\xbf"):
                raise ValueError("text outside of the JSON array [FAILFAST]")
            pieces[i] = b""
    return pieces


JSON_ARRAY = Grammar(",", json_effect, json_cut)


def read_json_array_split(
    spark: SparkSession, path, schema: T.StructType, *, mode: str = "FAILFAST", parts: bool = False
) -> DataFrame:
    """Files that each hold one JSON array, of any size: the elements are cut and
    parsed by as many tasks as the files have splits. Commas, brackets and quotes
    in strings are part of them. With `parts` the files together, in the order of
    their names, are one array that is broken between elements; see
    `save_json_document`.

    An element that doesn't parse fails the job, or gives nulls with
    mode="PERMISSIVE". An empty array gives no rows, and so does a blank between two
    commas. A stretch without a comma must fit into memory; so must an element.
    """
    texts = cut_records(
        spark, path, JSON_ARRAY, complete=mode == "FAILFAST", parts=parts
    ).select("text")
    parsed = F.from_json("text", schema, {"mode": mode}).alias("row")
    return texts.filter(F.trim(F.translate("text", "\t\r\n", "   ")) != "").select(parsed).select("row.*")


# Delimited text --------------------------------------------------------------


@dataclass(frozen=True)
class _Quoting:
    """Quoted fields of delimited text; a quote opens a field only at its start."""

    separator: str
    escape: str

    def spans(self, text: bytes, quoted: int) -> Iterator[tuple[int, int | None]]:
        """(start, end) of the quoted stretches; the last has no end if the text ends
        within."""
        mark = re.escape(self.separator.encode())
        opening = re.compile(rb'(?:\A|(?<=\n)|(?<=' + mark + rb'))"')
        inner = rb'(?:[^"]|"")*+"' if self.escape == '"' else rb'(?:[^"\\]|\\.)*+"'
        closing, at = re.compile(inner, re.DOTALL), 0
        if not quoted:
            found = opening.search(text)
            if not found:
                return
            start, at = found.span()
        else:
            start = 0
        while True:
            end = closing.match(text, at)
            if not end:
                yield start, None
                return
            yield start, end.end()
            found = opening.search(text, end.end())
            if not found:
                return
            start, at = found.span()

    def effect(self, text: bytes) -> Effect:
        after = [int(any(end is None for _, end in self.spans(text, q))) for q in (0, 1)]
        if after[0] == after[1]:
            return after[0], 0, 0, 0
        return None, after[0], 0, 0

    def cut(self, text: bytes, quoted: int, depth: int) -> list[bytes]:
        lines = np.flatnonzero(np.frombuffer(text, np.uint8) == ord("\n"))
        spans = [(s, len(text) if e is None else e) for s, e in self.spans(text, quoted)]
        if spans:
            starts, ends = np.array(spans).T
            before = np.searchsorted(starts, lines, "right") - 1
            lines = lines[(before < 0) | (lines >= ends[before])]
        starts, ends = [0, *(lines + 1).tolist()], [*lines.tolist(), len(text)]
        return [text[s:e] for s, e in zip(starts, ends)]


def read_csv_quoted_lines(
    spark: SparkSession, path, schema: T.StructType, *, header: bool = True, separator: str = ",",
    escape: str = '"', strict: bool = False,
) -> DataFrame:
    """Delimited text whose quoted fields may hold line ends, cut by as many tasks
    as the files have splits.

    A quote within quotes is written twice, or after a backslash with that as
    `escape`; one that doesn't start a field is text. Records end in a line feed; a
    carriage return before it is dropped. Empty lines are skipped, each file's first
    record is its header. `strict` fails on a value that doesn't parse or a quote
    that doesn't close; otherwise the value is null and an open quote goes on to the
    end of the file. An empty file has no rows.
    """
    if escape not in ('"', "\\") or len(separator.encode()) != 1:
        raise ValueError("the escape is a quote or a backslash, the separator one character")
    quoting = _Quoting(separator, escape)
    records = cut_records(spark, path, Grammar("\n", quoting.effect, quoting.cut), complete=strict)
    if header:
        records = records.filter("number IS NULL OR number > 0")
    rows = records.select(F.regexp_replace("text", "\r$", "").alias("text")).filter(F.col("text") != "")
    # The option keeps line ends within quotes as they are.
    options = {
        "sep": separator, "escape": escape, "multiLine": "true",
        "mode": "FAILFAST" if strict else "PERMISSIVE",
    }
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return rows.select(F.from_csv("text", ddl, options).alias("row")).select("row.*")
