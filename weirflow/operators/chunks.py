"""Exact equal-count chunks of a table in the order of a key.

All chunk bounds are found at once, without sorting the table. A sample gives
splitters, and each row's range among them is found by binary search. Rows are
counted per range where they are, so it is known which ranges hold bounds. Only the
distinct keys of those ranges, with their counts, are shuffled, each range to a task
that sums them up in order and picks the keys at the wanted ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from weirflow.workspace import materialize

RANGES = 256
SAMPLED_PER_RANGE = 8


def chunk_count(rows: int, size: int) -> int:
    """Chunks of at most `size` rows that `rows` rows need."""
    if size < 1:
        raise ValueError("size must be positive")
    return -(-rows // size)


def place_among(value: Column, splitters: Column, count: int) -> Column:
    """How many entries of a sorted array of `count` are not above `value`: a binary
    search by falling powers of two."""
    steps = F.array(*[F.lit(1 << b) for b in range(max(count, 1).bit_length() - 1, -1, -1)])

    def step(place: Column, width: Column) -> Column:
        ahead = place + width
        fits = (ahead <= F.lit(count)) & (F.get(splitters, ahead - 1) <= value)
        return F.when(fits, ahead).otherwise(place)

    return F.aggregate(steps, F.lit(0), step)


def _splitters(points: DataFrame, rows: int, ranges: int) -> tuple[Column, int]:
    """A sorted array literal of fewer than 2 * `ranges` points, and their number:
    every so many of a hash sample, so that ranges are of similar size."""
    wanted = ranges * SAMPLED_PER_RANGE
    share = F.lit(int(min(1.0, wanted / max(rows, 1)) * (1 << 40)))
    drawn = points.filter(F.pmod(F.xxhash64("point"), F.lit(1 << 40)) < share)
    ordered = drawn.agg(F.array_sort(F.collect_set("point")).alias("all"))
    every = F.greatest(F.lit(1), F.expr(f"size(all) div {ranges}"))
    found = ordered.select(F.filter("all", lambda x, i: (i + 1) % every == 0)).first()[0]
    kind = points.schema["point"].dataType
    entries = [
        F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(point, kind)])
        for point in found
    ]
    return F.array(*entries).cast(T.ArrayType(kind)), len(entries)


def key_chunks(df: DataFrame, *, key: str, tie: str, size: int, ranges: int = RANGES) -> DataFrame:
    """(chunk, first_key, first_tie, last_key, last_tie, num_rows): ceil(rows / size)
    chunks, numbered from 0 in the order of (key, tie), of equal size but for one row.

    Nulls come first. Rows that agree in both columns can't be told apart: two
    chunks may then meet at the same (key, tie). However many rows share a key, they
    are one counted row per task and tie. An empty table has no chunks.
    """
    rows = df.count()
    chunks = chunk_count(rows, size)
    points = df.select(F.struct(F.col(key).alias("k"), F.col(tie).alias("t")).alias("point"))
    splitters, count = _splitters(points, rows, ranges)
    placed = points.withColumn("range", place_among(F.col("point"), splitters, count))
    counts = materialize(placed.groupBy("range").agg(F.count(F.lit(1)).alias("n")), "ranges")
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    bounds = starts.filter(_chunks_at(F.col("before"), F.col("n") + 1, rows, chunks, any_only=True))
    in_range = Window.partitionBy("range").orderBy("point").rowsBetween(Window.unboundedPreceding, -1)
    ranked = (
        placed.join(bounds.select("range", "before"), "range")
        .groupBy("range", "before", "point").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("rank", F.col("before") + F.coalesce(F.sum("n").over(in_range), F.lit(0)))
    )
    # A point of ranks a .. a + n - 1 begins the chunks that start there and ends
    # those whose successor starts one later.
    first = ranked.select(F.explode(_chunks_at(F.col("rank"), F.col("n"), rows, chunks)).alias("chunk"), "point")
    last = ranked.select(
        F.explode(_chunks_at(F.col("rank") + 1, F.col("n"), rows, chunks)).alias("next"), "point"
    ).select((F.col("next") - 1).alias("chunk"), F.col("point").alias("end"))
    number = F.col("chunk").cast("decimal(38,0)")
    total = (F.lit(rows).cast("decimal(19,0)"), F.lit(max(chunks, 1)).cast("decimal(19,0)"))

    def start(c: Column) -> Column:
        return F.call_function("div", c.cast("decimal(19,0)") * total[0], total[1])

    return first.filter(F.col("chunk") < chunks).join(last, "chunk").select(
        F.col("chunk").cast("int").alias("chunk"),
        F.col("point.k").alias("first_key"), F.col("point.t").alias("first_tie"),
        F.col("end.k").alias("last_key"), F.col("end.t").alias("last_tie"),
        (start(number + 1) - start(number)).cast("long").alias("num_rows"),
    )


def _chunks_at(rank: Column, n: Column, rows: int, chunks: int, any_only: bool = False) -> Column:
    """The chunks c, from 0 to their number, that start at one of the ranks from
    `rank` to `rank + n - 1`; a chunk starts at c * rows div chunks."""
    whole = "decimal(19,0)"
    all_rows, all_chunks = F.lit(max(rows, 1)).cast(whole), F.lit(chunks).cast(whole)

    def least(at: Column) -> Column:
        """The first chunk that doesn't start before a rank."""
        return F.call_function("div", at.cast(whole) * all_chunks + all_rows - 1, all_rows)

    low, high = least(rank), least(rank + n) - 1
    if any_only:
        return low <= high
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
