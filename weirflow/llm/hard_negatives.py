"""Hard negatives for anchors, by exact integer scores.

Scores are inner products of integer vectors, computed the way of the Four
Russians: the dimensions are cut into groups of eight, and for each anchor and
group a table holds the sums of all 256 subsets of the anchor's eight components.
The components of a candidate are split into bit planes, eight dimensions to a
byte, so a byte of a plane is the place in the table of what its group adds.
Planes are added from the highest down, doubling in between; the highest one, the
sign of two's complement, counts as negative.

Anchors are a query set against all rows. They go to the tasks in blocks of
bounded size; every task scores its rows in blocks against a block of anchors and
passes on the best few for each anchor, so what is shuffled grows with anchors
times blocks, not with the pairs. One pass finds the positives, one the negatives
between the bounds that the positives' scores set.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirflow.llm.common import query
from weirflow.operators.ranking import number_rows
from weirflow.plans.registry import table
from weirflow.workspace import materialize, new_path

# Fixed values of the contract.
POSITIVES = 5
NEGATIVES = 10
LEAST_PERCENT = 30
MOST_PERCENT = 90
SCALE = 256
LABELS = 10

ANCHORS_PER_PASS = 2048
ANCHORS_AT_ONCE = 128
BLOCK_ROWS = 8192
MOST_BITS = 62

FOUND = "anchor int, positive int, score long, id long, uid long"


@dataclass(frozen=True)
class Anchors:
    """A block of anchors: their rows, and after the first pass their positives
    as (score, id, uid), best first."""

    uids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    positives: list[list[tuple[int, int, int]]]


def padded(lists: list[list[int]], width: int) -> np.ndarray:
    """Rows of equal width: what is missing is zero, what is beyond is left out."""
    result = np.zeros((len(lists), width), np.int64)
    lengths = np.fromiter(map(len, lists), np.int64, len(lists))
    if lengths.size and lengths.min() >= width:
        return np.array([x[:width] for x in lists], np.int64).reshape(len(lists), width)
    for row, values in zip(result, lists):
        row[: min(len(values), width)] = values[:width]
    return result


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """Sums of all subsets of every group of eight components: [group, subset,
    anchor]; bit k of a subset stands for the group's component k."""
    groups = anchors.shape[1] // 8
    sums = np.zeros((groups, 256, len(anchors)), anchors.dtype)
    parts = anchors.reshape(len(anchors), groups, 8).transpose(1, 2, 0)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + parts[:, k : k + 1]
    return sums


def bit_planes(vectors: np.ndarray) -> np.ndarray:
    """Bytes of the planes of two's complement: [plane, row, group], the lowest
    bit first and as many planes as the largest component needs with its sign."""
    top = max(int(vectors.max(initial=0)), ~int(vectors.min(initial=0)))
    planes = [(vectors >> p) & 1 for p in range(top.bit_length() + 1)]
    return np.stack([np.packbits(p.astype(np.uint8), axis=1, bitorder="little") for p in planes])


def scores(planes: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Inner products [row, anchor], by table lookups, shifts and additions."""
    shape, kind = (planes.shape[1], sums.shape[2]), sums.dtype
    total, found = np.zeros(shape, kind), np.empty(shape, kind)
    for p in range(len(planes) - 1, -1, -1):
        np.left_shift(total, 1, out=total)
        for group, places in enumerate(planes[p].T):
            np.take(sums[group], places, axis=0, out=found)
            total += found
        if p == len(planes) - 1:
            np.negative(total, out=total)
    return total


def score_type(anchors: np.ndarray, rows: np.ndarray) -> type:
    """The integer type that holds every score and what comes up on the way."""
    width = anchors.shape[1]
    largest = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (anchors, rows)]
    bits = (2 * width * largest[0] * max(1, largest[1])).bit_length() + 1
    if bits > MOST_BITS:
        raise ValueError(f"scores of {bits} bits; components must be smaller")
    return np.int32 if bits < 31 else np.int64


def best(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values, best first; the earlier one on a tie."""
    if len(values) > k:
        least = np.partition(values, len(values) - k)[len(values) - k]
        among = np.flatnonzero(values >= least)
    else:
        among = np.arange(len(values))
    return among[np.argsort(-values[among], kind="stable")][:k]


def between(values: np.ndarray, order: np.ndarray, positive: int, k: int) -> np.ndarray:
    """Of the values in descending order, the places of the first k within the
    bounds that a positive's score sets. Bounds are whole numbers, so exact."""
    low = -(-LEAST_PERCENT * positive // 100)
    high = MOST_PERCENT * positive // 100
    falling = -values[order]
    first = int(np.searchsorted(falling, -high, "left"))
    end = int(np.searchsorted(falling, -low, "right"))
    return order[first : min(end, first + k)]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of a task in blocks of at most BLOCK_ROWS."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = BLOCK_ROWS - sum(b.num_rows for b in held)
            held.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in held) == BLOCK_ROWS:
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)


def _search(anchors: Anchors, k: int, negatives: bool):
    """Task of a pass: each block's best rows for each anchor, or for each anchor
    and positive."""

    def chosen(column, a, same, other):
        if not negatives:
            yield 0, same[best(column[same], k)]
            return
        values = column[other]
        order = np.argsort(-values, kind="stable")
        for number, (positive, _, _) in enumerate(anchors.positives[a]):
            yield number, other[between(values, order, positive, k)]

    def of_block(block: pa.Table) -> Iterator[pa.RecordBatch]:
        ids = np.array(block["id"].fill_null(np.iinfo(np.int64).max))
        uids, labels = np.array(block["uid"]), np.array(block["label"])
        unnamed = np.array(block["id"].is_null())
        order = np.lexsort((uids, ids, unnamed))
        ids, uids, labels, unnamed = ids[order], uids[order], labels[order], unnamed[order]
        width = anchors.vectors.shape[1]
        rows = padded(block["vector"].to_pylist(), width)[order]
        kind = score_type(anchors.vectors, rows)
        planes = bit_planes(rows)
        same = {label: np.flatnonzero(labels == label) for label in set(anchors.labels.tolist())}
        other = {label: np.flatnonzero(labels != label) for label in same}
        for start in range(0, len(anchors.uids), ANCHORS_AT_ONCE):
            part = slice(start, start + ANCHORS_AT_ONCE)
            found = scores(planes, subset_sums(anchors.vectors[part].astype(kind))).T
            columns: list[list] = [[], [], [], [], []]
            for a, column in enumerate(np.ascontiguousarray(found), start):
                label = anchors.labels[a]
                alike = same[label][uids[same[label]] != anchors.uids[a]]
                for number, places in chosen(column, a, alike, other[label]):
                    columns[0] += [a] * len(places)
                    columns[1] += [number] * len(places)
                    columns[2] += column[places].tolist()
                    columns[3] += [None if n else i for i, n in
                                   zip(ids[places].tolist(), unnamed[places].tolist())]
                    columns[4] += uids[places].tolist()
            kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=["anchor", "positive", "score", "id", "uid"],
            )

    def run(batches):
        for block in _blocks(batches):
            yield from of_block(block)

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    """The first k of all tasks for each anchor and positive, with their rank."""
    order = Window.partitionBy("anchor", "positive").orderBy(
        F.desc("score"), F.asc_nulls_last("id"), "uid"
    )
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mine_hard_negatives(
    rows: DataFrame, *, id: str, vector: str, label: str, anchor: str,
    positives: int = POSITIVES, negatives: int = NEGATIVES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score):
    for every row with `row.anchor` and each of its first `positives` rows of the
    same label, the first `negatives` rows of another label whose scores lie
    between 30 % and 90 % of the positive's.

    `row.vector` holds integers; a shorter vector counts as filled up with zeros.
    Rows with a null label, vector or component take no part. Higher scores come
    first, ties go by the smaller id; a null id comes last, and of equal ids the
    row that stands earlier in the table. Every row stands for itself: a repeated
    row is another row, so it may be the positive of its twin, and an anchor that
    repeats has its result twice. An empty table, or one without an anchor, gives
    no rows. Scores of more than 62 bits are refused.
    """
    spark = rows.sparkSession
    row = F.col("row")
    whole = row[vector].isNotNull() & F.forall(row[vector], lambda x: x.isNotNull())
    table = materialize(
        rows.filter(row[label].isNotNull() & whole).select(
            F.monotonically_increasing_id().alias("uid"), row[id].cast("long").alias("id"),
            row[label].cast("long").alias("label"), row[vector].cast("array<long>").alias("vector"),
            F.coalesce(row[anchor], F.lit(False)).alias("anchor"),
        ),
        "vectors",
    )
    chosen = number_rows(table.filter("anchor").drop("anchor"), [F.asc("id"), F.asc("uid")], "number")
    count, asked = table.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    tasks = max(1, -(-count // BLOCK_ROWS))
    path = new_path(spark, "negatives")
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    spark.createDataFrame([], result).write.parquet(path)
    for start in range(0, asked, ANCHORS_PER_PASS):
        within = (F.col("number") > start) & (F.col("number") <= start + ANCHORS_PER_PASS)
        held = sorted(chosen.filter(within).collect(), key=lambda r: r["number"])
        block = _anchors(held)
        search = table.select("uid", "id", "label", "vector").repartition(tasks)
        first = _first(search.mapInArrow(_search(block, positives, False), FOUND), positives)
        for r in sorted(first.collect(), key=lambda r: r["rank"]):
            block.positives[r["anchor"]].append((r["score"], r["id"], r["uid"]))
        found = _first(search.mapInArrow(_search(block, negatives, True), FOUND), negatives)
        pairs = spark.createDataFrame(
            [(a, n, held[a]["id"], i, s) for a, own in enumerate(block.positives)
             for n, (s, i, _) in enumerate(own)],
            "anchor int, positive int, anchor_id long, positive_id long, positive_score long",
        )
        found.join(pairs, ["anchor", "positive"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        ).write.mode("append").parquet(path)
    return spark.read.schema(result).parquet(path)


def _anchors(rows) -> Anchors:
    """A block from its collected rows, at most ANCHORS_PER_PASS; the width is that
    of the longest vector, filled up to whole groups of eight."""
    width = -(-max(1, *(len(r["vector"]) for r in rows)) // 8) * 8
    return Anchors(
        np.array([r["uid"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64),
        padded([r["vector"] for r in rows], width), [[] for _ in rows],
    )


_SQL = f"""
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % {LABELS} ELSE label END AS label,
        [floor({SCALE} * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF coalesce(isfinite(x), FALSE)]) = len(embedding)),
s AS (
    SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same,
        CAST(list_dot_product(a.q, v.q) AS BIGINT) AS score
    FROM v a JOIN v ON a.vec_id <> v.vec_id WHERE a.vec_id % 100 = 0),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES})
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND {LEAST_PERCENT} * positive_score <= 100 * score
    AND 100 * score <= {MOST_PERCENT} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}"""


@query("op12_hard_negatives", _SQL)
def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    rows = vectors.select(F.struct(
        "vec_id", moved.alias("label"), F.when(finite, scaled).alias("vector"),
        (F.col("vec_id") % 100 == 0).alias("anchor"),
    ).alias("row"))
    return mine_hard_negatives(rows, id="vec_id", vector="vector", label="label", anchor="anchor")
