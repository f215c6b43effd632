"""Near-duplicate groups by SimHash and a binary trie self-join.

1. Every text becomes a 64-bit fingerprint of its word shingles; equal
   fingerprints are folded into one row first, so copies cost nothing later.
2. Pairs at `distance` or fewer bits are found by walking a binary trie of the
   fingerprints against itself: a pair of nodes carries the number of bits in
   which their paths differ, and is dropped once that exceeds the budget.
3. Linked fingerprints are joined to components by star contraction.

The trie is dealt out by its upper levels. Of `distance + 1` blocks of bits a
linked pair shares at least one, so the trie is walked once for every block
moved to the top, starting at node pairs that have the whole block in common.
A start node with more than `bucket_rows` fingerprints is started again deeper,
below one of `distance + 1` blocks of its remaining bits. Nodes that are still
large after `LEVELS` such steps, like one large cluster of lightly edited copies, are
split into blocks by hash, and every pair of blocks is walked as a node of its own.
All this stays complete, and no task holds a node of more than about twice
`block_rows` fingerprints.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, map_rows, query, texts_of
from weirflow.plans.registry import table
from weirflow.workspace import materialize

BITS = 64
SEED = 42
BUCKET_ROWS = 1024
LEVELS = 3
BLOCK_ROWS = 15_000
JOIN_ROWS = 30_000
FRONTIER = 400_000
LEAF = 16
SALTS = 8


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Bits set in more than half of the hashes of all word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle_words))))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        block = np.unpackbits(hashes[start : start + (1 << 16)].astype(">u8").view(np.uint8))
        ones += block.reshape(-1, BITS).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def with_fingerprints(rows: DataFrame, *, text: str, shingle_words: int) -> DataFrame:
    """Add `result`, the fingerprint as a signed long, to a table of `row` structs."""

    def run(batches):
        for batch in batches:
            prints = [fingerprint(t, shingle_words) for t in texts_of(batch, text)]
            yield batch.column("row"), pa.array(np.array(prints, np.uint64).view(np.int64))

    return map_rows(rows, run, T.LongType())


def _blocks(width: int, parts: int) -> list[tuple[int, int]]:
    """(first bit from the top, length) of `parts` blocks of about equal length."""
    edges = [round(width * i / parts) for i in range(parts + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _deeper(
    starts: DataFrame, fixed_before: set[int], distance: int
) -> tuple[DataFrame, set[int]]:
    """Every start node's fingerprints once for each block of their remaining
    bits, that block moved up behind the `fixed` bits of the node; and the
    numbers of bits that are fixed then."""
    parts, fixed_after = [], set()
    for fixed in sorted(fixed_before):
        rest = BITS - fixed
        own = starts.filter(F.col("fixed") == fixed)
        for number, (first, length) in enumerate(_blocks(rest, distance + 1)):
            # The low `rest` bits are turned left so that the block leads them.
            low = F.col("bits") if fixed == 0 else F.col("bits").bitwiseAND(F.lit((1 << rest) - 1))
            high = F.col("bits").bitwiseXOR(low)
            turned = low if first == 0 else F.shiftleft(low, first).bitwiseOR(
                F.shiftrightunsigned(low, rest - first)
            )
            if fixed:
                turned = turned.bitwiseAND(F.lit((1 << rest) - 1))
            parts.append(own.select(
                "fp", high.bitwiseOR(turned).alias("bits"), F.lit(fixed + length).alias("fixed"),
                F.concat("path", F.lit(str(number))).alias("path"),
            ))
            fixed_after.add(fixed + length)
    whole = reduce(DataFrame.unionByName, parts)
    node = F.expr(f"shiftrightunsigned(bits, {BITS} - fixed)")
    return whole.withColumn("node", node), fixed_after


def _in_block_pairs(nodes: DataFrame, block_rows: int) -> DataFrame:
    """Nodes of more than two blocks once for every pair of their blocks."""
    huge = materialize(
        nodes.groupBy("path", "node").agg(F.count(F.lit(1)).alias("size"))
        .filter(F.col("size") > 2 * block_rows)
        .select("path", "node", F.ceil(F.col("size") / block_rows).alias("blocks")),
        "simhash-huge",
    )
    if huge.isEmpty():
        return nodes
    own = F.pmod(F.xxhash64("fp"), F.col("blocks"))
    split = (
        nodes.join(huge, ["path", "node"]).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .filter("own != other")
        .withColumn("path", F.concat(
            "path", F.lit("/"), F.least("own", "other"), F.lit("-"), F.greatest("own", "other")
        ))
    )
    return nodes.join(huge, ["path", "node"], "left_anti").unionByName(split.select(*nodes.columns))


def start_nodes(
    prints: DataFrame, distance: int, bucket_rows: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(path, node, fixed, bits, fp): the node pairs the walk starts from."""
    starts = prints.select(
        "fp", F.col("fp").alias("bits"), F.lit(0).alias("fixed"), F.lit("").alias("path")
    )
    fixed, done = {0}, []
    for level in range(LEVELS):
        nodes, fixed = _deeper(starts, fixed, distance)
        if level == LEVELS - 1:
            done.append(_in_block_pairs(nodes, block_rows))
            break
        large = materialize(
            nodes.groupBy("path", "node").agg(F.count(F.lit(1)).alias("size"))
            .filter(F.col("size") > bucket_rows).select("path", "node"),
            "simhash-large",
        )
        if large.isEmpty():
            done.append(nodes)
            break
        done.append(nodes.join(large, ["path", "node"], "left_anti"))
        starts = materialize(nodes.join(large, ["path", "node"], "left_semi"), "simhash-deeper")
    return reduce(DataFrame.unionByName, done)


class _Forest:
    """Labels of items; linked items end up with the same, smallest label."""

    def __init__(self, size: int) -> None:
        self.label = np.arange(size)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        label = self.label
        while True:
            x, y = label[a], label[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while not np.array_equal(label, label[label]):
                label[:] = label[label]


def walk(values: np.ndarray, groups: np.ndarray, fixed: np.ndarray, distance: int) -> np.ndarray:
    """For values sorted within groups, the smallest label of each value's
    component under links of up to `distance` bits inside its group.

    A node is a range of the sorted values; node pairs descend one bit a step.
    """
    forest = _Forest(len(values))
    if len(values) < 2:
        return forest.label
    edges = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1], True])
    lo, hi = edges[:-1], edges[1:]
    big = hi - lo > 1
    lo, hi = lo[big], hi[big]
    depth = int(fixed.min()) if len(fixed) else 0
    stack = [(depth, lo, hi, lo, hi, np.zeros(len(lo), np.int64))]
    ones_before: dict[int, np.ndarray] = {}

    def ones(bit: int) -> np.ndarray:
        if bit not in ones_before:
            is_one = (values >> np.uint64(BITS - 1 - bit)) & np.uint64(1)
            ones_before[bit] = np.r_[0, np.cumsum(is_one, dtype=np.int64)]
        return ones_before[bit]

    while stack:
        depth, alo, ahi, blo, bhi, errors = stack.pop()
        if not len(alo):
            continue
        if len(alo) > FRONTIER:
            for part in np.array_split(np.arange(len(alo)), -(-len(alo) // FRONTIER)):
                stack.append((depth, alo[part], ahi[part], blo[part], bhi[part], errors[part]))
            continue
        small = ((ahi - alo) * (bhi - blo) <= LEAF) | (depth == BITS)
        if small.any():
            _compare(values, forest, alo[small], ahi[small], blo[small], bhi[small], distance)
            rest = ~small
            alo, ahi, blo, bhi, errors = alo[rest], ahi[rest], blo[rest], bhi[rest], errors[rest]
            if not len(alo):
                continue
        count = ones(depth)
        amid, bmid = ahi - (count[ahi] - count[alo]), bhi - (count[bhi] - count[blo])
        same = alo == blo
        more = errors + 1
        other = ~same
        pairs = (
            (alo, amid, blo, bmid, errors), (amid, ahi, bmid, bhi, errors),
            (alo, amid, bmid, bhi, more),
            (amid[other], ahi[other], blo[other], bmid[other], more[other]),
        )
        nxt = [np.concatenate(x) for x in zip(*pairs)]
        keep = (nxt[4] <= distance) & (nxt[1] > nxt[0]) & (nxt[3] > nxt[2])
        keep &= (nxt[0] != nxt[2]) | (nxt[1] - nxt[0] > 1)
        stack.append((depth + 1, *(x[keep] for x in nxt)))
    return forest.label


def _compare(values, forest, alo, ahi, blo, bhi, distance) -> None:
    """All pairs below small node pairs, by the bits in which they differ."""
    width = bhi - blo
    sizes = (ahi - alo) * width
    for part in np.array_split(np.arange(len(sizes)), max(1, -(-int(sizes.sum()) // 2_000_000))):
        size = sizes[part]
        pair = np.repeat(np.arange(len(part)), size)
        place = np.arange(len(pair)) - np.repeat(np.cumsum(size) - size, size)
        i = alo[part][pair] + place // width[part][pair]
        j = blo[part][pair] + place % width[part][pair]
        close = (i != j) & (np.bitwise_count(values[i] ^ values[j]) <= distance)
        forest.link(i[close], j[close])


def _link_batches(distance: int):
    def run(batches):
        held: list[pa.Table] = []
        rows = 0
        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            rows += batch.num_rows
            if rows < JOIN_ROWS:
                continue
            whole = pa.concat_tables(held)
            group = _groups(whole)
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on
            if cut:
                yield from _links(whole.slice(0, cut), group[:cut], distance)
                held, rows = [whole.slice(cut)], whole.num_rows - cut
            else:
                held = [whole]
        if rows:
            whole = pa.concat_tables(held)
            yield from _links(whole, _groups(whole), distance)

    return run


def _groups(rows: pa.Table) -> np.ndarray:
    """Number of each row's (path, node) group; rows come sorted by it."""
    path = rows.column("path").combine_chunks().dictionary_encode()
    path = (path.chunk(0) if isinstance(path, pa.ChunkedArray) else path).indices.to_numpy()
    node = rows.column("node").to_numpy()
    return np.r_[0, np.cumsum((path[1:] != path[:-1]) | (node[1:] != node[:-1]))]


def _links(rows: pa.Table, groups: np.ndarray, distance: int):
    bits = rows.column("bits").to_numpy().view(np.uint64)
    prints = rows.column("fp").to_numpy()
    fixed = rows.column("fixed").to_numpy()
    order = np.lexsort((bits, groups))
    label = np.arange(len(order))
    for depth in np.unique(fixed):
        at = order[fixed[order] == depth]
        label[at] = at[walk(bits[at], groups[at], fixed[at], distance)]
    linked = label != np.arange(len(label))
    yield pa.RecordBatch.from_arrays(
        [pa.array(prints[linked]), pa.array(prints[label[linked]])], names=["a", "b"]
    )


def linked_pairs(
    prints: DataFrame, distance: int, bucket_rows: int = BUCKET_ROWS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """(a, b), a > b: a forest that spans all links between the distinct
    fingerprints `fp`; links that close a circle within a task are left out."""
    starts = start_nodes(prints, distance, bucket_rows, block_rows)
    found = (
        starts.repartition(F.col("path"), F.col("node"))
        .sortWithinPartitions("path", "node")
        .mapInArrow(_link_batches(distance), "a long, b long")
    )
    return found.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of every linked node's component.

    Large and small stars in turn: every node passes its smallest neighbour on,
    first to larger neighbours, then to smaller ones, until all edges of a
    component lead to one root. Each round is a written table; a node with very
    many edges is spread over `SALTS` tasks.
    """

    def least(links: DataFrame) -> DataFrame:
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        return links.groupBy("a").agg(F.min("b").alias("m")).withColumn("salt", salts)

    def salted(links: DataFrame) -> DataFrame:
        return links.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)).cast("int"))

    def state(links: DataFrame):
        mark = F.xxhash64("a", "b").cast("decimal(20,0)")
        return links.agg(F.count(F.lit(1)), F.sum(mark)).first()

    edges = materialize(edges, "edges")
    before = state(edges)
    while before[0]:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = least(both).withColumn("m", F.least("m", "a"))
        large = (
            salted(both).join(own, ["a", "salt"]).filter("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = materialize(large, "large-star")
        own = least(large)
        small = salted(large).join(own, ["a", "salt"]).filter("b > m").select(
            F.col("b").alias("a"), F.col("m").alias("b")
        ).unionAll(own.filter("salt = 0").select("a", F.col("m").alias("b")))
        edges = materialize(small.distinct(), "small-star")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


class SimHashGroups(NamedTuple):
    """`rows`: (row, fp, uid), a written table; `prints`: per distinct
    fingerprint the `component_id` and the `uid` of the one row that stays."""

    rows: DataFrame
    prints: DataFrame


def simhash_groups(
    rows: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    keep_text: bool = True,
    shingle_words: int = 3,
    distance: int = 3,
    bucket_rows: int = BUCKET_ROWS,
) -> SimHashGroups:
    """Near-duplicate groups of a table of `row` structs.

    Words are runs of characters other than ASCII white space, A-Z in lower
    case. A text with fewer words than a shingle is one shingle; null, empty and
    blank texts have fingerprint zero and form one group. `component_id` is the
    smallest key of a group; the row that stays is that of the smallest key,
    then of the smallest `uid` (rows without a key come last). Rows may repeat.
    """
    printed = with_fingerprints(rows, text=text, shingle_words=shingle_words)
    if not keep_text:
        printed = printed.withColumn("row", F.col("row").dropFields(text))
    marked = materialize(
        printed.select(
            "row", F.col("result").alias("fp"), F.monotonically_increasing_id().alias("uid")
        ),
        "simhash",
    )
    order = F.struct(F.col("row")[key].isNull(), F.col("row")[key].alias("key"), F.col("uid"))
    prints = materialize(marked.groupBy("fp").agg(F.min(order).alias("first")), "fingerprints")
    roots = components(linked_pairs(prints.select("fp"), distance, bucket_rows))
    rooted = prints.join(roots, prints["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    chosen = rooted.groupBy("root").agg(F.min("first").alias("chosen"))
    return SimHashGroups(
        marked,
        rooted.join(chosen, "root").select(
            "fp", F.col("chosen.key").alias("component_id"), F.col("chosen.uid").alias("stays")
        ),
    )


@query("op6_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    groups = simhash_groups(as_rows(docs), keep_text=False)
    return groups.rows.join(groups.prints, "fp").select(
        "row.doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of every near-duplicate group the document with the
    smallest id stays."""
    groups = simhash_groups(as_rows(docs))
    staying = groups.prints.select(F.col("stays").alias("uid")).distinct()
    return groups.rows.join(staying, "uid", "left_semi").select("row.*")
