"""Document fingerprints of closed syncmers.

A k-mer of characters is a closed syncmer when the smallest of its inner s-mers
is its first or its last. Whether it is depends on the k-mer alone, not on what
surrounds it, so equal passages give equal anchors wherever they stand, and an
edit changes only the anchors that overlap it.

A fingerprint is all anchors of a text in the order of their places. Likeness
matches the anchors of two fingerprints by position: the most pairs of equal
anchors, each used once, that stand in the same order in both. It is the number
of anchors so matched as a share of all anchors of both.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from weirflow.llm.common import code_points, in_chunks, mixed, query
from weirflow.plans.registry import table

K = 12
S = 5
SKETCH = 256  # of a sketch, where a caller asks for one
MASK_BYTES = 64 << 20
HASH_BITS = 32
CHUNK_CHARS = 400_000
PART_BYTES = 32 << 20
NO_ID = int(np.iinfo(np.int64).min)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _rolling(points: np.ndarray, width: int) -> np.ndarray:
    """Polynomial hashes of all windows of `width` points, by doubling."""
    power, size, result, offset = np.array([_BASE]), 1, None, 0
    block = points.astype(np.uint64) + np.uint64(1)
    while True:
        if width & size:
            part = block[offset : offset + len(points) - width + 1]
            result = part if result is None else result * power + part
            offset += size
        if size * 2 > width:
            return mixed(result)
        block = block[:-size] * power + block[size:]
        power = power * power
        size *= 2


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window, from running minima of blocks of `width`."""
    padded = np.full(-(-len(values) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(back[:count], ahead[width - 1 : width - 1 + count])


def anchors(texts: list[str], k: int = K, s: int = S) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of the closed syncmers of each text, in text order. A
    text shorter than a k-mer, but not empty, is one anchor as a whole."""
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    starts = np.r_[0, np.cumsum(lengths)]
    points = code_points("".join(texts))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    if len(points) >= k:
        inner = _rolling(points, s)
        span = k - s + 1
        least = _window_min(inner, span)
        count = len(points) - k + 1
        is_anchor = (inner[:count] == least[:count]) | (inner[span - 1 : span - 1 + count] == least[:count])
        place = np.flatnonzero(is_anchor)
        # Read with a different end mark than s-mers, so that hashes are independent.
        hashes = mixed(_rolling(points, k)[place] ^ _BASE) >> np.uint64(64 - HASH_BITS)
    else:
        place, hashes = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    lo = np.searchsorted(place, starts[:-1])
    hi = np.searchsorted(place, np.maximum(starts[1:] - k + 1, starts[:-1]))
    for i, text in enumerate(texts):
        if 0 < lengths[i] < k:
            whole = mixed(_rolling(code_points(text), len(text)) ^ np.uint64(len(text)))
            found.append((whole >> np.uint64(64 - HASH_BITS), np.zeros(1, np.int64)))
        else:
            found.append((hashes[lo[i] : hi[i]], place[lo[i] : hi[i]] - starts[i]))
    return found


def sketch(found: tuple[np.ndarray, np.ndarray], size: int = SKETCH) -> tuple[np.ndarray, np.ndarray]:
    """The smallest distinct hashes, ascending, and their first places."""
    hashes, first = np.unique(found[0], return_index=True)
    return hashes[:size], found[1][first[:size]]


def fingerprint_text(hashes: np.ndarray) -> str:
    return hashes.astype(">u4").tobytes().hex()


def _by_pairs(a: list[int], at: dict[int, list[int]]) -> int:
    """Longest common subsequence: over the pairs of equal values, the longest
    rising chain of places."""
    ends: list[int] = []  # smallest last place of a chain of each length
    for value in a:
        for place in at[value]:  # descending, so that no two share a value of `a`
            i = bisect_left(ends, place)
            if i == len(ends):
                ends.append(place)
            else:
                ends[i] = place
    return len(ends)


def _by_bits(a: list[int], at: dict[int, list[int]], size: int) -> int:
    """The same, a bit for each of the `size` places: for values that repeat so
    often that their pairs are too many."""
    whole = (1 << size) - 1
    held: dict[int, int] = {}
    most = MASK_BYTES // (size // 8 + 1)

    def mask(value: int) -> int:
        if value in held:
            return held[value]
        bits = np.zeros(size, np.uint8)
        bits[at[value]] = 1
        made = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
        if len(held) < most:
            held[value] = made
        return made

    open_bits = whole
    for value in a:
        hit = open_bits & mask(value)
        if hit:
            open_bits = ((open_bits + hit) | (open_bits - hit)) & whole
    return size - open_bits.bit_count()


def _same_ends(a: np.ndarray, b: np.ndarray) -> int:
    """Equal values that both begin with."""
    size = min(len(a), len(b))
    differ = a[:size] != b[:size]
    return int(differ.argmax()) if differ.any() else size


def matched(a: np.ndarray, b: np.ndarray) -> int:
    """Anchors of two fingerprints matched by position: the length of the longest
    common subsequence of their hashes, exactly."""
    head = _same_ends(a, b)
    a, b = a[head:], b[head:]
    tail = _same_ends(a[::-1], b[::-1])
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    a, b = a[np.isin(a, b)], b[np.isin(b, a)]
    if not len(a):
        return head + tail
    at: dict[int, list[int]] = {}
    for place in range(len(b) - 1, -1, -1):
        at.setdefault(int(b[place]), []).append(place)
    values = a.tolist()
    pairs = sum(len(at[v]) for v in values)
    if pairs <= len(values) * (16 + len(b) // 64):
        return head + tail + _by_pairs(values, at)
    return head + tail + _by_bits(values, at, len(b))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the anchors of both fingerprints that match by position. Two
    empty fingerprints are alike, an empty and another one are not."""
    total = len(a) + len(b)
    return 2 * matched(a, b) / total if total else 1.0


def positional_matches(a, b) -> np.ndarray:
    """(place in a, place in b) of the anchors common to two sketches, each a
    (hashes, places) pair with ascending hashes."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    pairs = np.column_stack([a[1][i], b[1][j]])
    return pairs[np.argsort(pairs[:, 0], kind="stable")]


def sketches(texts: list[str], size: int | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
    """(hashes, places) of all anchors of each text, in text order; with a `size`
    only its sketch."""
    result = []
    for part in in_chunks([len(t) for t in texts], CHUNK_CHARS):
        found = anchors(texts[part])
        result += found if size is None else [sketch(one, size) for one in found]
    return result


def fingerprint_documents(
    docs: DataFrame, *, text: str = "text", key: str = "doc_id", size: int | None = None
) -> DataFrame:
    """key, fingerprint (hex of the hashes), hashes and places of every row, where
    it stands: all anchors, as op10 has them, or with a `size` only the sketch of it.
    A null or empty text has no anchors."""

    def run(batches):
        for batch in batches:
            found = sketches([t or "" for t in batch.column("text").to_pylist()], size)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([fingerprint_text(h) for h, _ in found], pa.string()),
                 pa.array([h.astype(np.int64) for h, _ in found], pa.list_(pa.int64())),
                 pa.array([p for _, p in found], pa.list_(pa.int64()))],
                names=["key", "fingerprint", "hashes", "places"],
            )

    rows = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(
        run, f"key {kind}, fingerprint string, hashes array<bigint>, places array<bigint>"
    )


def edited(text: str, following: str) -> str:
    """The last half of `text` replaced by as many first characters of `following`."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


DEALT = "part int, ghost boolean, doc_id long, text string"
RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _deal(bounds: np.ndarray):
    """Deal rows out by id. `bounds` are ids that occur, descending; part i holds
    the ids from bounds[i] down to above bounds[i + 1], the last part all the
    rest and rows without an id. The first row of every part is also sent, as a
    ghost, to the part before it, and that of part 0 to the last one."""
    ascending = bounds[::-1]

    def run(batches):
        parts = len(bounds)
        for batch in batches:
            ids = batch.column("doc_id").fill_null(NO_ID).to_numpy()
            part = parts - 1 - np.searchsorted(ascending, ids, side="left")
            heads = np.flatnonzero(np.isin(ids, bounds))
            take = pa.array(np.r_[np.arange(len(ids)), heads])
            ghost = np.r_[np.zeros(len(ids), bool), np.ones(len(heads), bool)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.r_[part, (part[heads] - 1) % parts], pa.int32()), pa.array(ghost),
                 batch.column("doc_id").take(take), batch.column("text").take(take)],
                names=["part", "ghost", "doc_id", "text"],
            )

    return run


def _compare_neighbours(batches):
    last = None  # (part, doc_id, text, anchors) of the row before
    for batch in batches:
        parts, ghosts = batch.column("part").to_pylist(), batch.column("ghost").to_pylist()
        ids = batch.column("doc_id").to_pylist()
        texts = [t or "" for t in batch.column("text").to_pylist()]
        rows = list(zip(parts, ghosts, ids, texts, sketches(texts)))
        pairs = []
        for part, ghost, doc, text, own in rows:
            if last is not None and last[0] == part:
                pairs.append((last, text, own))
                last = None
            if not ghost:
                last = (part, doc, text, own)
        changed = [edited(mine[2], text) for mine, text, _ in pairs]
        out = []
        for (mine, _, nxt), new, (new_own, _) in zip(pairs, changed, sketches(changed)):
            _, doc, text, (own, _) = mine
            out.append((
                doc, len(text), hashlib.sha256(new.encode()).hexdigest(), fingerprint_text(own),
                fingerprint_text(new_own), likeness(own, new_own), likeness(own, nxt[0]),
            ))
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        columns = zip(*out) if out else [()] * len(kinds)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)],
            names=[c.split()[0] for c in RESULT.split(", ")],
        )


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Every document's fingerprint against those of its edited text and of the
    next document by descending id (after the last: the first).

    Rows of one id follow each other by descending text, rows without an id come
    last, and a null text is empty. A single document is its own next one. Texts
    are shuffled once, by ranges of the id that hold about equal bytes, one range to
    a task; each range is read in order, row by row. Rows of one id, or without one,
    are not split."""
    spark = docs.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    count, total, top = docs.agg(F.count("doc_id"), F.sum(size), F.max("doc_id")).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-(total or 0) // PART_BYTES))
    # A row counts once and once more for each mean size it holds, so that cuts
    # follow rows and bytes; there are at most twice as many of these as rows.
    mean = max(1, (total or 0) // max(1, count))
    weighed = docs.select(F.explode(
        F.array_repeat("doc_id", (F.lit(1) + F.floor(size / F.lit(mean))).cast("int"))
    ).alias("doc_id"))
    cuts = [1 - i / parts for i in range(parts)]
    found = weighed.agg(F.percentile_approx("doc_id", cuts, 10 * parts)).first()[0] or [NO_ID]
    bounds = np.array(sorted({*found, NO_ID if top is None else top}, reverse=True), np.int64)
    dealt = docs.select("doc_id", "text").mapInArrow(_deal(bounds), DEALT)
    return (
        dealt.repartitionById(len(bounds), "part")
        .sortWithinPartitions(
            "part", "ghost", F.col("doc_id").desc_nulls_last(), F.col("text").desc_nulls_last()
        )
        .mapInArrow(_compare_neighbours, RESULT)
    )


@query("op10_syncmers")
def syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(table(spark, sf_dir, "documents").select("doc_id", "text"))
