"""Benchmark decontamination with suffix arrays over shards of the training text.

Every task gathers whole documents to shards of bounded size, builds a suffix
array of the shard's words and binary-searches the benchmark's suffixes in it,
those that begin with the same window as one. Where a suffix's longest match
reaches a whole window, the array's interval below the window lists every
occurrence. The words from each occurrence on are searched among all suffixes of
the benchmark, in its own array; so every document's longest match is found with
its place. Documents are never shuffled.

Words of the benchmark are numbered. Any other word ends every match, so only
runs of benchmark words that can hold the shortest window enter the array.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import cached_property, reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, map_rows, query, texts_of
from weirflow.plans.registry import table
from weirflow.workspace import materialize

WINDOW_WORDS = 13
SHARD_WORDS = 600_000
BLOCK_BYTES = 16 << 20

#: ASCII letters in lower case; every other ASCII character but digits is a gap.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)

LONGEST = T.StructType([
    T.StructField("words", T.LongType()), T.StructField("doc_word", T.LongType()),
    T.StructField("item", T.StringType()), T.StructField("item_word", T.LongType()),
])
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.LongType())),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("nameless", T.BooleanType()),
    T.StructField("longest", LONGEST),
])
RESULT_ARROW = pa.struct([
    ("n_words", pa.int64()), ("hits", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
    ("nameless", pa.bool_()),
    ("longest", pa.struct([("words", pa.int64()), ("doc_word", pa.int64()),
                           ("item", pa.string()), ("item_word", pa.int64())])),
])


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits and of any non-ASCII characters."""
    return (text or "").encode().translate(_FOLD).split()


@dataclass
class Benchmark:
    """Numbered words of a block of benchmark items, laid end to end; word 0
    stands between items. `windows` are distinct: (start, words, items)."""

    numbers: dict[bytes, int]
    words: np.ndarray
    item_of: np.ndarray
    ends: np.ndarray
    names: list[str | None]
    window_at: np.ndarray
    window_words: np.ndarray
    window_items: list[np.ndarray] = field(repr=False)

    @cached_property
    def suffixes(self) -> Shard:
        """Array of all suffixes of the items."""
        return Shard.build(self.words, 0)

    @cached_property
    def starts(self) -> np.ndarray:
        """For every position, where its item starts."""
        new = np.r_[True, self.words[:-1] == 0][: len(self.words)]
        return np.maximum.accumulate(np.where(new, np.arange(len(self.words)), 0))

    @property
    def least_window(self) -> int:
        return int(self.window_words.min()) if len(self.window_words) else 0


def index_benchmark(items: Sequence[tuple[str | None, str | None]], window: int) -> Benchmark:
    numbers: dict[bytes, int] = {}
    words: list[int] = []
    item_of, ends, names = [], [], []
    windows: dict[tuple[int, ...], tuple[int, set[int]]] = {}
    places: dict[str | None, int] = {}
    for name, text in items:
        own = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        if not own:
            continue
        if name not in places:
            places[name] = len(names)
            names.append(name)
        first, size = len(words), min(window, len(own))
        for i in range(len(own) - size + 1):
            found = windows.setdefault(tuple(own[i : i + size]), (first + i, set()))
            found[1].add(places[name])
        words += [*own, 0]
        item_of += [places[name]] * (len(own) + 1)
        ends += [first + len(own)] * (len(own) + 1)
    return Benchmark(
        numbers, np.array(words, np.int64), np.array(item_of, np.int64),
        np.array(ends, np.int64), names,
        np.array([at for at, _ in windows.values()], np.int64),
        np.array([len(w) for w in windows], np.int64),
        [np.array(sorted(owners), np.int64) for _, owners in windows.values()],
    )


def run_ends(words: np.ndarray) -> np.ndarray:
    """For every position, where its run of numbered words ends."""
    gaps = np.flatnonzero(words == 0)
    return np.r_[gaps, len(words)][np.searchsorted(gaps, np.arange(len(words)))]


def suffix_array(words: np.ndarray, starts: np.ndarray, longest: int) -> np.ndarray:
    """`starts` in the order of the suffixes there, each read up to the gap
    that ends its run. Ranks of 1, 2, 4, … words until all are read."""
    rank = np.zeros(len(words) + 1, np.int64)
    rank[:-1] = words
    span = 1
    while span < longest:
        follow = np.minimum(starts + span, len(words))
        # A suffix whose first `span` words reach its gap has rank 0 behind it.
        pair = rank[starts] * (len(words) + 2) + rank[follow]
        values, place = np.unique(pair, return_inverse=True)
        rank = np.zeros(len(words) + 1, np.int64)
        rank[starts] = place + 1
        if len(values) == len(starts):
            break
        span *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


@dataclass
class Shard:
    words: np.ndarray
    array: np.ndarray
    ends: np.ndarray

    @classmethod
    def build(cls, words: np.ndarray, least_window: int) -> Shard:
        """Array of all suffixes that start in a run of `least_window` words or
        more. Other runs can't hold a window."""
        ends = run_ends(words)
        gap_before = np.r_[True, words[:-1] == 0] & (words != 0)
        run_start = np.maximum.accumulate(np.where(gap_before, np.arange(len(words)), 0))
        inside = (words != 0) & (ends - run_start >= max(1, least_window))
        kept = np.where(inside, words, 0)
        starts = np.flatnonzero(inside)
        longest = int((ends[starts] - starts).max()) if len(starts) else 0
        return cls(kept, suffix_array(kept, starts, longest), ends)

    def compare(self, at: np.ndarray, test: np.ndarray, first: np.ndarray, size: np.ndarray):
        """Order of the suffixes at `at` against test words [first, first+size):
        below 0, 0 (they begin with all of them) or above 0; and the number of
        words both share."""
        order = np.zeros(len(at), np.int64)
        shared = np.zeros(len(at), np.int64)
        left = np.arange(len(at))
        depth = 0
        while len(left):
            left = left[size[left] > depth]
            place = at[left] + depth
            own = np.where(place < len(self.words), self.words[np.minimum(place, len(self.words) - 1)], 0)
            other = test[first[left] + depth]
            differ = own != other
            order[left[differ]] = np.sign(own[differ] - other[differ])
            left = left[~differ]
            shared[left] += 1
            depth += 1
        return order, shared

    def search(self, test, first, size, after: bool) -> np.ndarray:
        """Where each test suffix belongs in the array; behind all suffixes
        that begin with it if `after`."""
        lo = np.zeros(len(first), np.int64)
        hi = np.full(len(first), len(self.array), np.int64)
        while True:
            left = np.flatnonzero(lo < hi)
            if not len(left):
                return lo
            mid = (lo[left] + hi[left]) // 2
            order, _ = self.compare(self.array[mid], test, first[left], size[left])
            below = order <= 0 if after else order < 0
            lo[left[below]] = mid[below] + 1
            hi[left[~below]] = mid[~below]

    def longest(
        self, test: np.ndarray, ends: np.ndarray, first: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Words of the longest match of each test suffix, and a place of it.
        `ends` has the end of the suffix at every place of `test`."""
        best, place = np.zeros(len(first), np.int64), np.full(len(first), -1, np.int64)
        if not len(self.array):
            return best, place
        size = ends[first] - first
        spot = self.search(test, first, size, after=False)
        for near in (spot - 1, spot):
            there = np.flatnonzero((near >= 0) & (near < len(self.array)))
            at = self.array[near[there]]
            _, shared = self.compare(at, test, first[there], size[there])
            more = shared > best[there]
            best[there[more]], place[there[more]] = shared[more], at[more]
        return best, place


def number_words(text: str | None, numbers: dict[bytes, int]) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(numbers.get, words, repeat(0)), np.int32, len(words))


def _shards(batches, text: str, bench: Benchmark) -> Iterator[tuple[list, Shard, np.ndarray]]:
    """(batches, shard, first word of each of their documents and the end)."""
    held, words, total = [], [], 0
    for batch in batches:
        held.append(batch)
        for value in texts_of(batch, text):
            words.append(number_words(value, bench.numbers))
            total += len(words[-1]) + 1
        if total >= SHARD_WORDS:
            yield held, *_shard(words, bench)
            held, words, total = [], [], 0
    if held:
        yield held, *_shard(words, bench)


def _shard(words: list[np.ndarray], bench: Benchmark) -> tuple[Shard, np.ndarray]:
    gap = np.zeros(1, np.int32)
    whole = np.concatenate([x for w in words for x in (w, gap)] or [gap]).astype(np.int64)
    first = np.r_[0, np.cumsum([len(w) + 1 for w in words], dtype=np.int64)]
    return Shard.build(whole, bench.least_window), first


def _occurrences(shard: Shard, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
    """(place in the shard, window number) of every occurrence of a window."""
    none = np.zeros(0, np.int64)
    if not len(shard.array) or not len(bench.window_at):
        return none, none
    match, _ = shard.longest(bench.words, bench.ends, bench.window_at)
    found = np.flatnonzero(match >= bench.window_words)
    at, size = bench.window_at[found], bench.window_words[found]
    lo = shard.search(bench.words, at, size, after=False)
    hi = shard.search(bench.words, at, size, after=True)
    count = hi - lo
    window = np.repeat(found, count)
    step = np.arange(len(window)) - np.repeat(np.cumsum(count) - count, count)
    return shard.array[np.repeat(lo, count) + step], window


def _merged(hits: np.ndarray) -> list[int]:
    """Union of half-open ranges, as a flat list of starts and ends."""
    if not len(hits):
        return []
    hits = hits[np.argsort(hits[:, 0], kind="stable")]
    reach = np.maximum.accumulate(hits[:, 1])
    new = np.r_[True, hits[1:, 0] > reach[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(hits) - 1]
    return np.column_stack([hits[new, 0], reach[last]]).ravel().tolist()


def _scan_shard(held: list, shard: Shard, first: np.ndarray, bench: Benchmark, earlier) -> list:
    place, window = _occurrences(shard, bench)
    doc = np.searchsorted(first, place, side="right") - 1
    order = np.argsort(doc, kind="stable")
    place, window, doc = place[order], window[order], doc[order]
    edges = np.searchsorted(doc, np.arange(len(first)))
    # A match of a window or more begins where a window does.
    words, spot = bench.suffixes.longest(shard.words, shard.ends, place)
    # A shorter one counts only if it is a whole item, as the window itself then is.
    short = words < bench.window_words.max(initial=0)
    words = np.where(short, bench.window_words[window], words)
    spot = np.where(short, bench.window_at[window], spot)
    answers = []
    for i in range(len(first) - 1):
        mine = slice(edges[i], edges[i + 1])
        before = earlier[i] if earlier else None
        starts = place[mine] - first[i]
        hits = np.column_stack([starts, starts + bench.window_words[window[mine]]])
        names: set[str | None] = set()
        longest = None
        if len(starts):
            best = edges[i] + int(np.lexsort((starts, -words[mine]))[0])
            at = int(spot[best])
            longest = {"words": int(words[best]), "doc_word": int(place[best] - first[i]),
                       "item": bench.names[bench.item_of[at]], "item_word": at - int(bench.starts[at])}
            owners = [bench.window_items[w] for w in np.unique(window[mine])]
            names = {bench.names[x] for x in np.unique(np.concatenate(owners))}
        if before:
            hits = np.vstack([hits, np.array(before["hits"], np.int64).reshape(-1, 2)])
            names |= set(before["items"]) | ({None} if before["nameless"] else set())
            if before["longest"] and (not longest or longest["words"] <= before["longest"]["words"]):
                longest = before["longest"]
        answers.append({
            "n_words": int(first[i + 1] - first[i] - 1), "hits": _merged(hits),
            "items": sorted(n for n in names if n is not None), "nameless": None in names, "longest": longest,
        })
    return answers


def _blocks(benchmark: DataFrame, item: str, text: str, block_bytes: int):
    """The benchmark in blocks that the driver can hold one at a time."""
    items = benchmark.select(
        benchmark[item].cast("string").alias("item"), benchmark[text].alias("text")
    ).filter("text is not null")
    size = items.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    if blocks == 1:
        yield items
        return
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(blocks)))
    for b in range(blocks):
        yield numbered.filter(F.col("block") == b).select("item", "text")


def find_contamination(
    rows: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Add `result` to a table of `row` structs: n_words; hits, the ranges of
    words inside any window's occurrence (start, end, start, end, …); items,
    the sorted ids of items with an occurring window; nameless, true if an item
    without an id is among them; longest, the longest verbatim match with any item
    that holds a window: words, doc_word and item_word (where it starts, from 0)
    and item, one of those that have it. It is null if there is no hit.

    The benchmark is sent to the tasks in blocks of about `block_bytes` of
    text; a larger one takes one pass over the documents per block. A null or
    wordless text has no words and no hits; an item with fewer words than the
    window is one window, one without words has none. Rows and items may repeat.
    """
    context = rows.sparkSession.sparkContext
    state, previous = rows, False
    for block in _blocks(benchmark, item, item_text, block_bytes):
        shared = context.broadcast(
            index_benchmark([(r["item"], r["text"]) for r in block.collect()], window)
        )

        def run(batches, shared=shared, previous=previous):
            bench = shared.value
            for held, shard, first in _shards(batches, text, bench):
                earlier = [r for b in held for r in b.column("result").to_pylist()] if previous else None
                answers = _scan_shard(held, shard, first, bench, earlier)
                done = 0
                for batch in held:
                    mine = answers[done : done + batch.num_rows]
                    yield batch.column("row"), pa.array(mine, RESULT_ARROW)
                    done += batch.num_rows

        if previous:
            state = materialize(state, "decontamination")
        state = map_rows(state.select("row", *(["result"] if previous else [])), run, RESULT)
        previous = True
    return state


MATCH = "item string, words long, item_word long, key string, doc_word long"


def longest_matches(
    docs: DataFrame, benchmark: DataFrame, *, text: str = "text", key: str = "doc_id",
    item: str = "item_id", item_text: str = "text", window: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The longest verbatim match of every item over all shards, if it reaches
    a window: item, words, item_word (where it starts in the item, from 0),
    key and doc_word (where it starts in the document), one of those as long.
    One pass over the documents per block of the benchmark."""
    context = docs.sparkSession.sparkContext
    rows = as_rows(docs.select(docs[key].cast("string").alias("key"), docs[text].alias("text")))
    passes = []
    for block in _blocks(benchmark, item, item_text, block_bytes):
        shared = context.broadcast(
            index_benchmark([(r["item"], r["text"]) for r in block.collect()], window)
        )
        passes.append(rows.mapInArrow(_longest_of_items(shared, window), MATCH))
    found = reduce(DataFrame.unionAll, passes)
    order = F.struct(F.col("words"), *[-F.col(c) for c in ("item_word", "doc_word")])
    return found.groupBy("item").agg(
        F.max_by(F.struct("words", "item_word", "key", "doc_word"), order).alias("best")
    ).select("item", "best.*")


def _longest_of_items(shared, window: int):
    def run(batches):
        bench = shared.value
        suffixes = np.flatnonzero(bench.words)
        least = np.minimum(window, bench.ends - bench.starts)[suffixes]
        for held, shard, first in _shards(batches, "text", bench):
            keys = [k for b in held for k in b.column("row").field("key").to_pylist()]
            words, place = shard.longest(bench.words, bench.ends, suffixes)
            best: dict[int, tuple] = {}
            for s in np.flatnonzero(words >= least):
                owner = int(bench.item_of[suffixes[s]])
                if owner not in best or words[s] > best[owner][0]:
                    best[owner] = (int(words[s]), int(suffixes[s]), int(place[s]))
            found = []
            for owner, (count, suffix, at) in best.items():
                doc = int(np.searchsorted(first, at, side="right")) - 1
                found.append({"item": bench.names[owner], "words": count,
                              "item_word": suffix - int(bench.starts[suffix]),
                              "key": keys[doc], "doc_word": int(at - first[doc])})
            yield pa.RecordBatch.from_pylist(found, pa.schema([
                ("item", pa.string()), ("words", pa.int64()), ("item_word", pa.int64()),
                ("key", pa.string()), ("doc_word", pa.int64())]))

    return run


def hit_words(hits: Column) -> Column:
    """Words in a flat list of range starts and ends."""
    signs = F.transform(hits, lambda x, i: F.when(i % 2 == 0, -x).otherwise(x))
    return F.aggregate(signs, F.lit(0).cast("long"), lambda a, x: a + x)


def is_contaminated(n_words: Column, n_hit: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


ORACLE = r"""
WITH doc AS (SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(13, len(w)) AS k,
    array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
    FROM item, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i) WHERE len(w) > 0),
size AS (SELECT DISTINCT k FROM win),
spot AS (SELECT uid, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM doc, size, unnest(range(1, len(w) - k + 2)) AS t(i)),
hit AS (SELECT uid, i, spot.k, item_id FROM spot JOIN win USING (k, g)),
word AS (SELECT uid, count(DISTINCT i + j) AS n_hit FROM hit, unnest(range(k)) AS t(j) GROUP BY uid),
named AS (SELECT uid, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY
    CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT uid, item_id FROM hit) GROUP BY uid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
    coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN word USING (uid) LEFT JOIN named USING (uid)
"""


@query("op4_decontamination", ORACLE)
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_contamination(as_rows(docs), table(spark, sf_dir, "benchmark"))
    n_hit = hit_words(F.col("result.hits"))
    return found.select(
        "row.doc_id", "result.n_words", n_hit.alias("n_hit"),
        (F.size("result.items") + F.col("result.nameless").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("result.items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated(F.col("result.n_words"), n_hit).alias("contaminated"),
    )


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents of which a twentieth or more of the words lie
    in windows of the benchmark go."""
    found = find_contamination(as_rows(docs), table(spark, sf_dir, "benchmark"))
    bad = is_contaminated(F.col("result.n_words"), hit_words(F.col("result.hits")))
    return found.filter(~bad).select("row.*")
