"""Collocations: phrases of two to five words that stand together more often
than their parts would by chance.

Words become 64-bit ids, a hash of language and word. A table of all words with
their counts proves that no two share an id; if two do, the next seed is taken.
A phrase can't be frequent if one of its words or pairs of neighbours is not, so
pairs of frequent words are counted first and longer windows end where a pair is
too rare. Fixed bitmaps of the frequent words' and pairs' hashes tell the tasks
which: they may keep a rare one, which costs work, but never drop a frequent one.

Every task counts its windows, first of two and then of up to five words, in a
HAT-trie: hash containers of window tails under a shallow trie of first words. A
container that grows large bursts into one per next word. When the trie holds too
many entries, whole subtrees are spilled as sorted runs, largest first, each run
cut by prefix partition. The runs of a partition are merged in one task, and the
count of a phrase is the sum over all windows that begin with it, a subtree of the
trie.

A prefix partition holds windows with the same first three words (pairs: two). If
all are among the thousand most frequent words, the fourth word decides too, and
so on, so that no partition hangs on one frequent prefix. A phrase of such words
only may then have its count in several partitions, and these are summed up after.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirflow.llm.common import mixed, query
from weirflow.plans.registry import table
from weirflow.workspace import materialize

# Fixed values of the contract.
LEAST = 100
WIDTH = 5
TOP = 2000
NO_LANGUAGE = "und"
BLANKS = b" \t"
ENDS = b".,;:!?\n\v\f\r"

TOP_BUCKETS = 64

_POWER = 0x9E3779B97F4A7C15
_INVERSE = pow(_POWER, -1, 1 << 64)
_KIND = np.zeros(256, np.uint8)
_KIND[list(BLANKS)] = 1
_KIND[list(ENDS)] = 2


@dataclass(frozen=True)
class Limits:
    """Sizes that bound memory; results don't hang on them. `entries` of a task's
    trie, of which a container bursts above `burst`; words that are more than one in
    `hot_words` of all deepen the prefix partitions, of which there is one per
    `partition_windows` words."""

    chunk_bytes: int = 1 << 21
    bitmap_bits: int = 1 << 25
    burst: int = 4096
    entries: int = 1 << 20
    hot_words: int = 1024
    partition_windows: int = 1 << 20


def byte_values(seed: int) -> np.ndarray:
    """A random number for every byte; capital A to Z have those of a to z."""
    values = np.random.default_rng(seed).integers(0, 1 << 64, 256, np.uint64)
    values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


@lru_cache(maxsize=4)
def _powers_of(base: int, bits: int) -> np.ndarray:
    result = np.full(1 << bits, base, np.uint64)
    result[0] = 1
    return np.cumprod(result, dtype=np.uint64)


def _powers(base: int, n: int) -> np.ndarray:
    return _powers_of(base, n.bit_length())[:n]


class Words:
    """The words of a batch of texts, in order: `ids`, `start` and `end` bytes in
    `data`, `row` of the batch, and `piece`, a number that changes between words
    of different pieces or texts."""

    def __init__(
        self, languages: list[str], texts: pa.Array, values: np.ndarray, chunk_bytes: int
    ) -> None:
        self.chunk_bytes = chunk_bytes
        texts = texts.fill_null("").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        held = texts.buffers()[2]
        data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
        self.data = data[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        marks = {x: int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "big")
                 for x in set(languages)}
        marks = np.array([marks[x] for x in languages], np.uint64)
        found, at, ends = [], 0, 0
        starts_of_texts = bounds[:-1][bounds[:-1] < bounds[1:]]
        while at < len(self.data):
            stop = self._stop(at, starts_of_texts)
            first, end, piece, more = self._chunk(at, stop, starts_of_texts)
            hashes = self._hashes(at, stop, first, end, values)
            row = np.searchsorted(bounds, first + at, "right") - 1
            ids = mixed(hashes ^ marks[row])
            ids[ids == 0] = 1
            found.append((ids, first + at, end + at, row, piece + ends + row))
            at, ends = stop, ends + more
        parts = zip(*found) if found else [[np.zeros(0, t)] for t in (np.uint64, *[np.int64] * 4)]
        self.ids, self.start, self.end, self.row, self.piece = map(np.concatenate, parts)

    def _stop(self, at: int, starts: np.ndarray) -> int:
        """The end of a chunk, at a byte of no word or the start of a text."""
        step = self.chunk_bytes
        stop = at + step
        while stop < len(self.data):
            ahead = np.flatnonzero(_KIND[self.data[stop : stop + step]])
            text = int(np.searchsorted(starts, stop))
            after = int(starts[text]) if text < len(starts) else len(self.data)
            if len(ahead):
                return min(stop + int(ahead[0]), after)
            if after <= stop + step:
                return after
            stop += step
        return len(self.data)

    def _chunk(self, at, stop, starts):
        kind = _KIND[self.data[at:stop]]
        inside = kind == 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        cuts = starts[(starts > at) & (starts < stop)] - at
        begins[cuts] = inside[cuts]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:]
        ends[cuts - 1] = inside[cuts - 1]
        marks = np.cumsum(kind == 2)
        first = np.flatnonzero(begins)
        return first, np.flatnonzero(ends) + 1, marks[first], int(marks[-1])

    def _hashes(self, at, stop, first, end, values):
        """Polynomial hashes from one running sum over the chunk; the inverse
        power takes a word's place out."""
        sums = np.zeros(stop - at + 1, np.uint64)
        np.cumsum(values[self.data[at:stop]] * _powers(_POWER, stop - at), out=sums[1:])
        return (sums[end] - sums[first]) * _powers(_INVERSE, stop - at)[first]

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().lower().decode()


def _count_words(values: np.ndarray, limits: Limits):
    def run(batches):
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            words = Words(languages, batch.column("text"), values, limits.chunk_bytes)
            ids, at, counts = np.unique(words.ids, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_pydict({
                "id": pa.array(ids.view(np.int64)),
                "lang": [languages[r] for r in words.row[at].tolist()],
                "word": [words.text(i) for i in at.tolist()],
                "n": pa.array(counts),
            })

    return run


def word_table(docs: DataFrame, limits: Limits) -> tuple[DataFrame, np.ndarray]:
    """(id, lang, word, n) of all words, and the values of bytes under which ids are
    unique."""
    seed = 0
    while True:
        values = byte_values(seed)
        counted = docs.mapInArrow(_count_words(values, limits), "id long, lang string, word string, n long")
        words = materialize(counted.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "words")
        if words.groupBy("id").count().filter("count > 1").isEmpty():
            return words, values
        seed += 1


class HatTrie:
    """Counts of windows of `width` ids. The root maps a first word to a container,
    that is a hash table of the other ids, or, once that has burst, to a node of
    containers by second word. `spill` gives whole subtrees back as sorted rows."""

    def __init__(self, width: int, burst: int) -> None:
        self.width, self.burst = width, burst
        self.root: dict[int, Counter | dict[int, Counter]] = {}
        self.entries = 0
        self.sizes: Counter = Counter()

    def add(self, windows: np.ndarray) -> None:
        if not len(windows):
            return
        keys = windows[:, :1] if self.width == 2 else windows[:, 1::-1]
        windows = windows[np.lexsort(keys.T)]
        tails = [_tails(windows, depth) for depth in range(1, min(3, self.width))]
        new_first = np.flatnonzero(np.diff(windows[:, 0], prepend=~windows[:1, 0])).tolist()
        second = windows[:, 1]
        for start, end in zip(new_first, [*new_first[1:], len(windows)]):
            word = int(windows[start, 0])
            node = self.root.get(word)
            before = self.sizes[word]
            if node is None:
                node = self.root[word] = Counter()
            if isinstance(node, Counter):
                node.update(tails[0][start:end])
                size = len(node)
                if size > self.burst and self.width > 2:
                    self.root[word] = _burst(node)
            else:
                size = before
                own = second[start:end]
                cuts = (np.flatnonzero(own[1:] != own[:-1]) + start + 1).tolist()
                for s, e in zip([start, *cuts], [*cuts, end]):
                    child = node.setdefault(int(second[s]), Counter())
                    size -= len(child)
                    child.update(tails[1][s:e])
                    size += len(child)
            self.sizes[word] = size
            self.entries += size - before

    def spill(self, keep: int) -> tuple[np.ndarray, np.ndarray]:
        """Take out the largest subtrees until at most `keep` entries are left;
        (windows, counts) sorted by ids."""
        rows, counts = [np.zeros((0, self.width), np.uint64)], [np.zeros(0, np.int64)]
        for word, size in self.sizes.most_common():
            if self.entries <= keep:
                break
            for head, container in _containers(word, self.root.pop(word)):
                ids = np.frombuffer(b"".join(container), np.uint64).reshape(len(container), -1)
                first = np.broadcast_to(np.array(head, np.uint64), (len(container), len(head)))
                rows.append(np.hstack([first, ids]))
                counts.append(np.fromiter(container.values(), np.int64, len(container)))
            self.entries -= size
            del self.sizes[word]
        rows, counts = np.concatenate(rows), np.concatenate(counts)
        order = np.lexsort(rows.T[::-1])
        return rows[order], counts[order]


def _tails(windows: np.ndarray, depth: int) -> list[bytes]:
    tails = np.ascontiguousarray(windows[:, depth:])
    return tails.view(f"V{8 * tails.shape[1]}").ravel().tolist()


def _burst(container: Counter) -> dict[int, Counter]:
    node: dict[int, Counter] = {}
    for tail, n in container.items():
        node.setdefault(int.from_bytes(tail[:8], "little"), Counter())[tail[8:]] = n
    return node


def _containers(word: int, node) -> Iterator[tuple[tuple[int, ...], Counter]]:
    if isinstance(node, Counter):
        yield (word,), node
    else:
        for second, container in node.items():
            yield (word, second), container


@dataclass(frozen=True)
class Counting:
    """What the tasks of one counting know: the lengths of phrases they count, from
    `shortest` to `width`, the bitmaps of frequent words and, for phrases above two
    words, pairs, the frequent words that deepen prefixes, and the partitions."""

    shortest: int
    width: int
    values: np.ndarray
    words: np.ndarray
    pairs: np.ndarray | None
    hot: np.ndarray
    partitions: int
    least: int
    limits: Limits


def marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    cells = bitmap[(hashes >> np.uint64(6)) & np.uint64(len(bitmap) - 1)]
    return (cells >> (hashes & np.uint64(63))) & np.uint64(1) == 1


def pair_hash(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return mixed(first ^ mixed(second))


def windows_of(words: Words, task: Counting) -> np.ndarray:
    """For every place the window of up to `width` frequent words of one piece, zero
    where it ends before; windows below the shortest phrase are left out."""
    often = marked(task.words, words.ids)
    ids, piece = words.ids[often], (words.piece + np.cumsum(~often))[often]
    if task.pairs is not None:
        rare = ~marked(task.pairs, pair_hash(ids[:-1], ids[1:]))
        piece[1:] += np.cumsum(rare)
    result = np.zeros((len(ids), task.width), np.uint64)
    result[:, 0] = ids
    for j in range(1, task.width):
        same = piece[j:] == piece[:-j]
        result[: len(ids) - j, j][same] = ids[j:][same]
    return result[result[:, task.shortest - 1] != 0]


def partition_of(rows: np.ndarray, task: Counting) -> np.ndarray:
    """The prefix partition of every window; see the module's text."""
    mark = np.zeros(len(rows), np.uint64)
    deeper = np.ones(len(rows), bool)
    for j in range(task.width):
        longer = mixed(mark ^ mixed(rows[:, j]))
        if j < task.shortest:
            mark = longer
        else:
            deeper &= rows[:, j] != 0
            mark = np.where(deeper, longer, mark)
        deeper &= np.isin(rows[:, j], task.hot)
    return (mark % np.uint64(task.partitions)).astype(np.int64)


def pack_run(rows: np.ndarray, counts: np.ndarray) -> bytes:
    """A sorted run as compressed columns."""
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.ascontiguousarray(c)) for c in (*rows.T, counts)],
        names=[*map(str, range(rows.shape[1])), "n"],
    )
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_run(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    run = pa.ipc.open_stream(data).read_all()
    return np.column_stack([c.to_numpy() for c in run.columns[:-1]]), run["n"].to_numpy()


def _runs(rows, counts, task: Counting) -> Iterator[pa.RecordBatch]:
    part = partition_of(rows, task)
    order = np.argsort(part, kind="stable")
    part, rows, counts = part[order], rows[order], counts[order]
    starts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    for s, e in zip(starts, [*starts[1:], len(part)]):
        run = pack_run(rows[s:e], counts[s:e])
        yield pa.RecordBatch.from_pydict(
            {"part": pa.array([int(part[s])], pa.int32()), "run": pa.array([run], pa.binary())}
        )


def _count_windows(task: Counting):
    limits = task.limits
    step, keep = max(1, limits.entries // 4), limits.entries // 2

    def run(batches):
        trie = HatTrie(task.width, limits.burst)
        for batch in batches:
            languages = batch.column("lang").to_pylist()
            words = Words(languages, batch.column("text"), task.values, limits.chunk_bytes)
            windows = windows_of(words, task)
            for s in range(0, len(windows), step):
                trie.add(windows[s : s + step])
                if trie.entries > limits.entries:
                    yield from _runs(*trie.spill(keep), task)
        yield from _runs(*trie.spill(0), task)

    return run


def merge_runs(runs: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs as one; equal windows are summed up."""
    rows, counts = (np.concatenate(x) for x in zip(*runs))
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    starts = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(axis=1)])
    return rows[starts], np.add.reduceat(counts, starts)


def phrase_counts(rows, counts, task: Counting) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(phrases, counts) of each length, from a partition's sorted windows: the sums
    over windows with the same beginning. A phrase of hot words only may have more
    of its windows elsewhere, so it is given whatever its count."""
    spread = np.ones(len(rows), bool)
    new = np.zeros(len(rows), bool)
    new[:1] = True
    for depth in range(1, task.width + 1):
        column = rows[:, depth - 1]
        new[1:] |= column[1:] != column[:-1]
        spread &= np.isin(column, task.hot)
        if depth < task.shortest:
            continue
        starts = np.flatnonzero(new)
        sums = np.add.reduceat(counts, starts)
        wanted = (column[starts] != 0) & ((sums >= task.least) | (spread[starts] & (depth < task.width)))
        yield rows[starts[wanted], :depth], sums[wanted]


def _merge(task: Counting):
    def of_part(held):
        for phrases, sums in phrase_counts(*merge_runs(held), task):
            offsets = np.arange(len(phrases) + 1, dtype=np.int32) * np.int32(phrases.shape[1])
            values = pa.array(np.ascontiguousarray(phrases).ravel().view(np.int64))
            pair = pair_hash(phrases[:, 0], phrases[:, 1]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(sums), pa.array(pair)],
                names=["ids", "a", "pair"],
            )

    def run(batches):
        held, current = [], None
        for batch in batches:
            for part, data in zip(batch.column("part").to_pylist(), batch.column("run")):
                if held and part != current:
                    yield from of_part(held)
                    held = []
                current = part
                held.append(unpack_run(data.as_buffer()))
        if held:
            yield from of_part(held)

    return run


def bitmap_of(hashes: DataFrame, bits: int) -> np.ndarray:
    """Bits set for the hashes of a one-column table; at most `bits` / 64 cells reach
    the driver, whatever the number of hashes."""
    (name,) = hashes.columns
    cell = F.pmod(F.shiftrightunsigned(name, 6), F.lit(bits // 64))
    bit = F.expr(f"shiftleft(1L, int({name} & 63))")
    cells = hashes.groupBy(cell.alias("cell")).agg(F.bit_or(bit).alias("bits")).toArrow()
    result = np.zeros(bits // 64, np.int64)
    result[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return result.view(np.uint64)


def _counted(docs: DataFrame, task: Counting) -> DataFrame:
    runs = docs.mapInArrow(_count_windows(task), "part int, run binary")
    merged = (
        runs.repartitionById(task.partitions, "part")
        .sortWithinPartitions("part")
        .mapInArrow(_merge(task), "ids array<long>, a long, pair long")
    )
    return merged.groupBy("ids").agg(F.sum("a").alias("a"), F.max("pair").alias("pair")).filter(
        F.col("a") >= task.least
    )


def count_phrases(
    docs: DataFrame, words: DataFrame, values: np.ndarray, least: int, limits: Limits
) -> DataFrame:
    """(ids, a): all phrases of 2 to WIDTH words with at least `least` occurrences."""
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    often = words.filter(F.col("n") > total // limits.hot_words)
    hot = np.sort(np.array([r["id"] for r in often.select("id").collect()], np.int64).view(np.uint64))
    frequent = bitmap_of(words.filter(F.col("n") >= least).select("id"), limits.bitmap_bits)
    task = Counting(
        shortest=2, width=2, values=values, words=frequent, pairs=None, hot=hot,
        partitions=max(1, -(-total // limits.partition_windows)), least=least, limits=limits,
    )
    pairs = materialize(_counted(docs, task), "pairs")
    known = bitmap_of(pairs.select("pair"), limits.bitmap_bits)
    longer = _counted(docs, replace(task, shortest=3, width=WIDTH, pairs=known))
    return pairs.select("ids", "a").unionByName(longer.select("ids", "a"))


def lowest_scores(phrases: DataFrame, words: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add l, r, n and score: of the cuts the lowest score, then the shortest first
    part. Products are decimals of 38 digits, and the division is whole."""
    known = phrases.select("ids", "a").unionByName(
        words.select(F.array("id").alias("ids"), F.col("n").alias("a"))
    )
    k = F.explode(F.sequence(F.lit(1), F.size("ids") - 1))
    cuts = phrases.select("ids", "a", "lang", k.alias("k")).select(
        "*", F.slice("ids", 1, F.col("k")).alias("head"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"),
    )
    parts = cuts.join(known.select(F.col("ids").alias("head"), F.col("a").alias("l")), "head").join(
        known.select(F.col("ids").alias("tail"), F.col("a").alias("r")), "tail"
    ).join(sizes, "lang")
    number = "decimal(19,0)"
    score = F.expr(
        f"(cast(1000 * cast(a as {number}) * cast(n as {number}) as decimal(38,0))"
        f" div cast(cast(l as {number}) * cast(r as {number}) as decimal(38,0)))"
    ).cast("long")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best")
    return parts.groupBy("lang", "ids", "a", "n").agg(best).select(
        "lang", "ids", "a", "best.l", "best.r", "n", "best.score"
    )


def drop_contained(phrases: DataFrame) -> DataFrame:
    """Without the phrases that never stand outside a longer one. Such a longer one
    has the same count, and so has every phrase between the two, so the phrases
    with one word more are enough to look at."""
    inner = F.explode(F.array(
        F.slice("ids", 1, F.size("ids") - 1), F.slice("ids", 2, F.size("ids") - 1)
    ))
    longer = phrases.filter(F.size("ids") > 2).select(inner.alias("ids"), F.col("a").alias("outer"))
    most = longer.groupBy("ids").agg(F.max("outer").alias("outer"))
    return phrases.join(most, "ids", "left").filter("outer IS NULL OR outer < a").drop("outer")


def mine_collocations(
    docs: DataFrame, *, text: str, lang: str, least: int = LEAST, top: int = TOP,
    limits: Limits = Limits(),
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` collocations of every
    language among phrases of 2 to 5 words with at least `least` occurrences.

    Capital A to Z are lowered; texts fall into pieces at `.,;:!?` and line ends
    and pieces into words at blanks and tabs. A null text is empty and a null
    language is `und`. Every row counts, repeated ones too; texts and words may be
    of any length. Ties go by the count, then by the phrase's bytes. A table
    without a frequent phrase gives no rows. Other columns are not looked at.
    """
    docs = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), docs[text].alias("text")
    )
    words, values = word_table(docs, limits)
    sizes = words.groupBy("lang").agg(F.sum("n").alias("n"))
    counted = materialize(count_phrases(docs, words, values, least, limits), "phrases")
    often = words.filter(F.col("n") >= least)
    spelled = counted.select("ids", "a", F.posexplode("ids").alias("place", "id")).join(
        often.select("id", "lang", "word"), "id"
    ).groupBy("ids", "a").agg(
        F.max("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("place", "word"))).alias("words")
    )
    phrase = F.array_join(F.transform("words", lambda w: w["word"]), " ")
    named = materialize(spelled.select("ids", "a", "lang", phrase.alias("phrase")), "named")
    scored = lowest_scores(named, often, sizes).join(
        drop_contained(named.select("ids", "a", "phrase")).select("ids", "phrase"), "ids"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    bucket = F.pmod(F.xxhash64("ids"), F.lit(TOP_BUCKETS))
    first = F.row_number().over(Window.partitionBy("lang", "bucket").orderBy(*order))
    near = scored.withColumn("bucket", bucket).withColumn("near", first).filter(F.col("near") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return near.withColumn("rank", rank).filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


_CAPITALS, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, '{NO_LANGUAGE}') AS lang, regexp_extract_all(unnest(string_split_regex(
        translate(coalesce(text, ''), '{_CAPITALS}', '{_SMALL}'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
    FROM documents),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
spans AS (
    SELECT lang, w[i:i + k - 1] AS ids, k FROM starts, (SELECT unnest(range(1, {WIDTH + 1})) AS k) t
    WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, ids, k, count(*) AS n FROM spans GROUP BY lang, ids, k HAVING count(*) >= {LEAST}),
size AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
cuts AS (SELECT lang, ids, k, n AS a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scores AS (
    SELECT cuts.lang, cuts.ids, cuts.a, c, x.n AS l, y.n AS r, size.n,
        (1000::HUGEINT * cuts.a * size.n) // (x.n::HUGEINT * y.n) AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.ids = cuts.ids[1:c]
    JOIN f y ON y.lang = cuts.lang AND y.ids = cuts.ids[c + 1:] JOIN size ON size.lang = cuts.lang),
best AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, ids ORDER BY score, c) = 1),
inner_phrases AS (
    SELECT lang, ids[:-2] AS ids, n FROM f WHERE k > 2 UNION ALL SELECT lang, ids[2:], n FROM f WHERE k > 2)
SELECT lang, row_number() OVER o AS rank, array_to_string(ids, ' ') AS phrase, CAST(a AS BIGINT) AS a,
    CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best WHERE NOT EXISTS (
    SELECT 1 FROM inner_phrases i WHERE i.lang = best.lang AND i.ids = best.ids AND i.n >= best.a)
WINDOW o AS (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ids, ' '))
QUALIFY row_number() OVER o <= {TOP}"""


@query("op13_collocations", _SQL)
def collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents"), text="text", lang="lang")
