"""Best-fit packing of tokenised documents into sequences.

Which pieces share a sequence depends on their lengths alone, and lengths are
whole numbers up to the capacity. So the plan is made from a histogram of at
most `capacity` counts, whatever the table's size, in classes of like bins:

1. Pieces above one third of the capacity fit at most twice into a bin. Longest
   first, each takes the longest partner that still fits (greedy matching,
   which gives the fewest bins for such pieces).
2. Smaller pieces, longest first, go to the bins with the tightest gap that
   holds them; new bins are opened only when none does.

Every piece then finds its bin by its rank among the pieces of its length. The
ranks are counted within the tasks that tokenise and offset by prefix sums, so
no length, however frequent, is gathered in one place.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from weirflow.llm.common import query
from weirflow.plans.registry import table
from weirflow.workspace import materialize

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 400_000
CACHED_CHARS = 48

#: Separators that Python's split() knows but the tokenizer doesn't.
_OTHER_SPACE = re.compile("[\x1c-\x1f]")
#: Characters of which a run behind letters is a piece of its own.
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
#: Letters below this are letters to Python and the tokenizer alike.
_LATIN_END = "\u0250"
_WORD_END = "</w>"
#: Beyond those letters, or longer in lower case.
_UNLIKE = re.compile(f"[{_LATIN_END}-\U0010ffff\u0130]")
#: Marks behind a letter or digit at the end of a word of a lower-case text.
_TAIL = re.compile(r"[!-/:-@\[-`{-~](?<=[0-9a-zß-öø-ɏ][!-/:-@\[-`{-~])[!-/:-@\[-`{-~]*(?!\S)")
#: (length, task) counts up to which they are sent to all tasks: about 10 MB.
BROADCAST_ROWS = 400_000


class WordTokenizer:
    """Ids by a tokenizer that never joins characters across white space, nor
    letters to the marks behind them.

    Texts of Latin letters are put in lower case and the marks at the ends of their
    words set apart first, which changes no id and leaves far fewer different words.
    Every word is encoded once and remembered. New words of Latin letters are
    encoded together: each is one piece, and the ids are cut behind those that
    end a piece. All others are encoded one by one.
    """

    def __init__(self, vocabulary: str | None) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        if vocabulary is None:
            import public_tokenizers

            vocabulary = public_tokenizers.path(VOCABULARY)
        self.tokenizer = Tokenizer.from_file(vocabulary)
        # For lower-case Latin letters between blanks, normalising and splitting
        # change nothing, so the same merges are run without them.
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
        ])
        size = self.tokenizer.get_vocab_size()
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(_WORD_END)
                              for i in range(size)])
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.lower() for token in added]
        self.words: dict[str, bytes] = {}
        self.letters: dict[str, bytes] = {}
        self.long: list[str] = []

    def _encode(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, np.uint32).tobytes()

    def _encode_letters(self, words: list[str], known: dict[str, bytes]) -> None:
        """Add words of Latin letters, encoded in one call, to those known."""
        if not words:
            return
        # The fast form leaves out the pieces' places in the text.
        (found,) = self.bare.encode_batch_fast([" ".join(words)], add_special_tokens=False)
        ids = np.array(found.ids, np.uint32)
        cuts = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(cuts) == len(words):
            data = ids.tobytes()
            known.update(zip(words, map(data.__getitem__, map(slice, [0, *cuts], cuts))))
        else:
            known.update((w, self._encode(w)) for w in words)

    def _plain(self, text: str) -> str:
        """The text with fewer different words, if that changes no id."""
        if _UNLIKE.search(text):
            return text
        low = text.lower()
        if any(token in low for token in self.added):
            return text
        return _TAIL.sub(r" \g<0>", low)

    def learn(self, texts: list[str]) -> list[list[str]]:
        """Encode the words of some texts that aren't known yet; returns the
        words of each text."""
        split = [self._plain(text).split() for text in texts]
        new: set[str] = set().union(*split)
        if len(self.words) + len(new) > CACHED_WORDS:
            # What these texts use again is kept.
            self.words = {w: self.words[w] for w in new.intersection(self.words)}
        if len(self.letters) > CACHED_WORDS:
            self.letters = {}
        new.difference_update(self.words)
        plain = [w for w in new if len(w) <= CACHED_CHARS and w.isascii() and w.isalpha() and w.islower()]
        self._encode_letters(plain, self.words)
        new.difference_update(plain)
        parts, single = [], []
        for word in new:
            core = word.rstrip(_MARKS)
            low = core.lower()
            if core.isalpha() and len(core) <= CACHED_CHARS and (
                core.isascii() or max(core) < _LATIN_END and len(low) == len(core)
            ):
                parts.append((word, low, word[len(core):]))
            else:
                single.append(word)
        letters = self.letters
        self._encode_letters([w for w in {p[1] for p in parts} if w not in letters], letters)
        tails = {"": b""}
        for word, core, tail in parts:
            if tail not in tails:
                tails[tail] = self._encode(tail)
            self.words[word] = letters[core] + tails[tail]
        for word in single:
            self.words[word] = self._encode(word)
        self.long += [w for w in new if len(w) > CACHED_CHARS]
        return split

    def ids(self, text: str, words: list[str]) -> np.ndarray:
        """Ids of a text whose words are known."""
        if _OTHER_SPACE.search(text):
            return np.frombuffer(self._encode(text), np.uint32)
        return np.frombuffer(b"".join(map(self.words.__getitem__, words)), np.uint32)

    def forget_long(self) -> None:
        """Drop words that aren't worth their memory."""
        for word in self.long:
            self.words.pop(word, None)
        self.long = []


@lru_cache(maxsize=1)
def word_tokenizer(vocabulary: str | None) -> WordTokenizer:
    """The tokenizer of a worker process, which keeps its words from task to task."""
    return WordTokenizer(vocabulary)


PIECES = "doc_id long, piece int, start long, length long, ids binary, task int, place long"


def _tokenise(capacity: int, end_id: int, vocabulary: str | None):
    def run(batches):
        tokenizer = word_tokenizer(vocabulary)
        task = TaskContext.get().partitionId()
        seen: Counter[int] = Counter()  # pieces of each length in this task
        for batch in batches:
            rows = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            docs = batch.column("doc_id").to_pylist()
            for doc, text, words in zip(docs, texts, tokenizer.learn(texts)):
                ids = np.append(tokenizer.ids(text, words), np.uint32(end_id)).astype("<u4")
                for number, start in enumerate(range(0, len(ids), capacity)):
                    own = ids[start : start + capacity]
                    rows.append((doc, number, start, len(own), own.tobytes(), task, seen[len(own)]))
                    seen[len(own)] += 1
            tokenizer.forget_long()
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
            columns = zip(*rows) if rows else [()] * len(kinds)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, kinds)],
                names=[c.split()[0] for c in PIECES.split(", ")],
            )

    return run


@dataclass
class _Bins:
    """`count` like bins: lengths in them with how many of each, and the gap."""

    count: int
    gap: int
    content: tuple[tuple[int, int], ...]

    def with_pieces(self, bins: int, length: int, each: int) -> _Bins:
        return _Bins(bins, self.gap - length * each, (*self.content, (length, each)))


class _Open:
    """Bin classes by gap, tightest first."""

    def __init__(self) -> None:
        self.gaps: list[int] = []
        self.by_gap: dict[int, list[_Bins]] = {}

    def add(self, bins: _Bins) -> None:
        if bins.count:
            if bins.gap not in self.by_gap:
                insort(self.gaps, bins.gap)
                self.by_gap[bins.gap] = []
            self.by_gap[bins.gap].append(bins)

    def tightest(self, length: int) -> _Bins | None:
        """Take out a class with the smallest gap that holds `length`."""
        i = bisect_left(self.gaps, length)
        if i == len(self.gaps):
            return None
        gap = self.gaps[i]
        bins = self.by_gap[gap].pop()
        if not self.by_gap[gap]:
            del self.by_gap[gap], self.gaps[i]
        return bins

    def all(self) -> list[_Bins]:
        return [b for gap in self.gaps for b in self.by_gap[gap]]


def match_large(sizes: Counter[int], capacity: int) -> list[_Bins]:
    """Pair pieces above one third of the capacity, longest first, each with the
    longest that fits beside it."""
    left = {s: n for s, n in sizes.items() if n}
    order = sorted(left)
    bins = []
    while order:
        size = order[-1]
        count = left[size]
        fits = bisect_left(order, capacity - size + 1) - 1
        if fits < 0:
            bins.append(_Bins(count, capacity - size, ((size, 1),)))
            used = {size: count}
        elif order[fits] == size:
            pairs, single = divmod(count, 2)
            bins.append(_Bins(pairs, capacity - 2 * size, ((size, 2),)))
            # A single one is left for the next round and pairs with a shorter one.
            used = {size: 2 * pairs} if pairs else {size: 1}
            if not pairs:
                shorter = order[fits - 1] if fits else None
                content = ((size, 1), (shorter, 1)) if shorter else ((size, 1),)
                bins.append(_Bins(single, capacity - size - (shorter or 0), content))
                if shorter:
                    used[shorter] = 1
        else:
            partner = order[fits]
            pairs = min(count, left[partner])
            bins.append(_Bins(pairs, capacity - size - partner, ((size, 1), (partner, 1))))
            used = {size: pairs, partner: pairs}
        for s, n in used.items():
            left[s] -= n
            if not left[s]:
                order.remove(s)
    return [b for b in bins if b.count]


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[_Bins]:
    """Bin classes for the given number of pieces of each length."""
    opened = _Open()
    large = Counter({s: n for s, n in histogram.items() if 3 * s > capacity})
    for bins in match_large(large, capacity):
        opened.add(bins)
    for size in sorted((s for s in histogram if 3 * s <= capacity), reverse=True):
        left = histogram[size]
        while left:
            bins = opened.tightest(size) or _Bins(left, capacity, ())
            each = bins.gap // size
            full = min(bins.count, left // each)
            left -= full * each
            rest = bins.count - full
            if full:
                opened.add(bins.with_pieces(full, size, each))
            if rest and left:  # fewer than `each` are left: one bin takes them
                opened.add(bins.with_pieces(1, size, left))
                left, rest = 0, rest - 1
            if rest and bins.content:
                opened.add(_Bins(rest, bins.gap, bins.content))
    return opened.all()


PLAN = ("length", "rank", "bin", "each", "offset")


def plan_places(bins: list[_Bins]) -> np.ndarray:
    """Rows of `PLAN`, sorted: from `rank` on, pieces of `length` go to the bins
    from `bin` on, `each` to a bin, the first of them at `offset`."""
    ranks: Counter[int] = Counter()
    rows, first = [], 0
    for group in bins:
        offset = 0
        for length, each in group.content:
            rows.append((length, ranks[length], first, each, offset))
            ranks[length] += each * group.count
            offset += length * each
        first += group.count
    return np.array(sorted(rows), np.int64).reshape(-1, len(PLAN))


def _place(shared):
    def run(batches):
        plan = shared.value
        capacity = int(plan[:, 0].max()) + 1 if len(plan) else 1
        starts = np.searchsorted(plan[:, 0], np.arange(capacity + 1))
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("place").to_numpy() + batch.column("before").to_numpy()
            row = np.zeros(len(length), np.int64)
            for size in np.unique(length):
                mine = length == size
                own = plan[starts[size] : starts[size + 1], 1]
                row[mine] = starts[size] + np.searchsorted(own, rank[mine], side="right") - 1
            _, from_rank, first, each, offset = plan[row].T
            step = rank - from_rank
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids")),
                 pa.array(first + step // each), pa.array(offset + step % each * length)],
                names=["doc_id", "piece", "start", "length", "ids", "sequence_id", "offset"],
            )

    return run


def pack_documents(
    docs: DataFrame,
    *,
    text: str = "text",
    key: str = "doc_id",
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    vocabulary: str | None = None,
) -> DataFrame:
    """Pieces of all documents with their place in a sequence: doc_id, piece,
    start, length, ids, sequence_id, offset. `ids` holds the piece's token ids, four
    bytes each, the lowest first; a sequence is its pieces' ids by `offset`.

    A null or empty text is the end id alone. Only a document longer than the
    capacity is cut. Rows may repeat, and each is packed. `vocabulary` is the
    tokenizer's file on the executors; None takes the public one.

    The driver gets the histogram of lengths (up to `capacity` rows) and makes
    the plan; the plan is sent to all tasks. A small length adds at most three
    bin classes and a bin's content at most capacity / length entries, so the
    plan's size depends on the capacity, not on the number of documents.
    """
    pieces = materialize(
        docs.select(docs[key].cast("long").alias("doc_id"), docs[text].alias("text"))
        .mapInArrow(_tokenise(capacity, end_id, vocabulary), PIECES),
        "pieces",
    )
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = materialize(
        counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "ranks"
    )
    histogram = {
        r["length"]: r["n"] for r in before.groupBy("length").agg(F.sum("n").alias("n")).collect()
    }
    shared = docs.sparkSession.sparkContext.broadcast(plan_places(plan_bins(histogram, capacity)))
    offsets = before.drop("n")
    if before.count() <= BROADCAST_ROWS:  # beyond, pieces and offsets are shuffled
        offsets = F.broadcast(offsets)
    return pieces.join(offsets, ["length", "task"]).mapInArrow(
        _place(shared),
        "doc_id long, piece int, start long, length long, ids binary, "
        "sequence_id long, offset long",
    )


@query("op1_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last one: the packed pieces of what is left, with their
    ids and a checksum of them."""
    return pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))
