"""Token counts by a count-only Viterbi search.

An Aho-Corasick automaton lists every vocabulary piece that ends at each
character; dynamic programming keeps, per end, only the best score and the number
of pieces on its path. No token is ever written down.

The result equals that of a unigram tokenizer with the same pieces and scores
over the whole text: a blank is "▁", and one is put before a text without,
unknown characters take the lowest score minus 10 and count by their bytes, and
of equal scores the path whose last piece starts first is taken. Texts are cut
only where no piece of the vocabulary can match across: before a run of "▁", if
no piece holds a "▁" behind another character. Sums of scores are exact for whole
numbers; others may round differently from those over an uncut text.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, map_rows, query, texts_of
from weirflow.plans.registry import table

VOCABULARY = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
CACHED_WORDS = 200_000
CACHED_CHARS = 64

_INNER_SPACE = re.compile(f"[^{SPACE}]{SPACE}")
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
RESULT = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("score", T.DoubleType()),
])


def read_vocabulary(path: str | None) -> list[tuple[str, float]]:
    """Pieces and scores of a vocabulary file; None takes the public one."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class TokenCounter:
    def __init__(self, vocabulary: list[tuple[str, float]]) -> None:
        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary:
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min(score for _, score in vocabulary) - UNKNOWN_PENALTY
        self.cuts = not any(_INNER_SPACE.search(piece) for piece, _ in vocabulary)
        self.known: dict[str, tuple[int, float]] = {}

    def best(self, word: str) -> tuple[int, float]:
        """(pieces, score) of the best path over a stretch of text."""
        size = len(word)
        scores, counts = [0.0] * (size + 1), [0] * (size + 1)
        # Pieces that end at each place, the longest first.
        ending: list[list[tuple[int, float]]] = [[] for _ in range(size)]
        for end, piece in self.automaton.iter(word):
            ending[end].append(piece)
        for end in range(size):
            best, count, single = None, 0, False
            for length, score in sorted(ending[end], reverse=True):
                single = single or length == 1
                start = end + 1 - length
                total = scores[start] + score
                if best is None or total > best:
                    best, count = total, counts[start] + 1
            if not single:
                total = scores[end] + self.unknown
                if best is None or total > best:
                    best, count = total, counts[end] + len(word[end].encode())
            scores[end + 1], counts[end + 1] = best, count
        return counts[size], scores[size]

    def count(self, text: str) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        spaced = text.replace(" ", SPACE)
        spaced = spaced if spaced[0] == SPACE else SPACE + spaced
        tokens, score = 0, 0.0
        for word in _WORD.findall(spaced) if self.cuts else [spaced]:
            found = self.known.get(word)
            if found is None:
                found = self.best(word)
                if len(word) <= CACHED_CHARS:
                    if len(self.known) >= CACHED_WORDS:
                        self.known.clear()
                    self.known[word] = found
            tokens += found[0]
            score += found[1]
        return tokens, score


@lru_cache(maxsize=2)
def counter_of(vocabulary: str | None) -> TokenCounter:
    """The counter of a vocabulary file, with the words it knows, kept from task
    to task of a worker."""
    return TokenCounter(read_vocabulary(vocabulary))


def count_tokens(
    rows: DataFrame, *, text: str = "text", vocabulary: str | None = None
) -> DataFrame:
    """Add `result` (n_tokens, score of the best segmentation) to a table of
    `row` structs. Null and empty texts have 0 tokens and score 0; nothing is
    shuffled, and repeated rows are counted each. `vocabulary` is a file on the
    executors."""

    def run(batches):
        counter = counter_of(vocabulary)
        for batch in batches:
            found = [counter.count(t or "") for t in texts_of(batch, text)]
            yield batch.column("row"), pa.StructArray.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()),
                 pa.array([s for _, s in found], pa.float64())],
                names=["n_tokens", "score"],
            )

    return map_rows(rows, run, RESULT)


@query("op8_token_counts")
def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(as_rows(docs)).select(F.col("row.doc_id"), "result.n_tokens", "result.score")
