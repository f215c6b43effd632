"""Language identification with bit-sliced Bloom filters of character n-grams.

Every language has a Bloom filter of the n-grams typical of it. The filters are
bit-sliced: a slot holds one bit per language, so looking an n-gram up in all
filters is one AND of `HASHES` slots and returns the set of languages that
contain it. A text's hits per language are popcounts of those sets over its
n-grams; they are corrected for the hits that chance alone would give, and the
language with the most is taken.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, code_points, in_chunks, map_rows, mixed, query, texts_of
from weirflow.plans.registry import table
from weirflow.workspace import materialize

UNDETERMINED = "und"
SLOT_BITS = 20
HASHES = 2
LANGUAGES_PER_PLANE = 62
TRAINING_DOCUMENTS = 7_500
CHUNK_CHARS = 500_000

RESULT = T.StructType([
    T.StructField("lang_pred", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("known", T.BooleanType()),
])

_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all n-grams of 1 to 3 characters around every letter, the text
    each belongs to, and the number of letters of each text. Other characters
    count as a space, so a word's first and last letters are seen as such."""
    lowered = [t.lower() for t in texts]
    points = code_points(" " + " ".join(lowered) + " ")
    is_letter = letters()[points]
    points = np.where(is_letter, points, 32).astype(np.uint64)
    lengths = np.fromiter((len(t) for t in lowered), np.int64, len(lowered))
    owner = np.repeat(np.arange(len(texts)), lengths + 1)  # from the second space on
    at = np.flatnonzero(is_letter)
    before, here, after = points[at - 1], points[at], points[at + 1]
    base = np.uint64(0x200000)
    grams = np.concatenate([
        here, (before * base + here) * np.uint64(2), (here * base + after) * np.uint64(2),
        ((before * base + here) * base + after) * np.uint64(2) + np.uint64(1),
    ])
    owners = owner[at - 1]
    return mixed(grams), np.tile(owners, 4), np.bincount(owners, minlength=len(texts))


def slots(hashes: np.ndarray) -> list[np.ndarray]:
    mask = np.uint64((1 << SLOT_BITS) - 1)
    return [(hashes >> np.uint64(SLOT_BITS * k)) & mask for k in range(HASHES)]


@dataclass
class LanguageModel:
    """`planes[p][slot]`: bits of the languages 62 p to 62 p + 61."""

    languages: list[str]
    planes: np.ndarray

    def chances(self) -> np.ndarray:
        """False-positive rate of each language's filter."""
        fill = [
            float(np.mean((self.planes[i // LANGUAGES_PER_PLANE]
                           >> np.uint64(i % LANGUAGES_PER_PLANE)) & np.uint64(1)))
            for i in range(len(self.languages))
        ]
        return np.array(fill) ** HASHES

    def hits(self, hashes: np.ndarray, owners: np.ndarray, texts: int) -> np.ndarray:
        """Per language and text, how many n-grams the filter contains."""
        found = np.zeros((len(self.languages), texts))
        at = slots(hashes)
        for p, plane in enumerate(self.planes):
            sets = plane[at[0]]
            for slot in at[1:]:
                sets = sets & plane[slot]
            first = p * LANGUAGES_PER_PLANE
            for i in range(first, min(first + LANGUAGES_PER_PLANE, len(self.languages))):
                has = (sets >> np.uint64(i - first)) & np.uint64(1)
                found[i] = np.bincount(owners, weights=has, minlength=texts)
        return found

    def predict(self, texts: list[str | None]) -> list[dict]:
        """Language, score from 0 to 1 (the language's share of all corrected
        hits), and whether any n-gram was known. Ties go to the language that
        sorts first."""
        whole = [t or "" for t in texts]
        hashes, owners, count = ngrams(whole)
        answer = []
        if not self.languages:
            return [{"lang_pred": UNDETERMINED, "score": 0.0, "known": False} for _ in whole]
        chance = self.chances()[:, None]
        total = np.bincount(owners, minlength=len(whole))
        net = (self.hits(hashes, owners, len(whole)) - chance * total) / np.maximum(
            1 - chance, 1e-9
        )
        net = np.maximum(net, 0.0)
        best, all_hits = net.argmax(axis=0), net.sum(axis=0)
        for i in range(len(whole)):
            if not count[i]:
                answer.append({"lang_pred": UNDETERMINED, "score": 0.0, "known": False})
                continue
            share = float(net[best[i], i] / all_hits[i]) if all_hits[i] > 0 else 0.0
            answer.append({
                "lang_pred": self.languages[best[i]],
                "score": min(1.0, share),
                "known": bool(all_hits[i] > 0),
            })
        return answer


def _count_batches(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        langs = batch.column("lang").to_pylist()
        for part in in_chunks([len(t) for t in texts], CHUNK_CHARS):
            hashes, owners, _ = ngrams(texts[part])
            names = np.array(langs[part], dtype=object)[owners] if len(owners) else np.array([])
            for lang in sorted(set(langs[part])):
                grams, counts = np.unique(hashes[names == lang], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams.view(np.int64)),
                     pa.array(counts, pa.int64())],
                    names=["lang", "gram", "n"],
                )


def fit_languages(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    training_documents: int = TRAINING_DOCUMENTS,
    least_count: int = 3,
    least_share: float = 0.25,
) -> LanguageModel:
    """Learn the filters of all languages in `lang`.

    About `training_documents` documents of every language are used (all, if it
    has fewer), chosen by a hash of `key` and `text` over the whole table, so that
    a rare language is learned at every size. An n-gram enters the filter
    of a language when it occurs `least_count` times there, at `least_share` or
    more of the highest rate it has in any language. Without labelled text the
    model knows no language. The driver gets the language names and at most
    2^20 slots per 62 languages.
    """
    spark = docs.sparkSession
    usable = docs.select(
        docs[key].alias("key"), docs[text].alias("text"), docs[lang].alias("lang")
    ).filter("text is not null and lang is not null")
    # Languages with more documents, and up to which hash theirs are taken.
    limits = {r["lang"]: training_documents * (1 << 40) // r["count"]
              for r in usable.groupBy("lang").count().collect() if r["count"] > training_documents}
    place = F.pmod(F.xxhash64(F.lit("training"), "key", "text"), F.lit(1 << 40))
    sample = usable.select("text", "lang")
    if limits:
        known = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
        sample = usable.filter(place < F.coalesce(known[F.col("lang")], F.lit(1 << 40))).select("text", "lang")
    counted = materialize(
        sample.mapInArrow(_count_batches, "lang string, gram long, n long")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "language-ngrams",
    )
    totals = {r["lang"]: r["n"] for r in
              counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    languages = sorted(totals)
    planes = np.zeros((max(1, -(-len(languages) // LANGUAGES_PER_PLANE)), 1 << SLOT_BITS), np.uint64)
    if languages:
        numbers = spark.createDataFrame(
            [(name, i // LANGUAGES_PER_PLANE, 1 << (i % LANGUAGES_PER_PLANE), totals[name])
             for i, name in enumerate(languages)],
            "lang string, plane int, bit long, total long",
        )
        rates = counted.join(numbers, "lang").withColumn("rate", F.col("n") / F.col("total"))
        highest = rates.groupBy("gram").agg(F.max("rate").alias("highest"))
        typical = rates.join(highest, "gram").filter(
            (F.col("n") >= least_count) & (F.col("rate") >= least_share * F.col("highest"))
        )
        slot = F.explode(F.array(*[
            F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
            for k in range(HASHES)
        ]))
        filled = typical.select("plane", "bit", slot.alias("slot")).groupBy("plane", "slot").agg(
            F.bit_or("bit").alias("bits")
        )
        got = filled.toPandas()
        planes[got["plane"].to_numpy(np.int64), got["slot"].to_numpy(np.int64)] = got[
            "bits"
        ].to_numpy(np.int64).view(np.uint64)
    return LanguageModel(languages, planes)


def identify_languages(
    rows: DataFrame, model: LanguageModel, *, text: str = "text"
) -> DataFrame:
    """Add `result` (lang_pred, score, known) to a table of `row` structs.

    A null text or one without a letter is `und` with score 0. A text none of
    whose n-grams is in a filter has `known` false.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = texts_of(batch, text)
            answers = []
            for part in in_chunks([len(t or "") for t in texts], CHUNK_CHARS):
                answers += shared.value.predict(texts[part])
            yield batch.column("row"), pa.array(
                answers, pa.struct([("lang_pred", pa.string()), ("score", pa.float64()),
                                    ("known", pa.bool_())])
            )

    return map_rows(rows, run, RESULT)


def held_out(key: Column) -> Column:
    """Documents never learned from; a row without an id is not held out."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def may_train(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(3)) != 1


@query("op9_language")
def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit_languages(docs.filter(may_train(F.col("doc_id"))))
    found = identify_languages(as_rows(docs.select("doc_id", "text")), model)
    return found.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"),
        "result.lang_pred", "result.score",
    )


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: documents without a letter, or of which no n-gram is
    known in any learned language, go; all others stay as they are."""
    model = fit_languages(docs.filter(may_train(F.col("doc_id"))))
    found = identify_languages(as_rows(docs), model)
    return found.filter("result.known").select("row.*")
