"""Toxicity severity by cumulative-link ordinal regression on sparse features.

P(grade > k) = sigmoid(w·x - t_k) with thresholds t_0 < t_1 < …: one weight
vector serves all thresholds. Features are whole words and word beginnings,
present, repeated, or making up a share of the text. Those that tell toxic from
other labelled documents apart are chosen by a likelihood-ratio test, so a
document's vector is short.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.llm.common import as_rows, hash_sample, map_rows, query, texts_of
from weirflow.plans.registry import table
from weirflow.workspace import materialize

LABELLED = 40_000
FEATURES = 2_000
LEAST_DOCUMENTS = 5
LEAST_RATIO = 12.0
MARKER_LOG_ODDS = 3.0
#: Marker words from which on a toxic document is of grade 2 and 3.
GRADE_AT = (3, 7)
GRADES = len(GRADE_AT) + 2
LONGEST_WORD = 32
CACHED_WORDS = 200_000

_WORD = re.compile(r"[^\W\d_]+")
RESULT = T.StructType([
    T.StructField("p_toxic", T.DoubleType()), T.StructField("severity", T.IntegerType()),
    T.StructField("expected_severity", T.DoubleType()),
])


def bases(word: str) -> list[str]:
    """A word and its beginnings of 4 to 6 letters. A word of more than
    `LONGEST_WORD` letters stands there by its digest, between two marks that no
    other base or form ends in."""
    whole = word
    if len(word) > LONGEST_WORD:
        whole = f"#{hashlib.blake2b(word.encode(), digest_size=16).hexdigest()}#"
    return [whole] + [word[:k] + "*" for k in (4, 5, 6) if len(word) > k]


def forms(base: str, count: int, words: int) -> list[str]:
    """Features of a base that stands `count` times in a text of `words` words."""
    found = [base]
    if count >= 2:
        found.append(base + "2")
    if count >= 3 and 100 * count >= words:
        found.append(base + "%")
    if count >= 3 and 50 * count >= words:
        found.append(base + "%%")
    return found


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def features(text: str | None) -> set[str]:
    """All features of a text; none of a null or wordless one."""
    words = words_of(text)
    counts: Counter[str] = Counter()
    for word, n in Counter(words).items():
        for base in bases(word):
            counts[base] += n
    return {f for base, n in counts.items() for f in forms(base, n, len(words))}


@dataclass
class SeverityModel:
    """`numbers`: place of each feature in `weights`; thresholds ascend."""

    numbers: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray

    def vectors(self, texts: Iterable[str | None]) -> list[list[int]]:
        """Feature numbers of each text, via the bases that occur in any feature."""
        wanted = {f.rstrip("2%") for f in self.numbers}
        known: dict[str, tuple[str, ...]] = {}
        vectors = []
        for text in texts:
            words = words_of(text)
            counts: Counter[str] = Counter()
            for word, n in Counter(words).items():
                own = known.get(word)
                if own is None:
                    if len(known) >= CACHED_WORDS:
                        known.clear()
                    own = known[word] = tuple(b for b in bases(word) if b in wanted)
                for base in own:
                    counts[base] += n
            found = (f for base, n in counts.items() for f in forms(base, n, len(words)))
            vectors.append(sorted(self.numbers[f] for f in found if f in self.numbers))
        return vectors

    def predict(self, vectors: list[list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """P(grade > 0), the likeliest grade, and the expected grade."""
        margin = np.array([self.weights[v].sum() for v in vectors])
        above = _sigmoid(margin[:, None] - self.thresholds[None, :])
        edges = np.hstack([np.ones((len(margin), 1)), above, np.zeros((len(margin), 1))])
        return above[:, 0], (edges[:, :-1] - edges[:, 1:]).argmax(axis=1), above.sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit_ordinal(
    vectors: list[list[int]], grades: np.ndarray, features: int, levels: int,
    *, penalty: float = 3e-5, steps: int = 1500, rate: float = 0.1,
) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) by penalised maximum likelihood, full gradients with
    adaptive steps. Thresholds are kept in order by fitting the logarithms of
    their differences."""
    rows = np.repeat(np.arange(len(vectors)), [len(v) for v in vectors])
    columns = np.array([f for v in vectors for f in v], np.int64)
    size = len(grades)
    value = np.r_[np.zeros(features), 2.0, np.zeros(levels - 2)]
    first, second = np.zeros_like(value), np.zeros_like(value)
    at_low, at_high = grades > 0, grades < levels - 1
    for step in range(1, steps + 1):
        weights, free = value[:features], value[features:]
        limits = np.cumsum(np.r_[free[0], np.exp(free[1:])])
        margin = np.bincount(rows, weights=weights[columns], minlength=size)
        low = np.where(at_low, _sigmoid(margin - limits[np.maximum(grades - 1, 0)]), 1.0)
        high = np.where(at_high, _sigmoid(margin - limits[np.minimum(grades, levels - 2)]), 0.0)
        chance = np.maximum(low - high, 1e-12)
        up, down = low * (1 - low) / chance, high * (1 - high) / chance
        slope = np.bincount(columns, weights=(down - up)[rows], minlength=features)
        on_limit = np.bincount(np.maximum(grades - 1, 0)[at_low], weights=up[at_low], minlength=levels - 1)
        on_limit -= np.bincount(grades[at_high], weights=down[at_high], minlength=levels - 1)
        tail = np.cumsum(on_limit[::-1])[::-1]
        gradient = np.r_[
            slope / size + penalty * weights, tail[0] / size, tail[1:] * np.exp(free[1:]) / size
        ]
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        value = value - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return value[:features], np.cumsum(np.r_[value[features], np.exp(value[features + 1 :])])


def _count_features(batches):
    for batch in batches:
        counts = {0: Counter(), 1: Counter()}
        for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
            counts[toxic].update(features(text))
        for toxic, found in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(found), pa.string()), pa.array([toxic] * len(found), pa.int32()),
                 pa.array(list(found.values()), pa.int64())],
                names=["feature", "toxic", "n"],
            )


def fit_severity(
    docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id",
    labelled: int = LABELLED,
) -> SeverityModel:
    """Learn from up to `labelled` labelled documents, chosen by a hash of the key
    over all labels.

    The labels say toxic or not; a toxic document's grade is 1, 2 or 3 by how
    many of its words are markers, features far more frequent in toxic than in
    other documents. Rows with a null key, label or text are not used. Without
    labels of both kinds every document gets grade 0. The driver gets at most
    `FEATURES` features and `labelled` short vectors.
    """
    known = labels.select(
        F.col(key).alias("key"), F.col("toxic").cast("int").alias("toxic")
    ).filter("key is not null and toxic in (0, 1)")
    chosen = hash_sample(known, labelled, "key")
    # At most `labelled` rows of two numbers: a bounded broadcast.
    sample = materialize(
        docs.select(docs[key].alias("key"), docs[text].alias("text")).filter("text is not null")
        .join(F.broadcast(chosen), "key").select("text", "toxic"),
        "labelled",
    )
    sizes = {r["toxic"]: r["n"] for r in
             sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    if not bad or not good:
        return SeverityModel({}, np.zeros(0), np.array([40.0] * (GRADES - 1)))
    counts = sample.mapInArrow(_count_features, "feature string, toxic int, n long").groupBy(
        "feature"
    ).agg(F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("a"),
          F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("b"))

    def likelihood(k, n):
        p = k / n
        return F.when(p > 0, k * F.log(p)).otherwise(0.0) + F.when(
            p < 1, (n - k) * F.log(1 - p)
        ).otherwise(0.0)

    a, b, n_a, n_b = F.col("a"), F.col("b"), F.lit(float(bad)), F.lit(float(good))
    ratio = 2 * (likelihood(a, n_a) + likelihood(b, n_b) - likelihood(a + b, n_a + n_b))
    odds = F.log((a + 0.5) / (n_a + 1)) - F.log((b + 0.5) / (n_b + 1))
    strong = (
        counts.filter(F.col("a") + F.col("b") >= LEAST_DOCUMENTS)
        .select("feature", ratio.alias("ratio"), odds.alias("odds"))
        .filter(F.col("ratio") >= LEAST_RATIO)
        .orderBy(F.desc("ratio"), "feature").limit(FEATURES).collect()
    )
    numbers = {r["feature"]: i for i, r in enumerate(strong)}
    markers = {r["feature"] for r in strong
               if r["odds"] >= MARKER_LOG_ODDS and r["feature"][-1] not in "2%"}
    draft = SeverityModel(numbers, np.zeros(len(numbers)), np.zeros(GRADES - 1))

    def vectors(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            marked = [sum(not markers.isdisjoint(bases(w)) for w in words_of(t)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(draft.vectors(texts), pa.list_(pa.int32())),
                 batch.column("toxic"), pa.array(marked, pa.int32())],
                names=["vector", "toxic", "marked"],
            )

    got = sample.mapInArrow(vectors, "vector array<int>, toxic int, marked int").toArrow()
    toxic, marked = got.column("toxic").to_numpy(), got.column("marked").to_numpy()
    grades = np.where(toxic == 1, 1 + np.searchsorted(GRADE_AT, marked, side="right"), 0)
    weights, thresholds = fit_ordinal(
        got.column("vector").to_pylist(), grades, len(numbers), GRADES
    )
    return SeverityModel(numbers, weights, thresholds)


def grade_toxicity(rows: DataFrame, model: SeverityModel, *, text: str = "text") -> DataFrame:
    """Add `result` (p_toxic, severity, expected_severity) to a table of `row`
    structs. Null and wordless texts have no features; nothing is shuffled."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            model = shared.value
            chance, grade, expected = model.predict(model.vectors(texts_of(batch, text)))
            yield batch.column("row"), pa.StructArray.from_arrays(
                [pa.array(chance, pa.float64()), pa.array(grade, pa.int32()),
                 pa.array(expected, pa.float64())],
                names=["p_toxic", "severity", "expected_severity"],
            )

    return map_rows(rows, run, RESULT)


@query("op2_toxicity")
def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's severity; `toxic` where a grade above 0 is likelier than not."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_severity(docs, table(spark, sf_dir, "labels"))
    return grade_toxicity(as_rows(docs), model).select(
        "row.doc_id", "result.p_toxic", "result.severity", "result.expected_severity",
        (F.col("result.p_toxic") >= 0.5).alias("toxic"),
    )
