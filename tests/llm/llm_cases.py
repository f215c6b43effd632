"""Documents with all the odd cases, and stage tests they share."""

from pyspark.sql import types as T

WORDS = "the quick brown fox jumps over a lazy dog near some quiet river bank today".split()


def prose(seed: int, words: int = 60) -> str:
    return " ".join(WORDS[(seed * 7 + i * i + i * seed) % len(WORDS)] + str((seed + i) % 11)
                    for i in range(words))


# Columns named like those the operators add on the way.
CLASHING = ("row", "result", "uid", "fp", "spans", "place", "task", "node", "found")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHING],
])


def odd_documents(spark):
    """Null and empty values, repeated rows and ids, a very long text, extra columns."""
    texts = [
        (1, prose(1), "en"), (1, prose(1), "en"), (2, prose(2), None), (3, None, "en"), (4, "", "en"),
        (None, prose(5), "en"), (None, None, None), (6, " \n\t ", "en"), (7, "12345 ...", "en"),
        (8, prose(8, 30_000), "en"), (9, prose(2), "en"), (9, prose(9), "en"), (10, "é\U0001f600 x", "en"),
    ]
    rows = [(i, t, lang, "src", None if t is None else len(t), *CLASHING) for i, t, lang in texts]
    return spark.createDataFrame(rows, SCHEMA)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def ids(df):
    return sorted((r["doc_id"] for r in df.select("doc_id").collect()), key=lambda x: (x is None, x))
