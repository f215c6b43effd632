"""What the operators of this folder share: registration, rows as structs,
Arrow batches of bounded size, and code points of texts as numbers."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weirflow.plans.registry import Query, Registry
from weirflow.session import ship_package

BATCH_BYTES = "4m"

plans = Registry()


def prepare(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches by bytes and let executors import this package."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    ship_package(spark)
    return spark


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register an `opN_…` query; see `Registry.query`."""

    def add(function: Query) -> Query:
        return plans.query(name, oracle)(lambda spark, sf_dir: function(prepare(spark), sf_dir))

    return add


def as_rows(df: DataFrame) -> DataFrame:
    """All columns as one struct `row`, so that names an operator adds can't
    clash with names the table has."""
    return df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))


def map_rows(
    rows: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple[pa.Array, pa.Array]]],
    result: T.DataType,
) -> DataFrame:
    """Add a struct `result` to a table of `row` structs. The function gets
    Arrow batches and yields (rows, results) of equal lengths."""
    schema = T.StructType([rows.schema["row"], T.StructField("result", result)])

    def run(batches):
        for row, value in function(batches):
            yield pa.RecordBatch.from_arrays([row, value], names=["row", "result"])

    return rows.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str) -> list[str | None]:
    """A text column of the `row` structs."""
    return batch.column("row").field(column).to_pylist()


def in_chunks(sizes: list[int], most: int) -> Iterator[slice]:
    """Slices of consecutive items that hold up to `most` together, or one
    larger item alone."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield slice(start, i)
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser of the 64-bit SplitMix generator: spreads every input bit."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def hash_sample(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """Up to `rows` rows (about so many of a larger table), chosen by a hash of
    the keys over the whole table. The threshold follows from the table's size,
    so each task passes on only its part of the sample."""
    share = min(1.0, rows / max(1, df.count()))
    place = F.pmod(F.xxhash64(F.lit("sample"), *keys), F.lit(1 << 40))
    chosen = df.filter(place < F.lit(int(share * (1 << 40))))
    return chosen.orderBy(place, *keys).limit(rows)
