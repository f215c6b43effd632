"""Documents to packed training sequences: the stages in their order.

Every stage gets what its predecessor kept, written as Parquet and read again.
All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirflow.llm.common import prepare
from weirflow.llm.decontamination import remove_contaminated
from weirflow.llm.language import keep_identified
from weirflow.llm.packing import pack
from weirflow.llm.secret_scan import mask_secrets
from weirflow.llm.simhash import keep_one_of_each
from weirflow.plans.registry import table
from weirflow.session import configure
from weirflow.workspace import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _stage(function: Stage) -> Stage:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return function(prepare(configure(spark)), docs, sf_dir)

    run_stage.__name__, run_stage.__doc__ = function.__name__, function.__doc__
    return run_stage


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _stage(keep_identified)),
    ("near_dedup", _stage(keep_one_of_each)),
    ("decontamination", _stage(remove_contaminated)),
    ("secret_scan", _stage(mask_secrets)),
    ("packing", _stage(pack)),
]

#: Fitted language models, hashing and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
