import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from weirflow.llm.common import prepare  # noqa: E402


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
