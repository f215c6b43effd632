"""Registration of queries with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weirflow.session import configure

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                return function(configure(spark), sf_dir)

            run.__name__ = name
            run.__doc__ = function.__doc__
            self.queries[name] = run
            if oracle is not None:
                self.oracles[name] = oracle
            return function

        return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
