"""A named Spark data source for a database table, over any Python DB-API
driver: ``spark.read.format("weir_table")`` and ``df.write.format("weir_table")``.

Options
  driver              DB-API module, e.g. ``psycopg2`` or ``sqlite3``
  url                 first argument of the module's ``connect``
  user, password      passed on when given
  connectOptions      JSON object with further ``connect`` arguments
  tableName           table to read or append to
  columns             comma-separated columns to read (default: the schema)
  partitioningColumn  integer column to cut the scan by
  partitionSize       rows per scan partition; 0 reads in one piece
  tieColumn           integer column that spreads a key filling several partitions
"""

from __future__ import annotations

import importlib
import json
import uuid
from collections.abc import Iterator
from contextlib import closing
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from weirflow.schemas import USERS
from weirflow.session import ship_package
from weirflow.sources.ranges import check_chunking, identifier, range_predicates

FORMAT = "weir_table"
_FETCH = 10_000
_TOKENS_PER_STATEMENT = 500


def register(spark: SparkSession) -> None:
    """Make the format known to the session."""
    ship_package(spark)
    spark.dataSource.register(DatabaseTable)


def execute(options: dict[str, str], statement: str) -> None:
    """Run one DDL statement from the driver in the options' database."""
    _Target.of(options).run(statement)


class DatabaseTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        """Used unless the reader declares one with ``.schema(...)``."""
        return USERS

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(_Target.of(self.options), schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError(f"{FORMAT} appends only")
        return TableWriter(_Target.of(self.options), schema)


@dataclass(frozen=True)
class _Target:
    """Where the table is; small enough to travel with every task."""

    driver: str
    arguments: tuple
    keywords: dict
    table: str

    @classmethod
    def of(cls, options) -> _Target:
        keywords = json.loads(options.get("connectOptions", "{}"))
        for name in ("user", "password"):
            if options.get(name):
                keywords[name] = options[name]
        for name in ("driver", "url", "tableName"):
            if not options.get(name):
                raise ValueError(f"option {name} is missing")
        return cls(
            options["driver"], (options["url"],), keywords, identifier(options["tableName"])
        )

    @property
    def module(self):
        return importlib.import_module(self.driver)

    def connect(self):
        return self.module.connect(*self.arguments, **self.keywords)

    def run(self, *statements: str) -> None:
        """Run statements in one transaction."""
        with closing(self.connect()) as connection:
            cursor = connection.cursor()
            for statement in statements:
                cursor.execute(statement)
            connection.commit()

    def placeholders(self, n: int) -> str:
        style = self.module.paramstyle
        if style == "qmark":
            marks = ["?"] * n
        elif style in ("format", "pyformat"):
            marks = ["%s"] * n
        elif style == "numeric":
            marks = [f":{i + 1}" for i in range(n)]
        else:
            raise ValueError(f"parameter style {style} of {self.driver} is not supported")
        return ", ".join(marks)


@dataclass
class _Chunk(InputPartition):
    predicate: str | None


class TableReader(DataSourceReader):
    def __init__(self, target: _Target, schema: StructType, options) -> None:
        self.target = target
        self.schema = schema
        listed = options.get("columns")
        self.columns = (
            [c.strip() for c in listed.split(",")] if listed else schema.fieldNames()
        )
        if len(self.columns) != len(schema):
            raise ValueError("columns and schema differ in length")
        self.key = options.get("partitioningColumn") or None
        self.size = int(options.get("partitionSize", "0"))
        self.tie = options.get("tieColumn") or None
        check_chunking(self.key, self.size)

    def partitions(self) -> list[InputPartition]:
        """Chunk starts come from the database: it numbers the keys and hands
        back the first key of every chunk, never the keys themselves."""
        if not check_chunking(self.key, self.size):
            return [_Chunk(None)]
        key, table = identifier(self.key), self.target.table
        numbered = (
            f"SELECT {key} AS k, ROW_NUMBER() OVER (ORDER BY {key}) AS rn "
            f"FROM {table} WHERE {key} IS NOT NULL"
        )
        with closing(self.target.connect()) as connection:
            cursor = connection.cursor()
            cursor.execute(
                f"SELECT k FROM ({numbered}) q "
                f"WHERE rn > 1 AND (rn - 1) % {self.size} = 0 ORDER BY k"
            )
            starts = [row[0] for row in cursor.fetchall()]
            cursor.execute(f"SELECT COUNT(*) FROM {table} WHERE {key} IS NULL")
            has_nulls = cursor.fetchone()[0] > 0
        predicates = range_predicates(
            key, starts, has_nulls=has_nulls, tie_column=self.tie, modulo="({0} % {1})"
        )
        return [_Chunk(p) for p in predicates]

    def read(self, partition: _Chunk) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        query = f"SELECT {', '.join(map(identifier, self.columns))} FROM {self.target.table}"
        if partition.predicate:
            query += f" WHERE {partition.predicate}"
        with closing(self.target.connect()) as connection:
            cursor = connection.cursor()
            cursor.execute(query)
            while rows := cursor.fetchmany(_FETCH):
                arrays = [
                    pa.array(values, type=f.type)
                    for values, f in zip(zip(*rows), schema, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)


@dataclass
class _Written(WriterCommitMessage):
    token: str


class TableWriter(DataSourceArrowWriter):
    """Appends all rows or none.

    Every task attempt inserts its rows into a staging table in one
    transaction, under a token of its own. When the job commits, the rows of
    the successful attempts move to the target in one statement group and one
    transaction; rows of failed or repeated attempts never do.
    """

    def __init__(self, target: _Target, schema: StructType) -> None:
        self.target = target
        self.columns = [identifier(c) for c in schema.fieldNames()]
        self.staging = f"{target.table}_staging_{uuid.uuid4().hex[:12]}"
        names = ", ".join(self.columns)
        self.target.run(
            f"CREATE TABLE {self.staging} AS SELECT {names}, "
            f"CAST(NULL AS VARCHAR(32)) AS write_token FROM {target.table} WHERE 1 = 0"
        )

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        token = uuid.uuid4().hex
        insert = (
            f"INSERT INTO {self.staging} ({', '.join(self.columns)}, write_token) "
            f"VALUES ({self.target.placeholders(len(self.columns) + 1)})"
        )
        with closing(self.target.connect()) as connection:
            cursor = connection.cursor()
            for batch in iterator:
                columns = [c.to_pylist() for c in batch.columns]
                cursor.executemany(insert, list(zip(*columns, [token] * batch.num_rows)))
            connection.commit()
        return _Written(token)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        tokens = [m.token for m in messages if m is not None]
        names = ", ".join(self.columns)
        moves = []
        for i in range(0, len(tokens), _TOKENS_PER_STATEMENT):
            listed = ", ".join(f"'{t}'" for t in tokens[i : i + _TOKENS_PER_STATEMENT])
            moves.append(
                f"INSERT INTO {self.target.table} ({names}) "
                f"SELECT {names} FROM {self.staging} WHERE write_token IN ({listed})"
            )
        self.target.run(*moves, f"DROP TABLE {self.staging}")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self.target.run(f"DROP TABLE {self.staging}")
