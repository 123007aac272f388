"""Queries of an external database read side by side, by ranges of a column, over any DB-API module.

Each task opens a connection of its own and reads one range; filters on columns that the database
can judge are sent to it. A module that is a file reader (``sqlite3``) needs its file where every
executor finds it.
"""

from __future__ import annotations

import importlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull,
    IsNull, LessThan, LessThanOrEqual,
)
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

FETCHED = 8192
COMPARISONS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def condition(test: Filter) -> tuple[str, list] | None:
    """A filter as SQL with question marks and its values; None if the database is not asked to judge it."""
    if len(test.attribute) != 1:
        return None
    column = quoted(test.attribute[0])
    values = list(test.value) if isinstance(test, In) else [getattr(test, "value", 0)]
    if not all(isinstance(v, (int, float, str)) and not isinstance(v, bool) for v in values):
        return None
    if type(test) in COMPARISONS:
        return f"{column} {COMPARISONS[type(test)]} ?", values
    if isinstance(test, In):
        return f"{column} IN ({', '.join('?' * len(values))})", values
    if isinstance(test, IsNull):
        return f"{column} IS NULL", []
    if isinstance(test, IsNotNull):
        return f"{column} IS NOT NULL", []
    return None


@dataclass
class Range(InputPartition):
    """One task's share: a condition and its values."""

    test: str
    values: tuple


def ranges(column: str | None, low: int, high: int, number: int) -> list[Range]:
    """``number`` ranges that cover all values: the first has what lies below and NULLs, the last what lies above."""
    if column is None or number <= 1 or high <= low:
        return [Range("1 = 1", ())]
    name = quoted(column)
    number = min(number, high - low)
    cuts = [low + (high - low) * i // number for i in range(1, number)]
    first = Range(f"({name} < ? OR {name} IS NULL)", (cuts[0],))
    inner = [Range(f"{name} >= ? AND {name} < ?", pair) for pair in zip(cuts, cuts[1:])]
    return [first, *inner, Range(f"{name} >= ?", (cuts[-1],))]


class QueryReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: T.StructType) -> None:
        self.options = dict(options)
        self.schema = schema
        self.tests: list[tuple[str, list]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for test in filters:
            asked = condition(test)
            if asked is None:
                yield test
            else:
                self.tests.append(asked)

    def partitions(self) -> list[Range]:
        o = self.options
        return ranges(o.get("partitioncolumn"), int(o.get("lowerbound", 0)), int(o.get("upperbound", 0)), int(o.get("numpartitions", 1)))

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.schema)
        columns = ", ".join(map(quoted, schema.names))
        tests = [partition.test, *[t for t, _ in self.tests]]
        values = [*partition.values, *[v for _, vs in self.tests for v in vs]]
        statement = f"SELECT {columns} FROM ({self.options['query']}) AS asked WHERE {' AND '.join(tests)}"
        connection = importlib.import_module(self.options["module"]).connect(self.options["database"])
        try:
            cursor = connection.cursor()
            cursor.execute(statement, values)
            while found := cursor.fetchmany(FETCHED):
                arrays = [pa.array(c, t) for c, t in zip(zip(*found), schema.types)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)
        finally:
            connection.close()


class QuerySource(DataSource):
    """Options: ``module`` and ``database`` (what its ``connect`` takes), ``query``; for several tasks also
    ``partitionColumn`` (whole numbers), ``lowerBound``, ``upperBound`` and ``numPartitions``. The schema must be declared."""

    @classmethod
    def name(cls) -> str:
        return "dbapi_query"

    def reader(self, schema: T.StructType) -> QueryReader:
        return QueryReader({k.lower(): v for k, v in self.options.items()}, schema)


def read_database(spark: SparkSession, schema: T.StructType | str, **options: str | int) -> DataFrame:
    """A query's rows; see ``QuerySource`` for the options.

    The bounds only deal rows out: all rows come, wherever they lie. Filters on the frame reach the
    database where it can judge them.
    """
    spark.dataSource.register(QuerySource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("dbapi_query").schema(schema).options(**options).load()
