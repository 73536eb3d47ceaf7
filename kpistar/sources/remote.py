"""Remote relations as a Spark data source over a database driver of Python (DB-API 2).

``read_relation`` runs a query of the remote database inside Spark tasks: ``partitions``
ranges of one integer column are read side by side, each by a connection of its own, and
rows arrive as Arrow batches of ``batch_rows``.  ``only`` (a column's value or list of
values) is part of the remote statement, so a brand is filtered before its rows travel;
columns keep the declared types whatever the driver returns.  Spark's own push-down into
Python sources is not used: Spark 4.1 keeps the first plan's filters for later plans over
the same DataFrame, which then lose rows.

``connect`` opens a connection (``lambda: psycopg.connect(...)``); it is sent to the
executors, which need the driver but not this package.  A task that is run again
opens a new connection and reads its range again; the ranges read at different moments,
so the remote tables should not change meanwhile (or be read as one partition).
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from itertools import count

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

_NUMBER = count()


@dataclass(frozen=True)
class Ranges:
    """Split of a read: strides of ``column`` between the bounds; nulls and what lies outside go to the outer ones."""

    column: str
    lower: int
    upper: int
    partitions: int

    def conditions(self) -> list[str]:
        n = max(1, min(self.partitions, self.upper - self.lower))
        cuts = [self.lower + (self.upper - self.lower) * i // n for i in range(1, n)]
        if not cuts:
            return [""]
        c = _quoted(self.column)
        return [f"({c} < {cuts[0]} OR {c} IS NULL)", *[f"({c} >= {a} AND {c} < {b})" for a, b in zip(cuts, cuts[1:])], f"({c} >= {cuts[-1]})"]


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def conditions(only: dict, schema: T.StructType, placeholder: str) -> tuple[list[str], list]:
    """SQL conditions and values of ``only``; None asks for nulls, an empty list for nothing."""
    texts, values = [], []
    for name, wanted in only.items():
        if name not in schema.names:
            raise ValueError(f"no column {name!r} in the remote relation")
        column = _quoted(name)
        if wanted is None:
            texts.append(f"{column} IS NULL")
            continue
        some = list(wanted) if isinstance(wanted, (list, tuple, set)) else [wanted]
        if None in some:
            raise ValueError(f"a list for {name!r} holds no nulls")
        texts.append(f"{column} IN ({', '.join([placeholder] * len(some))})" if some else "1 = 0")
        values += some
    return texts, values


class RelationReader(DataSourceReader):
    def __init__(self, connect: Callable, query: str, schema: T.StructType, only: dict, ranges: Ranges | None, placeholder: str, batch_rows: int):
        self.connect, self.query, self.schema = connect, query, schema
        self.ranges, self.placeholder, self.batch_rows = ranges, placeholder, batch_rows
        self.conditions, self.values = conditions(only, schema, placeholder)

    def partitions(self):
        return [InputPartition(x) for x in (self.ranges.conditions() if self.ranges else [""])]

    def statement(self, part: str) -> str:
        """The remote statement of one partition."""
        query = self.query.replace("%", "%%") if self.values and self.placeholder == "%s" else self.query
        where = " AND ".join([*self.conditions, *([part] if part else [])])
        return f"SELECT {', '.join(_quoted(f.name) for f in self.schema)} FROM ({query}) AS remote_q" + (f" WHERE {where}" if where else "")

    def read(self, partition):
        schema = to_arrow_schema(self.schema)
        connection = self.connect()
        try:
            cursor = connection.cursor()
            cursor.execute(self.statement(partition.value), *([self.values] if self.values else []))
            while rows := cursor.fetchmany(self.batch_rows):
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)
        finally:
            connection.close()


def read_relation(spark: SparkSession, connect: Callable, query: str, schema: str, only: dict | None = None, ranges: Ranges | None = None,
                  placeholder: str = "%s", batch_rows: int = 10_000) -> DataFrame:
    """The rows of the remote ``query`` with the columns and types of ``schema``; the query's column names are those of ``schema``."""
    declared = spark.createDataFrame([], schema).schema
    conditions(only or {}, declared, placeholder)       # errors before any task runs
    number = next(_NUMBER)

    class Relation(DataSource):
        @classmethod
        def name(cls):
            return f"kpistar_relation_{number}"

        def schema(self):
            return declared

        def reader(self, schema):
            return RelationReader(connect, query, declared, only or {}, ranges, placeholder, batch_rows)

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(Relation)
    return spark.read.format(Relation.name()).load()
