"""SQLite tables as a Spark data source.

``spark.read.format("sqlite_table").option("path", p).option("table", t).load()``
reads ranges of rows in parallel. The file must be at the same path for all
executors. A missing file or table has no rows, given a schema.

With ``sqlite_pushed`` filters become the query's ``where``, so rows that do not match are not
read; ``load`` with a condition does so in one scan, see ``frozen.pushing``. Ranges are over row ids, or over the column in the option ``by``, which should have an index,
and are cut by numbers of matching rows: gaps in the ids and frequent values
make no task larger, but that equal values of ``by`` stay together.

A date is text of the form YYYY-MM-DD; other text in a date column is read as null, as is text in
a number's column.
"""

from __future__ import annotations

import datetime
import os
import sqlite3
from collections.abc import Callable, Iterable, Iterator
from contextlib import closing

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from tidemark.frozen import frozen, pushing
from tidemark.schemas import conform, empty

_COMPARED = {EqualTo: "=", EqualNullSafe: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _opened(path: str) -> closing:
    return closing(sqlite3.connect(f"file:{path}?mode=ro", uri=True))


def _columns(path: str, table: str) -> list[tuple[str, str]]:
    if not os.path.exists(path):
        return []
    with _opened(path) as db:
        return [(r[1], r[2]) for r in db.execute(f"pragma table_info({_quoted(table)})")]


def _kind(declared: str) -> str:
    declared = declared.upper()
    return "long" if "INT" in declared else "double" if any(k in declared for k in ("REAL", "FLOA", "DOUB")) else "string"


def _date(value) -> datetime.date | None:
    try:
        return datetime.date.fromisoformat(value) if isinstance(value, str) and len(value) == 10 else None
    except ValueError:
        return None


def _number(kind: Callable) -> Callable:
    return lambda v: kind(v) if isinstance(v, (int, float)) else None


def _reading(kind: T.DataType) -> Callable:
    """How a value of SQLite becomes one of the wanted type."""
    if isinstance(kind, T.DateType):
        return _date
    if isinstance(kind, T.BooleanType):
        return _number(bool)
    if isinstance(kind, T.IntegralType):
        return _number(int)
    if isinstance(kind, T.FractionalType):
        return _number(float)
    return lambda v: None if v is None else str(v)


def _bound(value):
    return value.isoformat() if isinstance(value, datetime.date) else value


class _Range(InputPartition):
    """Rows from ``low`` to before ``high`` by the dividing column (None: no bound); ``nulls``: those without a value."""

    def __init__(self, low, high, nulls: bool = False):
        super().__init__((low, high))
        self.low, self.high, self.nulls = low, high, nulls


class Reader(DataSourceReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.path, self.table, self.schema = options["path"], options["table"], schema
        self.there = {n for n, _ in _columns(self.path, self.table)}
        self.wanted = max(1, int(options.get("partitions", "4")))
        self.by = _quoted(options["by"]) if options.get("by") else "rowid"
        self.conditions: list[str] = []
        self.values: list = []

    def take(self, filters: list[Filter]) -> Iterable[Filter]:
        """Each condition lets through all rows that its filter does; Spark applies the filters again to what was read."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in self.there:
                if type(f) in _COMPARED and f.value is not None:
                    self._where(f"{_quoted(name)} {_COMPARED[type(f)]} ?", f.value)
                elif isinstance(f, In) and None not in f.value:
                    self._where(f"{_quoted(name)} in ({', '.join('?' * len(f.value))})", *f.value)
                elif isinstance(f, IsNotNull):
                    self._where(f"{_quoted(name)} is not null")
            yield f

    def _where(self, condition: str, *values) -> None:
        self.conditions.append(condition)
        self.values += map(_bound, values)

    def _matching(self, *more: str) -> str:
        conditions = [*self.conditions, *more]
        return f"from {_quoted(self.table)}" + (f" where {' and '.join(conditions)}" if conditions else "")

    def partitions(self) -> list[InputPartition]:
        if not self.there:
            return [_Range(None, None)]
        with _opened(self.path) as db:
            rows = db.execute(f"select count({self.by}) {self._matching()}", self.values).fetchone()[0]
            step = max(1, -(-rows // self.wanted))
            numbered = f"select {self.by} as v, row_number() over (order by {self.by}) - 1 as k {self._matching(f'{self.by} is not null')}"
            lows = [v for (v,) in db.execute(f"select v from ({numbered}) where k > 0 and k % {step} = 0", self.values)]
        edges = [None, *dict.fromkeys(lows), None]
        out: list[InputPartition] = [_Range(a, b) for a, b in zip(edges, edges[1:])]
        return out if self.by == "rowid" else [*out, _Range(None, None, nulls=True)]

    def read(self, partition: _Range) -> Iterator[tuple]:
        if not self.there:
            return
        names = ", ".join(_quoted(f.name) if f.name in self.there else "null" for f in self.schema)
        readings = [_reading(f.dataType) for f in self.schema]
        if partition.nulls:
            bounds = [(f"{self.by} is null", None)]
        else:
            bounds = [(f"{self.by} >= ?", partition.low), (f"{self.by} < ?", partition.high)]
            bounds = [b for b in bounds if b[1] is not None] or [(f"{self.by} is not null", None)]
        with _opened(self.path) as db:
            for row in db.execute(f"select {names} {self._matching(*(c for c, _ in bounds))}", [*self.values, *(v for _, v in bounds if v is not None)]):
                yield tuple(r(v) for r, v in zip(readings, row))


class PushedReader(Reader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:  # noqa: N802
        return self.take(filters)


class SqliteTable(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        return ", ".join(f"`{n}` {_kind(k)}" for n, k in _columns(self.options["path"], self.options["table"]))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return Reader(self.options, schema)


class SqlitePushed(SqliteTable):
    @classmethod
    def name(cls) -> str:
        return "sqlite_pushed"

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return PushedReader(self.options, schema)


def load(spark: SparkSession, path: str, table: str, schema: T.StructType, by: str | None = None, condition: Column | str | None = None) -> DataFrame:
    """A table in the given schema; columns that an older file lacks are null, a missing file or table is empty.

    With a ``condition`` just the rows for which it holds are read, now and once.
    Columns have the schema's types at once, so conditions on them, dates too, reach the file.
    """
    if not _columns(path, table):
        return empty(spark, schema)
    source = SqliteTable if condition is None else SqlitePushed
    spark.dataSource.register(source)
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields])
    reader = spark.read.format(source.name()).schema(loose).option("path", path).option("table", table)
    reader = reader.option("by", by) if by else reader
    if condition is None:
        return conform(reader.load(), schema)
    with pushing(spark):
        return conform(frozen(reader.load().where(condition)), schema)
