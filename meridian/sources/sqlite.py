"""Tables of SQLite files as a Spark data source: format "sqlite", options path and table.

A table is read in ranges of its row numbers, one a partition, so the file must lie where executors can open it.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from meridian.session import ship


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _name(table: str) -> str:
    return '"' + table.replace('"', '""') + '"'


def _type(declared: str):
    kind = declared.upper()
    if "INT" in kind:
        return LongType()
    if any(x in kind for x in ("REAL", "FLOA", "DOUB", "NUMERIC", "DECIMAL")):
        return DoubleType()
    return BinaryType() if "BLOB" in kind else StringType()


def _value(v, kind):
    if v is None:
        return None
    try:
        if isinstance(kind, LongType):
            return int(v)
        if isinstance(kind, DoubleType):
            return float(v)
    except (TypeError, ValueError):
        return None  # SQLite keeps any value in any column
    if isinstance(kind, BinaryType):
        return v if isinstance(v, bytes) else str(v).encode()
    return v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v)


class Rows(InputPartition):
    def __init__(self, low: int, high: int):
        self.low, self.high = low, high


class SqliteReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType):
        self.path, self.table, self.parts, self.schema = options["path"], options["table"], int(options.get("partitions", 8)), schema

    def partitions(self) -> list[Rows]:
        with _open(self.path) as db:
            low, high = db.execute(f"SELECT min(rowid), max(rowid) FROM {_name(self.table)}").fetchone()
        if low is None:
            return [Rows(0, 0)]
        step = -(-(high - low + 1) // self.parts)
        return [Rows(at, min(at + step, high + 1)) for at in range(low, high + 1, step)]

    def read(self, part: Rows) -> Iterator[tuple]:
        names, kinds = ", ".join(_name(f.name) for f in self.schema), [f.dataType for f in self.schema]
        db = _open(self.path)
        db.text_factory = bytes
        try:
            for row in db.execute(f"SELECT {names} FROM {_name(self.table)} WHERE rowid >= ? AND rowid < ?", (part.low, part.high)):
                yield tuple(_value(v, k) for v, k in zip(row, kinds))
        finally:
            db.close()


class SqliteSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> StructType:
        with _open(self.options["path"]) as db:
            found = db.execute(f"PRAGMA table_info({_name(self.options['table'])})").fetchall()
        if not found:
            raise ValueError(f"no table {self.options['table']}")
        return StructType([StructField(name, _type(kind or "")) for _, name, kind, *_ in found])

    def reader(self, schema: StructType) -> SqliteReader:
        return SqliteReader(self.options, schema)


def read_sqlite(spark: SparkSession, path: str, table: str, partitions: int = 8):
    """A table's rows; values that don't fit a column's declared type are null."""
    ship(spark).dataSource.register(SqliteSource)
    return spark.read.format("sqlite").option("table", table).option("partitions", str(partitions)).load(path)
