"""Column-pruned snapshots of relational source tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.schemas import SALES_TABLES, SPLIT_COLUMN


class TableSource(Protocol):
    def load(self, table: str) -> DataFrame: ...

    def count(self, table: str) -> int: ...

    def load_from(self, table: str, low: int | None) -> DataFrame:
        """At least the rows whose first column is ``low`` or more; all where it is null."""
        ...


@dataclass(frozen=True)
class FrameSource:
    """Tables that are DataFrames already."""

    tables: Mapping[str, DataFrame]

    def load(self, table: str) -> DataFrame:
        return self.tables[table]

    def load_from(self, table: str, low: int | None) -> DataFrame:
        return self.load(table)

    def count(self, table: str) -> int:
        return self.load(table).count()


@dataclass(frozen=True)
class ParquetSource:
    """One parquet folder or file per table below ``root``."""

    spark: SparkSession
    root: str
    suffix: str = ""

    def load(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{table}{self.suffix}")

    def load_from(self, table: str, low: int | None) -> DataFrame:
        """The whole table: what the caller compares is pushed into the scan."""
        return self.load(table)

    def count(self, table: str) -> int:
        return self.load(table).count()


@dataclass(frozen=True)
class JdbcSource:
    """Tables of a database, read in parallel slices of their first column."""

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    db_schema: str = "public"
    num_partitions: int = 64
    fetch_size: int = 10_000

    def _options(self) -> dict[str, str]:
        return {"fetchsize": str(self.fetch_size), **self.properties}

    def bounds_query(self, table: str, low: int | None = None) -> str:
        key = SPLIT_COLUMN[table]
        past = "" if low is None else f" WHERE {key} >= {int(low)}"
        return f"SELECT MIN({key}) AS low, MAX({key}) AS high FROM {self.db_schema}.{table}{past}"

    def count_query(self, table: str) -> str:
        return f"SELECT COUNT(*) AS n FROM {self.db_schema}.{table}"

    def _query(self, sql: str) -> DataFrame:
        reader = self.spark.read.format("jdbc").option("url", self.url)
        return reader.options(**self._options()).option("query", sql).load()

    def slice_options(self, table: str, low: int | None, high: int | None) -> dict[str, object]:
        """Arguments of a sliced ``spark.read.jdbc``; an empty table is read in one go."""
        where = {"table": f"{self.db_schema}.{table}"}
        if low is None or high is None or self.num_partitions < 2:
            return where
        return {
            **where,
            "column": SPLIT_COLUMN[table],
            "lowerBound": int(low),
            "upperBound": int(high) + 1,
            "numPartitions": self.num_partitions,
        }

    def load(self, table: str) -> DataFrame:
        return self.load_from(table, None)

    def load_from(self, table: str, low: int | None) -> DataFrame:
        """Slices over the keys from ``low`` on, so that a small delta is not one slice of many."""
        first, last = self._query(self.bounds_query(table, low)).first()
        rows = self.spark.read.jdbc(
            self.url, properties=self._options(), **self.slice_options(table, first, last)
        )
        return rows if low is None else rows.where(F.col(SPLIT_COLUMN[table]) >= F.lit(low))

    def count(self, table: str) -> int:
        """Counted by the database, which sends one row."""
        return self._query(self.count_query(table)).first()[0]


def read_table(source: TableSource, table: str, low: int | None = None) -> DataFrame:
    """A snapshot of ``table`` with its declared columns only.

    The select reaches the scan, so parquet and JDBC read no other column.
    With ``low``, rows whose first column is smaller may be left out.
    """
    schema = SALES_TABLES[table]
    rows = source.load(table) if low is None else source.load_from(table, low)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
