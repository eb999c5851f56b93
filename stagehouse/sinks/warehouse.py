"""Parquet tables of the warehouse and how each kind is written."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse.ledger import SUCCESS, Ledger, path_exists
from stagehouse.operators import merge
from stagehouse.operators.joins import unplaced
from stagehouse.operators.typing import tag_batch
from stagehouse.session import delete, materialize

BATCH = "request_id"
BUCKET = "key_bucket"
# Partitions of a keyed table. A key stays in its partition for good, so this
# is set once, for partitions of a few hundred MB at the size a table will reach.
BUCKETS = 64
JDBC_BATCH = 10_000


def tagged(schema: T.StructType) -> T.StructType:
    """``schema`` behind the batch column."""
    return T.StructType([T.StructField(BATCH, T.StringType()), *schema.fields])


class Warehouse:
    """Tables below one root.

    * batch tables (staging, change log): a folder per ``request_id``. Writing
      a batch replaces that batch's folder and nothing else, so a repeated
      write leaves the rows once.
    * snapshot tables (current state, dimensions, marts): every write makes a
      new version folder, and readers take the newest one that committed. A
      table can so be rewritten from its own rows.
    * keyed tables (current state): partitioned by a hash of the key. An upsert
      reads and writes only the partitions its keys fall into.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, f"{self.root}/ledger")

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table.strip('/').replace('/', '_')}"

    def _glob(self, pattern: str) -> list[str]:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return [status.getPath().toString() for status in (fs.globStatus(path) or [])]

    # -- batch tables --------------------------------------------------------
    def append_batch(self, df: DataFrame, layer: str, table: str) -> None:
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BATCH)
            .parquet(self.path(layer, table))
        )

    def append_stage(self, df: DataFrame, table: str, request_id: str) -> None:
        """Stage ``df`` as the batch ``request_id``."""
        self.append_batch(tag_batch(df, request_id), "stg", table)

    def batches(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """All batches; ``schema`` includes the batch column, which is always text."""
        path = self.path(layer, table)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).select(*schema.fieldNames())

    def batch(
        self, layer: str, table: str, schema: T.StructType, request_id: str | None
    ) -> DataFrame:
        """One batch. Only its own folder is listed and read."""
        root = self.path(layer, table)
        folder = f"{root}/{BATCH}={request_id}"
        if request_id is None or not path_exists(self.spark, folder):
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.schema(schema).option("basePath", root)
        return reader.parquet(folder).select(*schema.fieldNames())

    def batch_ids(self, layer: str, table: str) -> DataFrame:
        """The ids of all batches, from the names of their folders."""
        found = self._glob(f"{self.path(layer, table)}/{BATCH}=*")
        ids = [(unquote(path.rsplit("=", 1)[1]),) for path in found]
        return self.spark.createDataFrame(ids, f"{BATCH} string")

    def stage(self, table: str, schema: T.StructType) -> DataFrame:
        return self.batches("stg", table, tagged(schema))

    def staged(self, table: str, schema: T.StructType, request_id: str | None) -> DataFrame:
        return self.batch("stg", table, tagged(schema), request_id)

    # -- snapshot tables -----------------------------------------------------
    def _versions(self, layer: str, table: str) -> list[str]:
        """Committed version folders, oldest first."""
        marks = self._glob(f"{self.path(layer, table)}/v=*/_SUCCESS")
        return sorted(mark.rsplit("/", 1)[0] for mark in marks)

    def replace(self, df: DataFrame, layer: str, table: str) -> None:
        """Truncate and reload, without touching what readers have open."""
        last = self._versions(layer, table)
        number = int(last[-1].rsplit("v=", 1)[1].split("-")[0]) + 1 if last else 1
        version = f"v={number:09d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(f"{self.path(layer, table)}/{version}")

    def snapshot(self, layer: str, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The newest version; empty with the given schema when there is none."""
        versions = self._versions(layer, table)
        if not versions:
            if schema is None:
                raise ValueError(f"no snapshot of {layer}.{table}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(versions[-1])

    def expire(self, layer: str, table: str, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions; returns how many went."""
        old = self._versions(layer, table)[: -max(keep, 1)]
        for version in old:
            delete(self.spark, version)
        return len(old)

    # -- keyed tables --------------------------------------------------------
    def _keyed_path(self, layer: str, table: str) -> str:
        return f"{self.path(layer, table)}/by_key"

    def _with_bucket(self, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int")
        return rows.withColumn(BUCKET, bucket)

    def _write_keyed(self, rows: DataFrame, layer: str, table: str, mode: str) -> None:
        (
            rows.repartition(self.buckets, BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", mode)
            .partitionBy(BUCKET)
            .parquet(self._keyed_path(layer, table))
        )

    def replace_keyed(
        self, rows: DataFrame, layer: str, table: str, keys: Sequence[str]
    ) -> None:
        """Write the whole table anew, from rows that do not come out of it."""
        self._write_keyed(self._with_bucket(rows, keys), layer, table, "static")

    def merge_keyed(
        self,
        updates: DataFrame,
        layer: str,
        table: str,
        keys: Sequence[str],
        schema: T.StructType,
        check_unique: bool = True,
    ) -> int:
        """Upsert ``updates``; returns how many partitions that touched.

        All other partitions keep their files. A run that breaks off leaves each
        partition as it was or as it should be, and doing it again gives the same rows.
        """
        columns = schema.fieldNames()
        fresh = materialize(self._with_bucket(updates.select(*columns), keys), "updates")
        # At most one number per partition of the table.
        touched = [row[0] for row in fresh.select(BUCKET).distinct().collect()]
        if touched:
            held = self._read_keyed(layer, table, schema).where(F.col(BUCKET).isin(touched))
            merged = merge.upsert(held, fresh, keys, check_unique)
            self._write_keyed(merged, layer, table, "dynamic")
        return len(touched)

    def _read_keyed(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        stored = T.StructType([*schema.fields, T.StructField(BUCKET, T.IntegerType())])
        path = self._keyed_path(layer, table)
        if not path_exists(self.spark, path):
            return self.spark.createDataFrame([], stored)
        return self.spark.read.schema(stored).parquet(path)

    def keyed(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        return self._read_keyed(layer, table, schema).drop(BUCKET)

    # -- several tables at once ----------------------------------------------
    def write_together(self, tables: dict[str, DataFrame], layer: str, request_id: str) -> None:
        """Write one batch of several tables; close its ledger request afterwards."""
        for table, df in tables.items():
            self.append_batch(tag_batch(df, request_id), layer, table)

    def read_committed(self, layer: str, table: str, schema: T.StructType) -> DataFrame:
        """Rows of the batches whose ledger request succeeded."""
        done = unplaced(self.ledger.rows().where(F.col("status") == SUCCESS).select(BATCH))
        rows = self.batches(layer, table, tagged(schema))
        return rows.join(done, BATCH, "left_semi").select(*schema.fieldNames())


def write_jdbc(
    df: DataFrame, url: str, table: str, properties: dict[str, str], mode: str = "append"
) -> None:
    """Append to a database table, or reload it keeping its definition."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(JDBC_BATCH), **properties)
        .option("truncate", "true")
        .mode(mode)
        .save()
    )
