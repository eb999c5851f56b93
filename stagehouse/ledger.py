"""The load ledger: one request per file or staged table."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.operators.filters import filter_not_in
from stagehouse.schemas import LEDGER, struct
from stagehouse.session import delete

# States of a request.
CREATED, RUNNING, SUCCESS, FAILED = "CREATE", "RUNNING", "SUCCESS", "FAILED"
# A loaded file none of whose rows could enter the change log.
EMPTY = "EMPTY"

EVENTS = struct("request_id table_name filename status at:time")


def running(ledger: DataFrame, table: str) -> DataFrame:
    """The running request of ``table`` that was opened first; at most one row."""
    return (
        ledger.where((F.col("table_name") == table) & (F.col("status") == RUNNING))
        .orderBy(F.asc_nulls_last("load_date"), "request_id")
        .limit(1)
        .select("request_id", "filename")
    )


def loaded_files(ledger: DataFrame) -> DataFrame:
    """Files that need no further load; a running or failed one counts as new."""
    return filter_not_in(ledger, "status", [RUNNING, FAILED]).select("filename")


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Distinct files of ``listing`` that the ledger does not hold as loaded."""
    return listing.select("filename").distinct().join(
        loaded_files(ledger).distinct(), "filename", "left_anti"
    )


def with_status(ledger: DataFrame, request_id: str, status: str) -> DataFrame:
    """The ledger after a status update of one request."""
    changed = F.when(F.col("request_id") == request_id, F.lit(status))
    return ledger.withColumn("status", changed.otherwise(F.col("status")))


class Ledger:
    """Ledger kept as appended status events, so no write has to read it first.

    Opening a request again (a replayed batch) changes nothing but its status.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _append(self, events: list[tuple]) -> None:
        at = datetime.now(timezone.utc).replace(tzinfo=None)
        rows = self.spark.createDataFrame([(*event, at) for event in events], EVENTS)
        rows.coalesce(1).write.mode("append").parquet(self.path)

    def open(
        self,
        table: str,
        filename: str | None = None,
        request_id: str | None = None,
        status: str = RUNNING,
    ) -> str:
        request_id = request_id or str(uuid.uuid4())
        self._append([(request_id, table, filename, status)])
        return request_id

    def open_all(self, tables: Iterable[str], status: str = CREATED) -> dict[str, str]:
        """One request per table; their ids by table."""
        ids = {table: str(uuid.uuid4()) for table in tables}
        self._append([(request, table, None, status) for table, request in ids.items()])
        return ids

    def close(self, request_id: str, status: str) -> None:
        self.close_all([request_id], status)

    def close_all(self, request_ids: Iterable[str], status: str) -> None:
        self._append([(request, None, None, status) for request in request_ids])

    def _events(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], EVENTS)
        return self.spark.read.schema(EVENTS).parquet(self.path)

    def rows(self) -> DataFrame:
        """One row per request with its newest status."""
        opened = F.col("table_name").isNotNull()
        return (
            self._events()
            .groupBy("request_id")
            .agg(
                F.max("table_name").alias("table_name"),
                F.max("filename").alias("filename"),
                F.max_by("status", "at").alias("status"),
                F.min(F.when(opened, F.col("at"))).alias("load_date"),
            )
            .select(*LEDGER.fieldNames())
        )

    def compact(self) -> None:
        """Bring the many small event files into one, while no reader is at work.

        The new file repeats the first and the last event of each request, and
        repeated events change nothing, so a stop half-way does no harm.
        """
        if not path_exists(self.spark, self.path):
            return
        small = self._events().inputFiles()
        last = self._events().groupBy("request_id").agg(F.max("at").alias("_last"))
        opened = self.rows().withColumnRenamed("load_date", "at").select(*EVENTS.fieldNames())
        closed = self.rows().join(last, "request_id").select(
            "request_id", F.lit(None).alias("table_name"), F.lit(None).alias("filename"),
            "status", F.col("_last").alias("at"),
        )
        opened.unionByName(closed).coalesce(1).write.mode("append").parquet(self.path)
        for file in small:
            delete(self.spark, file)

    def running(self, table: str) -> DataFrame:
        return running(self.rows(), table)

    def loaded_files(self) -> DataFrame:
        return loaded_files(self.rows())


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(target)
