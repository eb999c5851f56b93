"""A relational source checked for changes at an interval."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from stagehouse.plans import increments, jobs
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.tables import TableSource

POLL = "30 seconds"


def watch_source(
    spark: SparkSession,
    source: TableSource,
    warehouse: Warehouse,
    checkpoint: str,
    every: str = POLL,
    once: bool = False,
    **options,
) -> StreamingQuery:
    """Refresh star and marts whenever source and staging differ in row count.

    The rate stream is only the clock. A failed refresh stops the query, and
    starting it again checks anew, so no change is lost.
    """

    def tick(_: DataFrame, __: int) -> None:
        jobs.refresh_if_changed(source, warehouse, **options)

    return _at_intervals(spark, tick, checkpoint, every, once)


def watch_increments(
    spark: SparkSession,
    source: TableSource,
    warehouse: Warehouse,
    checkpoint: str,
    every: str = POLL,
    once: bool = False,
    reconcile_every: int = 120,
    **options,
) -> StreamingQuery:
    """Load what came since the last time; one tick in ``reconcile_every`` also
    looks for rows that came late."""

    def tick(_: DataFrame, number: int) -> None:
        late = number % reconcile_every == reconcile_every - 1
        increments.incremental_load(source, warehouse, reconcile=late, **options)

    return _at_intervals(spark, tick, checkpoint, every, once)


def _at_intervals(
    spark: SparkSession,
    tick: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str,
    once: bool,
) -> StreamingQuery:
    clock = spark.readStream.format("rate").option("rowsPerSecond", "1").load()
    writer = clock.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start()
