"""Files arriving in a folder, routed by name and loaded once each."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stagehouse.functions.text import route_by_name
from stagehouse.plans import jobs
from stagehouse.schemas import COMPANY_XML, EMPLOYEE_XML, REGION_XML, RecordType
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.xml import stream_files

POLL = "30 seconds"


@dataclass(frozen=True)
class Route:
    record: RecordType
    apply: Callable[[Warehouse], object]


ROUTES = {
    "region": Route(REGION_XML, jobs.apply_regions),
    "companies": Route(COMPANY_XML, jobs.apply_companies),
    "employee": Route(EMPLOYEE_XML, jobs.apply_all_employees),
}


def request_for(checkpoint: str, batch_id: int, path: str) -> str:
    """The same id each time a batch is tried, so a repeat replaces its own rows."""
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint}#{batch_id}#{path}"))


def load_files(
    batch: DataFrame,
    batch_id: int,
    warehouse: Warehouse,
    checkpoint: str,
    names: dict[str, str] | None = None,
) -> list[str]:
    """Stage and apply the routed files of one batch, in name order.

    The batch holds file paths, as many as ``maxFilesPerTrigger`` lets in; the
    rows of a file never leave the Spark jobs that load it.
    """
    routed = batch.withColumn("route", route_by_name(F.col("filename"), names))
    files = routed.where(F.col("route").isNotNull()).orderBy("filename").collect()
    for path, filename, name in files:
        route = ROUTES[name]
        jobs.stage_file(
            warehouse, route.record, path, filename, request_for(checkpoint, batch_id, path)
        )
        route.apply(warehouse)
    return [filename for _, filename, _ in files]


def watch_folder(
    spark: SparkSession,
    folder: str,
    warehouse: Warehouse,
    checkpoint: str,
    archive: str | None = None,
    max_files: int = 1,
    once: bool = False,
    names: dict[str, str] | None = None,
) -> StreamingQuery:
    """Start the watch. ``once`` takes what lies there and stops.

    ``names`` maps a text in the file name to a route, if the usual ones do not
    fit. The checkpoint says which files were taken. A file that does not load stops
    the stream with its request marked FAILED; starting it again tries that
    file again. Files no route takes are skipped.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        load_files(batch, batch_id, warehouse, checkpoint, names)

    writer = (
        stream_files(spark, folder, archive, max_files)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if once else {"processingTime": POLL}
    return writer.trigger(**trigger).start()
