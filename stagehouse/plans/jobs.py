"""Composed jobs over a warehouse: sales loads, file loads, emissions.

A job writes its tables one after the other; each write is a Spark job of its
own and leaves whole results. Running a job again after a failure repeats
writes that replace themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stagehouse import ledger
from stagehouse.functions.buckets import HISTORY, REPEATED, AgeBuckets
from stagehouse.functions.dates import SUNDAY_FIRST
from stagehouse.functions.text import route_by_name
from stagehouse.operators import changes, drift, keys, merge, watermark
from stagehouse.operators.typing import split_rejects
from stagehouse.plans import emissions, employees, marts, reference, star
from stagehouse.schemas import (
    ADDRESS,
    COMPANY_NDS,
    COMPANY_XML,
    EMPLOYEE_LOG,
    EMPLOYEE_NDS,
    EMPLOYEE_XML,
    EMPLOYMENT,
    ENVIRONMENTAL_EMISSIONS,
    LEDGER_TABLE,
    OBJECT_CATEGORY,
    OBJECTS,
    ORGANIZATIONS,
    ORGANIZATIONS_X_ADDRESS,
    PERSONS,
    REGION_NDS,
    REGION_XML,
    SALES_TABLES,
    STAGE_NAMES,
    TYPE_COMPANY,
    TYPE_INDUSTRY,
    RecordType,
    struct,
    text_only,
)
from stagehouse.session import job_scratch, materialize
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.emissions import extract_emissions
from stagehouse.sources.tables import TableSource, read_table
from stagehouse.sources.xml import list_files, move_file, read_xml

# Spark runs jobs from several driver threads side by side, which fills the
# cluster while the small tables are written.
PARALLEL_WRITES = 8

# Tables of the typed layer fed by files.
LOG_TABLE = "DWH_DSO_3NDSemployees"
PERSONS_TABLE = "DWH_AO_TNDSemployees"
EMPLOYMENT_TABLE = "DWH_DSO_2NDSemployees"
REGIONS_TABLE = "DWH_AO_HNDSregions"
COMPANIES_TABLE = "DWH_AO_HNDScompanies"
TYPE_COMPANY_TABLE = "DWH_AO_NDStype_company"
TYPE_INDUSTRY_TABLE = "DWH_AO_NDStype_industry"


def side_by_side(tasks: Sequence[Callable[[], None]]) -> None:
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        for done in [pool.submit(task) for task in tasks]:
            done.result()


# --- sales ------------------------------------------------------------------
def stage_sales(source: TableSource, warehouse: Warehouse) -> dict[str, str]:
    """Stage all 14 tables under one request each; the request ids by table."""
    return _stage(source, warehouse)[1]


def _stage(source: TableSource, warehouse: Warehouse) -> tuple[str, dict[str, str]]:
    """The request of the load as a whole, still open, and those of the tables."""
    requests = warehouse.ledger.open_all([LEDGER_TABLE, *STAGE_NAMES.values()])

    def stage(table: str, name: str) -> Callable[[], None]:
        return lambda: warehouse.append_stage(read_table(source, table), name, requests[name])

    try:
        side_by_side([stage(table, name) for table, name in STAGE_NAMES.items()])
    except Exception:
        warehouse.ledger.close_all(requests.values(), ledger.FAILED)
        raise
    load = requests.pop(LEDGER_TABLE)
    warehouse.ledger.close_all(requests.values(), ledger.SUCCESS)
    return load, {table: requests[name] for table, name in STAGE_NAMES.items()}


def _load_sales(
    source: TableSource, warehouse: Warehouse, measure: str, then: Callable[[], None]
) -> None:
    """Stage, fill the star and do ``then`` under one request for the whole.

    That request succeeds last, so a load that broke off anywhere leaves it
    open or failed and the next refresh starts over.
    """
    load, requests = _stage(source, warehouse)
    try:
        load_star(staged_sales(warehouse, requests), warehouse, measure)
        then()
    except Exception:
        warehouse.ledger.close(load, ledger.FAILED)
        raise
    warehouse.ledger.close(load, ledger.SUCCESS)


def _reload(warehouse: Warehouse, rows: DataFrame, layer: str, table: str) -> None:
    """Truncate and reload; readers of the version before keep it, older ones go."""
    warehouse.replace(rows, layer, table)
    warehouse.expire(layer, table)


def staged_sales(warehouse: Warehouse, requests: Mapping[str, str]) -> dict[str, DataFrame]:
    """The staged rows of the given requests, without their batch column."""
    return {
        table: warehouse.staged(STAGE_NAMES[table], SALES_TABLES[table], request).drop("request_id")
        for table, request in requests.items()
    }


def load_star(stage: Mapping[str, DataFrame], warehouse: Warehouse, measure: str = "price") -> None:
    """Dimensions upserted by key, the fact reloaded, into the ``nds`` layer."""

    def load(name: str) -> Callable[[], None]:
        rows = star.dimension(stage, name)
        key = rows.columns[0]

        def run() -> None:
            target = warehouse.snapshot("nds", name, rows.schema)
            merged = merge.upsert(target, rows, [key], check_unique=False)
            _reload(warehouse, merged, "nds", name)

        return run

    side_by_side([load(name) for name in star.DIMENSIONS])
    _reload(warehouse, star.fact_sale(stage, measure), "nds", "fact_sale")


def copy_layer(warehouse: Warehouse, source: str, target: str) -> None:
    """Bring one layer's star into another: dimensions by key, the fact whole."""

    def copy(name: str) -> Callable[[], None]:
        def run() -> None:
            rows = warehouse.snapshot(source, name)
            held = warehouse.snapshot(target, name, rows.schema)
            merged = merge.upsert(held, rows, [rows.columns[0]], check_unique=False)
            _reload(warehouse, merged, target, name)

        return run

    side_by_side([copy(name) for name in star.DIMENSIONS])
    _reload(warehouse, warehouse.snapshot(source, "fact_sale"), target, "fact_sale")


def load_marts(
    warehouse: Warehouse,
    layer: str,
    labels: tuple[str, ...] = SUNDAY_FIRST,
    buckets: AgeBuckets = HISTORY,
) -> None:
    """Reload the nine marts from the star of ``layer``."""
    fact = warehouse.snapshot(layer, "fact_sale")
    customers = warehouse.snapshot(layer, "dim_customer")
    write_marts(warehouse, layer, fact, fact, fact, customers, labels, buckets)


def write_marts(
    warehouse: Warehouse,
    layer: str,
    by_seller: DataFrame,
    by_service: DataFrame,
    by_place: DataFrame,
    customers: DataFrame,
    labels: tuple[str, ...] = SUNDAY_FIRST,
    buckets: AgeBuckets = HISTORY,
) -> None:
    """Write the nine marts out of the fact, or of its sums by seller and date,
    service, and place and date. Growth and moving average read the monthly mart
    just written, so months are summed once."""

    def dim(name: str) -> DataFrame:
        return warehouse.snapshot(layer, f"dim_{name}")

    def write(df: DataFrame, name: str) -> Callable[[], None]:
        return lambda: _reload(warehouse, df, "dds", name)

    _reload(warehouse, marts.monthly_sales(by_seller), "dds", "sales_trends_by_month")
    monthly = warehouse.snapshot("dds", "sales_trends_by_month")
    tables = {
        "sales_with_moving_average": marts.moving_average(monthly),
        "sales_growth_by_month": marts.growth(monthly),
        "average_sales_by_day_of_week": marts.average_sales_by_day_of_week(by_seller, labels),
        "average_sales_by_seller": marts.average_sales_by_seller(by_seller, dim("seller")),
        "sales_by_service": marts.sales_by_service(by_service, dim("service")),
        "customer_age_groups": marts.customer_age_groups(customers, buckets),
        "sales_by_country_and_region": marts.sales_by_country_and_region(
            by_place, dim("country"), dim("resort")
        ),
        "sales_by_employee": marts.sales_by_employee(by_seller, dim("seller")),
    }
    side_by_side([write(df, name) for name, df in tables.items()])


def initial_load(source: TableSource, warehouse: Warehouse, measure: str = "price") -> None:
    """Snapshot, stage, star and marts."""
    _load_sales(source, warehouse, measure, lambda: load_marts(warehouse, "nds"))


def repeated_load(
    source: TableSource,
    warehouse: Warehouse,
    measure: str = "price",
    labels: tuple[str, ...] = SUNDAY_FIRST,
    buckets: AgeBuckets = REPEATED,
) -> None:
    """The full refresh: stage, ``nds``, ``ods``, then the marts over ``ods``.

    ``labels=SHIFTED`` gives the weekday names one day off, as a repeated load
    that takes day 0 for Monday shows them.
    """

    def then() -> None:
        copy_layer(warehouse, "nds", "ods")
        load_marts(warehouse, "ods", labels, buckets)

    _load_sales(source, warehouse, measure, then)


def source_drift(source: TableSource, warehouse: Warehouse) -> DataFrame:
    """Whether the source's invoice lines outnumber the staged ones, or the reverse.

    The source counts its own rows; none is fetched for that.
    """
    name = STAGE_NAMES["invoice_line"]
    request = changes.pick(changes.latest_request(warehouse.ledger.rows(), name))
    staged = warehouse.staged(name, SALES_TABLES["invoice_line"], request)
    return watermark.drift_from(source.count("invoice_line"), staged)


def last_load_finished(warehouse: Warehouse) -> bool:
    """Whether the newest load went through to its marts."""
    loads = warehouse.ledger.rows()
    newest = changes.pick(changes.latest_request(loads, LEDGER_TABLE))
    done = (F.col("request_id") == newest) & (F.col("status") == ledger.SUCCESS)
    return newest is not None and not loads.where(done).isEmpty()


def value_drift(source: TableSource, warehouse: Warehouse) -> DataFrame:
    """Ranges of invoice numbers whose lines differ from the staged ones, however many there are."""
    name, schema = STAGE_NAMES["invoice_line"], SALES_TABLES["invoice_line"]
    request = changes.pick(changes.latest_request(warehouse.ledger.rows(), name))
    staged = warehouse.staged(name, schema, request).select(*schema.fieldNames())
    lines = read_table(source, "invoice_line").select(*schema.fieldNames())
    return drift.range_drift(lines, staged, ["inv_id", "service_id"])


def refresh_if_changed(
    source: TableSource, warehouse: Warehouse, values: bool = False, **options
) -> bool:
    """Load anew when the row counts differ or the newest load did not finish.

    ``values=True`` also reads the lines of both sides, and loads when they
    differ in anything else.
    """
    changed = (
        not last_load_finished(warehouse)
        or source_drift(source, warehouse).first()["changed"]
    )
    if not changed and values:
        with job_scratch(warehouse.spark):
            changed = not value_drift(source, warehouse).isEmpty()
    if changed:
        repeated_load(source, warehouse, **options)
    return changed


# --- arriving files ---------------------------------------------------------
def stage_file(
    warehouse: Warehouse,
    record: RecordType,
    path: str,
    filename: str | None = None,
    request_id: str | None = None,
) -> str:
    """Stage one XML file under a request of its own; a bad file fails that request."""
    name = filename or path.rstrip("/").rsplit("/", 1)[-1]
    request = warehouse.ledger.open(record.table, name, request_id)
    try:
        rows = read_xml(warehouse.spark, path, record)
        with job_scratch(warehouse.spark):
            if record is EMPLOYEE_XML:
                rows = in_document_order(rows, next_record_id(warehouse, request))
            warehouse.append_stage(rows, record.table, request)
    except Exception:
        warehouse.ledger.close(request, ledger.FAILED)
        raise
    warehouse.ledger.close(request, ledger.SUCCESS)
    return request


def in_document_order(rows: DataFrame, first: int) -> DataFrame:
    """Records numbered from ``first``: by file, then as they stand in the file.

    One task reads a file from its start to its end, so the position in the
    task follows the document, whichever task that is.
    """
    placed = rows.select(
        "*", F.col("_metadata.file_path").alias("_file"), keys.task_position().alias("_at")
    )
    numbered = keys.number_rows(placed, ["_file", "_at"], "record_id", first)
    return numbered.select("record_id", *rows.columns)


RECORDS = {"region": REGION_XML, "companies": COMPANY_XML, "employee": EMPLOYEE_XML}


def register_new_file(warehouse: Warehouse, folder: str) -> str | None:
    """Open a request for the first file of ``folder`` that is not loaded yet.

    For a folder polled by a scheduler instead of a stream: the ledger is then
    the only memory. Names decide the table, regions before companies before
    employees, then the alphabet; a name without a table is left alone.
    """
    listing = list_files(warehouse.spark, folder)
    order = F.array_position(F.array(*[F.lit(route) for route in RECORDS]), F.col("route"))
    first = (
        ledger.new_files(listing, warehouse.ledger.rows())
        .withColumn("route", route_by_name(F.col("filename")))
        .where(F.col("route").isNotNull())
        .orderBy(order, "filename")
        .first()
    )
    if first is None:
        return None
    return warehouse.ledger.open(RECORDS[first["route"]].table, first["filename"])


def stage_running(
    warehouse: Warehouse, record: RecordType, folder: str, archive: str | None = None
) -> str | None:
    """Stage the file of the table's running request, then move it to ``archive``."""
    running = warehouse.ledger.running(record.table).first()
    if running is None:
        return None
    path = f"{folder.rstrip('/')}/{running['filename']}"
    stage_file(warehouse, record, path, running["filename"], running["request_id"])
    if archive:
        move_file(warehouse.spark, path, archive)
    return running["request_id"]


def next_record_id(warehouse: Warehouse, request_id: str) -> int:
    """One past the record ids of the last employee file, which hold the greatest."""
    earlier = warehouse.ledger.rows().where(
        (F.col("request_id") != request_id) & (F.col("status") == ledger.SUCCESS)
    )
    last = changes.pick(changes.latest_request(earlier, EMPLOYEE_XML.table))
    staged = staged_file(warehouse, EMPLOYEE_XML, last)
    return (staged.agg(F.max("record_id")).first()[0] or 0) + 1


def _staged_columns(record: RecordType) -> StructType:
    if record is EMPLOYEE_XML:
        return struct(" ".join(["record_id:long", *record.stage_columns]))
    return text_only(record.stage_columns)


def staged_file(warehouse: Warehouse, record: RecordType, request_id: str | None) -> DataFrame:
    """The staged rows of one file."""
    return warehouse.staged(record.table, _staged_columns(record), request_id)


def staged_files(warehouse: Warehouse, record: RecordType) -> DataFrame:
    """The staged rows of all files of a kind; a join by request prunes the folders read."""
    return warehouse.stage(record.table, _staged_columns(record))


def newest_file(warehouse: Warehouse, record: RecordType) -> tuple[str | None, DataFrame]:
    """The newest request of a kind of file, whatever its status, and its rows."""
    request = changes.pick(changes.latest_request(warehouse.ledger.rows(), record.table))
    return request, staged_file(warehouse, record, request)


def apply_regions(warehouse: Warehouse) -> None:
    """Upsert the newest region file into the regions table."""
    _, rows = newest_file(warehouse, REGION_XML)
    with job_scratch(warehouse.spark):
        warehouse.merge_keyed(
            reference.typed_regions(rows), "nds", REGIONS_TABLE, ["id_region"], REGION_NDS
        )


def apply_companies(warehouse: Warehouse, dedupe: bool = True) -> None:
    """Append the newest company file, after the types and industries it brings."""
    request, rows = newest_file(warehouse, COMPANY_XML)
    if request is None:
        return
    types = warehouse.snapshot("nds", TYPE_COMPANY_TABLE, TYPE_COMPANY)
    industries = warehouse.snapshot("nds", TYPE_INDUSTRY_TABLE, TYPE_INDUSTRY)
    with job_scratch(warehouse.spark):
        new_types = reference.new_company_types(rows, types, dedupe)
        new_industries = reference.new_company_industries(rows, industries, dedupe)
        warehouse.replace(types.unionByName(new_types), "nds", TYPE_COMPANY_TABLE)
        warehouse.replace(industries.unionByName(new_industries), "nds", TYPE_INDUSTRY_TABLE)
    companies = reference.typed_companies(
        rows,
        warehouse.snapshot("nds", TYPE_COMPANY_TABLE, TYPE_COMPANY),
        warehouse.snapshot("nds", TYPE_INDUSTRY_TABLE, TYPE_INDUSTRY),
    )
    tagged = companies.select(F.lit(request).alias("request_id"), "*")
    warehouse.append_batch(tagged, "nds", COMPANIES_TABLE)


def companies(warehouse: Warehouse) -> DataFrame:
    schema = struct("request_id")
    for field in COMPANY_NDS.fields:
        schema = schema.add(field)
    return warehouse.batches("nds", COMPANIES_TABLE, schema).drop("request_id")


def employee_log(warehouse: Warehouse) -> DataFrame:
    return warehouse.batches("nds", LOG_TABLE, EMPLOYEE_LOG)


def next_employee_request(warehouse: Warehouse) -> str | None:
    """The oldest successful employee file that is not in the log."""
    requests = warehouse.ledger.rows().where(F.col("table_name") == EMPLOYEE_XML.table)
    return changes.pick(
        changes.next_request(requests, requests, warehouse.batch_ids("nds", LOG_TABLE))
    )


def apply_employees(warehouse: Warehouse, strict_text_key: bool = True) -> str | None:
    """Take the oldest waiting employee request into the log and current tables.

    The log is written last: until its batch is there the request still waits,
    so a run that broke off is done again from the start, with the same rows.
    """
    request = next_employee_request(warehouse)
    if request is None:
        return None
    with job_scratch(warehouse.spark):
        rows = staged_file(warehouse, EMPLOYEE_XML, request)
        found = changes.classify(rows, employee_log(warehouse), strict_text_key)
        _apply_changes(warehouse, [request], found, ["record_id"])
    return request


def _apply_changes(
    warehouse: Warehouse, requests: Sequence[str], found: DataFrame, ties: Sequence[str]
) -> None:
    """Current tables and log after the changes that ``requests`` bring."""
    batch = materialize(found, "changes")
    logged = {row[0] for row in batch.select("request_id").distinct().collect()}
    if empty := [request for request in requests if request not in logged]:
        warehouse.ledger.close_all(empty, ledger.EMPTY)
    if not logged:
        return
    newer = materialize(
        employees.advance(batch, current_employment(warehouse), ties), "newer-entries"
    )

    def write(table: str, update: DataFrame, schema: StructType) -> Callable[[], object]:
        return lambda: warehouse.merge_keyed(
            update, "nds", table, [employees.KEY], schema, check_unique=False
        )

    # Should one of the two writes fail, the next try decides by the employment
    # table: as it was, or as this batch left it, it picks the same rows.
    side_by_side(
        [
            write(PERSONS_TABLE, employees.persons_of(newer), PERSONS),
            write(EMPLOYMENT_TABLE, employees.employment_of(newer), EMPLOYMENT),
        ]
    )
    warehouse.append_batch(batch.select(*EMPLOYEE_LOG.fieldNames()), "nds", LOG_TABLE)


def current_persons(warehouse: Warehouse) -> DataFrame:
    return warehouse.keyed("nds", PERSONS_TABLE, PERSONS)


def current_employment(warehouse: Warehouse) -> DataFrame:
    return warehouse.keyed("nds", EMPLOYMENT_TABLE, EMPLOYMENT)


def current_regions(warehouse: Warehouse) -> DataFrame:
    return warehouse.keyed("nds", REGIONS_TABLE, REGION_NDS)


def rebuild_employees(warehouse: Warehouse) -> None:
    """Current tables anew from the whole log, for a log filled by other means."""
    with job_scratch(warehouse.spark):
        newest = materialize(employees.newest_entries(employee_log(warehouse)), "newest-entries")
        key = [employees.KEY]
        warehouse.replace_keyed(employees.persons_of(newest), "nds", PERSONS_TABLE, key)
        warehouse.replace_keyed(employees.employment_of(newest), "nds", EMPLOYMENT_TABLE, key)


REJECTS = struct("request_id record_id:long rejected raw")


def rejected_employees(warehouse: Warehouse) -> DataFrame:
    """Employee records that did not parse: their request, the columns at fault, all values as JSON."""
    return warehouse.batches("rejects", LOG_TABLE, REJECTS)


def _set_aside(warehouse: Warehouse, staged: DataFrame, most: float) -> DataFrame:
    """``staged`` without the records that do not parse; those go to the rejects under their request."""
    read = staged.drop("turn")
    _, rejects = split_rejects(read, EMPLOYEE_NDS, keep=("request_id", "record_id"), most=most)
    named = rejects.withColumns(
        {"record_id": F.col("record_id").cast("long"), "rejected": F.array_join("rejected", ",")}
    )
    warehouse.append_batch(named.select(*REJECTS.fieldNames()), "rejects", LOG_TABLE)
    left = staged.join(rejects.select("request_id", "record_id"), ["request_id", "record_id"], "left_anti")
    # Written, or Catalyst would move the strict casts that follow below the join.
    return materialize(left, "accepted")


def apply_all_employees(
    warehouse: Warehouse, strict_text_key: bool = True, most_rejected: float | None = None
) -> list[str]:
    """Work off the queue in one pass; the applied requests, oldest first.

    The same tables as one request at a time, with one look at the log, one merge of each
    current table and one write of all batches. A value that does not
    cast fails the pass before anything is written, unless ``most_rejected`` sets
    the share of records that may be left out; they go to :func:`rejected_employees`.
    """
    requests = warehouse.ledger.rows().where(F.col("table_name") == EMPLOYEE_XML.table)
    waiting = changes.waiting_requests(
        requests, requests, warehouse.batch_ids("nds", LOG_TABLE)
    )
    # One row per file that waits.
    queue = [row["request_id"] for row in waiting.orderBy("turn").collect()]
    if not queue:
        return []
    with job_scratch(warehouse.spark):
        waiting = materialize(waiting, "waiting")
        staged = staged_files(warehouse, EMPLOYEE_XML).join(waiting, "request_id")
        if most_rejected is not None:
            staged = _set_aside(warehouse, staged, most_rejected)
        found = changes.classify_backlog(staged, employee_log(warehouse), strict_text_key)
        _apply_changes(warehouse, queue, found, ["turn", "record_id"])
    return queue


# --- emissions --------------------------------------------------------------
EMISSIONS_LAYER = "emissions"
EMISSION_SCHEMAS = {
    "address": ADDRESS,
    "organizations": ORGANIZATIONS,
    "organizations_x_address": ORGANIZATIONS_X_ADDRESS,
    "object_category": OBJECT_CATEGORY,
    "objects": OBJECTS,
    "environmental_emissions": ENVIRONMENTAL_EMISSIONS,
}


KEYED_TABLES = ("address", "organizations", "organizations_x_address", "object_category")


def stored_emissions(warehouse: Warehouse) -> dict[str, DataFrame]:
    """The tables whose ids later runs keep; none before the first run that succeeded."""
    loads = warehouse.ledger.rows().where(F.col("table_name") == EMISSIONS_LAYER)
    if loads.where(F.col("status") == ledger.SUCCESS).isEmpty():
        return {}
    return {
        table: warehouse.read_committed(EMISSIONS_LAYER, table, EMISSION_SCHEMAS[table])
        for table in KEYED_TABLES
    }


def next_start(stored: Mapping[str, DataFrame]) -> int:
    """The first surrogate key no earlier run has used."""
    tables = [stored[t].select("id") for t in KEYED_TABLES[:3] if t in stored]
    last = reduce(DataFrame.union, tables).agg(F.max("id")).first()[0] if tables else None
    return (last or 0) + 1


def unknown_objects(tables: Mapping[str, DataFrame], warehouse: Warehouse) -> dict[str, DataFrame]:
    """The registry without the objects that an earlier run has stored."""
    facts = warehouse.read_committed(
        EMISSIONS_LAYER, "environmental_emissions", ENVIRONMENTAL_EMISSIONS
    )
    fresh = watermark.rows_not_loaded(tables["nvosentities"], facts, ["nvos_id"])
    return {**tables, "nvosentities": fresh}


def emissions_job(
    tables: Mapping[str, DataFrame],
    warehouse: Warehouse,
    nvos_ids: Sequence | None = None,
    start: int | None = None,
    only_new: bool = False,
) -> str:
    """Normalise all objects, or the given ones, and append the six tables together.

    Readers see none of the six before the request succeeds. What an earlier run
    has stored keeps its id; further keys go on from the last one in use unless
    ``start`` is given. ``only_new`` leaves out objects that are stored already.
    """
    request = warehouse.ledger.open(EMISSIONS_LAYER)
    try:
        with job_scratch(warehouse.spark):
            stored = stored_emissions(warehouse)
            if only_new:
                tables = unknown_objects(tables, warehouse)
            result = emissions.normalise(
                extract_emissions(tables, nvos_ids),
                next_start(stored) if start is None else start,
                stored=stored,
            )
            ordered = {
                name: getattr(result, name).select(*schema.fieldNames())
                for name, schema in EMISSION_SCHEMAS.items()
            }
            warehouse.write_together(ordered, EMISSIONS_LAYER, request)
    except Exception:
        warehouse.ledger.close(request, ledger.FAILED)
        raise
    warehouse.ledger.close(request, ledger.SUCCESS)
    return request
