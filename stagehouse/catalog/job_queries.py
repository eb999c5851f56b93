"""Composed jobs, XML files and the folder stream as queries.

Each one writes the XML files or tables it needs, out of the given ones, to the
shared scratch folder, runs the job there and returns a table it made.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.catalog import inputs
from stagehouse.catalog.queries import employee_tables, plain, query
from stagehouse.functions import dates
from stagehouse.functions.address import PARTS
from stagehouse.functions.buckets import HISTORY
from stagehouse.operators import changes
from stagehouse.plans import employees, increments, jobs
from stagehouse.schemas import (
    COMPANY_NDS,
    COMPANY_XML,
    EMPLOYEE_XML,
    PERSONS,
    REGION_NDS,
    REGION_XML,
    SALES_TABLES,
    RecordType,
)
from stagehouse.session import materialize, scratch_path
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources import xml
from stagehouse.sources.tables import FrameSource
from stagehouse.streaming.folder import watch_folder
from stagehouse.streaming.poll import watch_source


# What ``job_incremental_load`` shows of each mart: its value and its key.
MART_ENTRIES = {
    "sales_trends_by_month": ("total_sales", "sale_year", "sale_month"),
    "sales_with_moving_average": ("moving_average", "sale_year", "sale_month"),
    "sales_growth_by_month": ("sales_growth", "sale_year", "sale_month"),
    "average_sales_by_day_of_week": ("average_sale", "day_of_week"),
    "average_sales_by_seller": ("average_sale", "sales_person"),
    "sales_by_service": ("total_sales", "service"),
    "customer_age_groups": ("customer_count", "age_group"),
    "sales_by_country_and_region": ("total_sales", "country", "resort", "invoice_date"),
    "sales_by_employee": ("total_price", "sales_person", "invoice_date"),
}
ROOT = "records"


def new_warehouse(spark: SparkSession) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, "warehouse"))


def write_xml(rows: DataFrame, record: RecordType) -> str:
    """A folder of XML files with the staged ``rows`` as records.

    Spark's first task leaves a file even when it has no rows, and then one without
    bytes, which no load takes; it becomes a document without records.
    """
    spark, folder = rows.sparkSession, scratch_path(rows.sparkSession, "files")
    elements = [F.col(name).alias(element) for element, name in record.elements.items()]
    (
        rows.select(*elements)
        .write.format("xml")
        .options(rootTag=ROOT, rowTag=xml.RECORD)
        .save(folder)
    )
    for path in xml.empty_files(spark, folder):
        xml.write_no_records(spark, path, ROOT)
    return f"{folder}/*.xml"


def dated_employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged employees with a date on every entry, so the newest one is plain."""
    dated = F.coalesce(F.col("date_devations"), F.date_format("_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    times = inputs.given(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"), F.col("ts").alias("_ts")
    )
    return (
        inputs.employee_stage(spark, sf_dir)
        .join(times, "record_id")
        .withColumn("date_devations", dated)
        .drop("_ts")
    )


def stage_batches(warehouse: Warehouse, record: RecordType, stage: DataFrame, name: str) -> None:
    """The three deliveries of a kind, each as files, staged in turn; one without rows never came."""
    for number in range(3):
        path = write_xml(changes.rows_of(stage, f"{name}-{number}"), record)
        if xml.has_records(warehouse.spark, path):
            jobs.stage_file(warehouse, record, path)


# --- XML files --------------------------------------------------------------
@query
def xml_employees(spark, sf_dir):
    path = write_xml(inputs.employee_stage(spark, sf_dir), EMPLOYEE_XML)
    return xml.read_xml(spark, path, EMPLOYEE_XML)


@query
def xml_employees_split(spark, sf_dir):
    path = write_xml(inputs.employee_stage(spark, sf_dir), EMPLOYEE_XML)
    return xml.read_xml(spark, path, EMPLOYEE_XML, split=True)


@query
def xml_regions(spark, sf_dir):
    path = write_xml(inputs.region_stage(spark, sf_dir), REGION_XML)
    return xml.read_xml(spark, path, REGION_XML)


@query
def xml_companies(spark, sf_dir):
    path = write_xml(inputs.company_stage(spark, sf_dir), COMPANY_XML)
    return xml.read_xml(spark, path, COMPANY_XML)


# --- file jobs --------------------------------------------------------------
@query
def job_regions_file(spark, sf_dir):
    """All batches of regions as files; the newest is upserted into those known before."""
    warehouse = new_warehouse(spark)
    known = inputs.region_target(spark, sf_dir).select(*REGION_NDS.fieldNames())
    warehouse.replace_keyed(known, "nds", jobs.REGIONS_TABLE, ["id_region"])
    stage_batches(warehouse, REGION_XML, inputs.region_stage(spark, sf_dir), "reg")
    jobs.apply_regions(warehouse)
    return plain(jobs.current_regions(warehouse))


@query
def job_companies_file(spark, sf_dir):
    warehouse = new_warehouse(spark)
    warehouse.replace(inputs.type_company(spark, sf_dir), "nds", jobs.TYPE_COMPANY_TABLE)
    warehouse.replace(inputs.type_industry(spark, sf_dir), "nds", jobs.TYPE_INDUSTRY_TABLE)
    stage_batches(warehouse, COMPANY_XML, inputs.company_stage(spark, sf_dir), "com")
    jobs.apply_companies(warehouse)
    return plain(jobs.companies(warehouse).select(*COMPANY_NDS.fieldNames()))


@query
def job_employees_files(spark, sf_dir):
    """Three deliveries in turn; the persons after the last."""
    warehouse = new_warehouse(spark)
    stage = dated_employees(spark, sf_dir)
    stage_batches(warehouse, EMPLOYEE_XML, stage, "req")
    jobs.apply_all_employees(warehouse)
    return jobs.current_persons(warehouse)


@query
def upsert_partitions(spark, sf_dir):
    """Persons of the old log in a keyed table, then all later batches merged into it."""
    warehouse = new_warehouse(spark)
    stage, log, requests = employee_tables(spark, sf_dir)
    before = employees.current_persons(log)
    warehouse.replace_keyed(before, "nds", jobs.PERSONS_TABLE, [employees.KEY])
    found = materialize(changes.capture_backlog(stage, log, requests).drop("turn"), "found")
    after = employees.current_persons(log.unionByName(found), ids=found)
    warehouse.merge_keyed(after, "nds", jobs.PERSONS_TABLE, [employees.KEY], PERSONS)
    return jobs.current_persons(warehouse)


@query
def folder_stream(spark, sf_dir):
    """The same employees arriving in a watched folder; the log's entries."""
    warehouse = new_warehouse(spark)
    stage = dated_employees(spark, sf_dir).repartition(2, "id_employee")
    folder = write_xml(stage, EMPLOYEE_XML).rsplit("/", 1)[0]
    stream = watch_folder(
        spark,
        folder,
        warehouse,
        scratch_path(spark, "checkpoint"),
        max_files=2,
        once=True,
        names={".xml": "employee"},
    )
    stream.awaitTermination()
    log = jobs.employee_log(warehouse)
    return log.select("id_employee", "fio", "id_region", "birth_date", "date_devations")


# --- sales and emissions jobs -----------------------------------------------
@query
def job_initial_load(spark, sf_dir):
    warehouse = new_warehouse(spark)
    jobs.initial_load(inputs.sales_source(spark, sf_dir), warehouse)
    return plain(warehouse.snapshot("dds", "sales_by_employee"))


@query
def job_repeated_load(spark, sf_dir):
    """A load before any invoice came, then a poll that finds the source has grown."""
    warehouse = new_warehouse(spark)
    source = inputs.sales_source(spark, sf_dir)
    before = {table: source.load(table) for table in SALES_TABLES}
    before["invoice_line"] = spark.createDataFrame([], before["invoice_line"].schema)
    jobs.repeated_load(FrameSource(before), warehouse)
    watch_source(
        spark,
        source,
        warehouse,
        scratch_path(spark, "checkpoint"),
        once=True,
        labels=dates.SHIFTED,
    ).awaitTermination()
    return warehouse.snapshot("dds", "average_sales_by_day_of_week")


@query
def job_incremental_load(spark, sf_dir):
    """A first load, one of what came since, one that finds late rows; all nine marts, a row per entry.

    Lines come before their customers, and some invoices come late with small ids.
    """
    warehouse = new_warehouse(spark)
    source = inputs.sales_source(spark, sf_dir)
    tables = {table: source.load(table) for table in SALES_TABLES}
    last, customers = tables["sales"].agg(F.max("inv_id"), F.max("cust_id")).first()

    def part(share: float) -> FrameSource:
        some = dict(tables)
        for table in ("invoice_line", "sales"):
            early = (F.col("inv_id") <= share * last) & (F.col("inv_id") % 41 != 0)
            some[table] = tables[table].where(early)
        some["customer"] = tables["customer"].where(F.col("cust_id") <= share * customers)
        return FrameSource(some)

    increments.incremental_load(part(0.5), warehouse, buckets=HISTORY)
    increments.incremental_load(part(0.9), warehouse, buckets=HISTORY)
    increments.incremental_load(source, warehouse, reconcile=True, buckets=HISTORY)

    def entries(mart: str, value: str, *columns: str) -> DataFrame:
        rows = warehouse.snapshot("dds", mart)
        day = lambda c: F.date_format(c, "yyyy-MM-dd") if c == "invoice_date" else F.col(c).cast("string")
        key = F.concat_ws("|", *[F.coalesce(day(c), F.lit("-")) for c in columns])
        return rows.select(F.lit(mart).alias("mart"), key.alias("key"), F.col(value).cast("double").alias("value"))

    marts = [entries(mart, *columns) for mart, columns in MART_ENTRIES.items()]
    return reduce(DataFrame.unionAll, marts)


@query
def job_emissions_incremental(spark, sf_dir):
    """Two thirds of the registry, then what came since: every key and fact of both runs."""
    warehouse = new_warehouse(spark)
    tables = inputs.emission_tables(spark, sf_dir)
    early = tables["nvosentities"].where(F.col("nvos_id") % 3 != 0)
    jobs.emissions_job({**tables, "nvosentities": early}, warehouse)
    jobs.emissions_job(tables, warehouse, only_new=True)

    def stored(table, *columns):
        rows = warehouse.read_committed(jobs.EMISSIONS_LAYER, table, jobs.EMISSION_SCHEMAS[table])
        key = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
        ident = "nvos_id" if table == "environmental_emissions" else "id"
        return rows.select(F.lit(table).alias("table_name"), F.col(ident).alias("id"), key.alias("key"))

    return (
        stored("address", *PARTS)
        .union(stored("organizations", "org_name", "org_inn"))
        .union(stored("organizations_x_address", "organization_id", "address_id"))
        .union(stored("environmental_emissions", "org_address_id"))
    )


@query
def job_emissions(spark, sf_dir):
    warehouse = new_warehouse(spark)
    jobs.emissions_job(inputs.emission_tables(spark, sf_dir), warehouse)
    table = "environmental_emissions"
    return warehouse.read_committed(jobs.EMISSIONS_LAYER, table, jobs.EMISSION_SCHEMAS[table])


