"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stagehouse import ledger
from stagehouse.catalog import inputs
from stagehouse.catalog.inputs import given
from stagehouse.functions import address, dates, text
from stagehouse.functions.buckets import REPEATED
from stagehouse.operators import changes, drift, filters, keys, merge, typing, watermark
from stagehouse.operators.lookup import lookup, lookup_codes_by_name
from stagehouse.plans import emissions, employees, marts, reference, star
from stagehouse.schemas import (
    COMPANY_NDS,
    COMPANY_XML,
    EMPLOYEE_NDS,
    EMPLOYEE_XML,
    REGION_NDS,
    REGION_XML,
    SALES_TABLES,
    STAGE_NAMES,
)
from stagehouse.session import materialize, scratch_path
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.emissions import extract_emissions
from stagehouse.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def plain(df: DataFrame) -> DataFrame:
    """Types both engines print alike: whole decimals as bigint, others as double."""

    def column(field: T.StructField) -> Column:
        kind = field.dataType
        if isinstance(kind, T.DecimalType):
            return F.col(field.name).cast("long" if kind.scale == 0 else "double")
        if isinstance(kind, (T.IntegerType, T.ShortType)):
            return F.col(field.name).cast("long")
        return F.col(field.name)

    return df.select(*[column(f).alias(f.name) for f in df.schema.fields])


# --- scans and staging ------------------------------------------------------
def _scan(table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(read_table(inputs.sales_source(spark, sf_dir), table))

    return run


def _stage(table: str) -> Query:
    """Stage the table as a batch and read the batch back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        warehouse = Warehouse(spark, scratch_path(spark, "stage"))
        rows = read_table(inputs.sales_source(spark, sf_dir), table)
        warehouse.append_stage(rows, STAGE_NAMES[table], f"batch-{table}")
        return plain(warehouse.stage(STAGE_NAMES[table], SALES_TABLES[table]))

    return run


for _table in SALES_TABLES:
    QUERIES[f"scan_{_table}"] = _scan(_table)
    QUERIES[f"stage_{_table}"] = _stage(_table)


@query
def tag_batch(spark, sf_dir):
    rows = read_table(inputs.sales_source(spark, sf_dir), "invoice_line")
    return typing.tag_batch(rows, "batch-1")


@query
def emissions_extract(spark, sf_dir):
    return plain(extract_emissions(inputs.emission_tables(spark, sf_dir)))


@query
def filter_in(spark, sf_dir):
    tables = inputs.emission_tables(spark, sf_dir)
    return plain(filters.filter_in(tables["nvosentities"], "category", ["I", "III"]))


# --- ledger -----------------------------------------------------------------
@query
def ledger_running(spark, sf_dir):
    return ledger.running(inputs.file_ledger(spark, sf_dir), EMPLOYEE_XML.table)


@query
def filter_not_in_status(spark, sf_dir):
    return ledger.loaded_files(inputs.file_ledger(spark, sf_dir))


@query
def new_files_anti_join(spark, sf_dir):
    return ledger.new_files(
        inputs.file_listing(spark, sf_dir), inputs.file_ledger(spark, sf_dir)
    )


@query
def route_by_name(spark, sf_dir):
    listing = inputs.file_listing(spark, sf_dir)
    return listing.select("filename", text.route_by_name(F.col("filename")).alias("route"))


@query
def ledger_status_update(spark, sf_dir):
    rows = inputs.file_ledger(spark, sf_dir)
    request_id = changes.pick(ledger.running(rows, REGION_XML.table))
    return ledger.with_status(rows, request_id, ledger.SUCCESS)


@query
def latest_request(spark, sf_dir):
    return changes.latest_request(inputs.file_ledger(spark, sf_dir), COMPANY_XML.table)


# --- typed projection and scalar functions ----------------------------------
@query
def typed_projection(spark, sf_dir):
    stage = inputs.employee_stage(spark, sf_dir)
    return plain(typing.to_typed(stage, EMPLOYEE_NDS, keep=("request_id", "record_id")))


@query
def typed_quarantine(spark, sf_dir):
    """Employees, some with regions or dates that do not parse: what is loaded and what is set aside."""
    stage = inputs.employee_stage(spark, sf_dir)
    number = F.col("record_id").cast("long")
    damaged = stage.withColumns(
        {
            "id_region": F.when(number % 11 == 0, "n/a").otherwise(F.col("id_region")),
            "birth_date": F.when(number % 13 == 0, "soon").otherwise(F.col("birth_date")),
        }
    )
    good, rejects = typing.split_rejects(damaged, EMPLOYEE_NDS, keep=("record_id",), most=0.5)
    loaded = good.select(
        "record_id", "fio", "id_region", F.lit("").alias("rejected"), F.lit(None).cast("string").alias("raw_region")
    )
    value = lambda name: F.get_json_object("raw", f"$.{name}")
    aside = rejects.select(
        "record_id", value("fio"), F.lit(None).cast("long"), F.array_join("rejected", ","), value("id_region")
    )
    return loaded.unionAll(aside)


@query
def typed_regions(spark, sf_dir):
    return plain(reference.typed_regions(inputs.region_stage(spark, sf_dir)))


@query
def blank_to_null_cast(spark, sf_dir):
    stage = inputs.region_stage(spark, sf_dir)
    return stage.select(
        "id_region", text.blank_to_null(F.col("f_value")).cast("long").alias("f_value")
    )


@query
def blank_to_null_frame(spark, sf_dir):
    tables = inputs.emission_tables(spark, sf_dir)
    return plain(text.blanks_to_null(tables["nvosentities"]))


@query
def null_to_zero_measures(spark, sf_dir):
    extract = extract_emissions(inputs.emission_tables(spark, sf_dir))
    return typing.fill_measures(
        extract.select(
            "nvos_id", *[text.parse_decimal(F.col(m)).alias(m) for m in typing.MEASURES]
        )
    )


@query
def split_full_name(spark, sf_dir):
    parts = ("first_name", "last_name", "sur_name")
    return inputs.employee_stage(spark, sf_dir).select(
        "record_id",
        *[text.name_part(F.col("fio"), i).alias(name) for i, name in enumerate(parts, start=1)],
    )


def _address_part(part: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        extract = extract_emissions(inputs.emission_tables(spark, sf_dir))
        return extract.select("nvos_id", address.address_part(F.col("org_address"), part))

    return run


QUERIES["addr_postcode"] = _address_part("postcode")
QUERIES["addr_region"] = _address_part("region")
QUERIES["addr_locality"] = _address_part("locality")
QUERIES["addr_street"] = _address_part("street")
QUERIES["addr_house"] = _address_part("house_number")


@query
def org_name_extract(spark, sf_dir):
    extract = extract_emissions(inputs.emission_tables(spark, sf_dir))
    name = text.blank_to_null(text.org_name(F.col("org_name")))
    return extract.select("nvos_id", name.alias("org_name"))


@query
def digits_only(spark, sf_dir):
    extract = extract_emissions(inputs.emission_tables(spark, sf_dir))
    digits = text.blank_to_null(text.digits_only(F.col("inn")))
    return extract.select("nvos_id", digits.alias("inn"))


@query
def collapse_whitespace(spark, sf_dir):
    rows = inputs.emission_tables(spark, sf_dir)["nvosentities"]
    return rows.select(
        "nvos_id",
        text.collapse_whitespace(F.col("name")).alias("object_name"),
        text.collapse_whitespace(F.col("location")).alias("object_location"),
    )


@query
def parse_ru_decimal(spark, sf_dir):
    rows = inputs.emission_tables(spark, sf_dir)["emissions"]
    return rows.select(
        "nvos_id", text.parse_decimal(F.col("total_emission")).alias("emission_total")
    )


@query
def category_recode(spark, sf_dir):
    rows = inputs.emission_tables(spark, sf_dir)["nvosentities"].select("nvos_id", "category")
    return emissions.category_recode(rows, "category")


# --- lookups, set operations, merges ----------------------------------------
@query
def latest_request_rows(spark, sf_dir):
    return reference.latest_rows(
        inputs.region_stage(spark, sf_dir), inputs.region_ledger(spark, sf_dir), REGION_XML.table
    )


@query
def lookup_codes(spark, sf_dir):
    return plain(
        lookup_codes_by_name(
            inputs.company_stage(spark, sf_dir),
            inputs.type_company(spark, sf_dir),
            inputs.type_industry(spark, sf_dir),
        ).select("request_id", "id_company", "type_company_cd", "type_industry_cd")
    )


QUERIES["lookup_codes_by_name"] = QUERIES.pop("lookup_codes")


@query
def lookup_left(spark, sf_dir):
    stage = inputs.sales_stage(spark, sf_dir)
    invoices = stage["sales"].select("inv_id", F.col("cust_id"))
    people = stage["customer"].where(F.col("age") >= 18)
    return lookup(invoices, "cust_id", people, "cust_id", "last_name")


@query
def distinct_type_company(spark, sf_dir):
    return reference.distinct_values(inputs.company_stage(spark, sf_dir), "type_company")


def _batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    stage = inputs.employee_stage(spark, sf_dir)
    rows = changes.rows_of(stage, "req-1")
    return rows.select(F.col("id_employee").cast("long").alias("id_employee"))


@query
def except_new_ids(spark, sf_dir):
    log = inputs.employee_log(spark, sf_dir)
    return changes.except_distinct(_batch_ids(spark, sf_dir), changes.live_ids(log))


@query
def intersect_known_ids(spark, sf_dir):
    log = inputs.employee_log(spark, sf_dir)
    return changes.intersect_distinct(_batch_ids(spark, sf_dir), changes.live_ids(log))


@query
def append_new_dim_values(spark, sf_dir):
    rows = reference.latest_rows(
        inputs.company_stage(spark, sf_dir),
        inputs.company_ledger(spark, sf_dir),
        COMPANY_XML.table,
    )
    dim = inputs.type_industry(spark, sf_dir)
    return merge.append_new_values(
        dim, rows.select("type_industry"), "type_indystry_name", "type_industry_cd"
    )


@query
def insert_ignore(spark, sf_dir):
    stage = inputs.sales_stage(spark, sf_dir)
    adults = stage["customer"].where(F.col("age") >= 18).select("cust_id", "last_name")
    everyone = stage["customer"].select("cust_id", F.col("first_name").alias("last_name"))
    return merge.insert_ignore(adults, everyone, ["cust_id"])


@query
def upsert_regions(spark, sf_dir):
    return plain(
        reference.load_regions(
            inputs.region_stage(spark, sf_dir),
            inputs.region_ledger(spark, sf_dir),
            inputs.region_target(spark, sf_dir).select(*REGION_NDS.fieldNames()),
        )
    )


@query
def latest_per_key(spark, sf_dir):
    rows = inputs.employee_stage(spark, sf_dir).select(
        F.col("id_employee").cast("long").alias("id_employee"),
        "record_id",
        F.col("date_devations").cast("timestamp_ntz").alias("date_devations"),
        "fio",
    )
    return keys.latest_per_key(rows, ["id_employee"], "date_devations", ["record_id"])


@query
def surrogate_key_dense(spark, sf_dir):
    rows = inputs.company_stage(spark, sf_dir).select("company_name", "type_company", "id_region")
    return keys.surrogate_keys(rows, ["company_name", "type_company", "id_region"])


# --- change capture and current state ---------------------------------------
def employee_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return (
        inputs.employee_stage(spark, sf_dir),
        inputs.employee_log(spark, sf_dir),
        inputs.employee_ledger(spark, sf_dir),
    )


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.capture_changes(*employee_tables(spark, sf_dir))


@query
def cdc_next_request(spark, sf_dir):
    stage, log, requests = employee_tables(spark, sf_dir)
    return changes.next_request(requests, stage, log)


@query
def cdc_changes(spark, sf_dir):
    return _changes(spark, sf_dir)


@query
def cdc_create(spark, sf_dir):
    return changes.created(_changes(spark, sf_dir))


@query
def cdc_update(spark, sf_dir):
    return changes.updated(_changes(spark, sf_dir))


@query
def cdc_backlog(spark, sf_dir):
    """Every waiting request at once, as one after the other would log it."""
    return changes.capture_backlog(*employee_tables(spark, sf_dir)).drop("turn")


def _log_after(spark: SparkSession, sf_dir: str, batch: DataFrame | None = None) -> DataFrame:
    log = inputs.employee_log(spark, sf_dir)
    return log.unionByName(batch or _changes(spark, sf_dir))


@query
def current_persons(spark, sf_dir):
    return employees.current_persons(_log_after(spark, sf_dir))


@query
def current_employment(spark, sf_dir):
    return plain(employees.current_employment(_log_after(spark, sf_dir)))


@query
def upsert_latest(spark, sf_dir):
    """Persons of the old log, brought up to date for the ids of the new batch."""
    before = employees.current_persons(inputs.employee_log(spark, sf_dir))
    batch = materialize(_changes(spark, sf_dir), "batch")
    after = employees.current_persons(_log_after(spark, sf_dir, batch), ids=batch)
    return merge.upsert(before, after, ["id_employee"], check_unique=False)


@query
def load_companies(spark, sf_dir):
    companies, _, _ = reference.load_companies(
        inputs.company_stage(spark, sf_dir),
        inputs.company_ledger(spark, sf_dir),
        inputs.type_company(spark, sf_dir),
        inputs.type_industry(spark, sf_dir),
    )
    return plain(companies.select(*COMPANY_NDS.fieldNames()))


# --- source against copy ----------------------------------------------------
def _source_and_copy(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """All invoice lines, and those of the lower half of the order numbers."""
    source = read_table(inputs.sales_source(spark, sf_dir), "invoice_line")
    middle = given(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] // 2
    return source, source.where(F.col("inv_id") <= middle)


LINE_KEY = ["inv_id", "service_id"]


@query
def composite_key(spark, sf_dir):
    lines = read_table(inputs.sales_source(spark, sf_dir), "invoice_line")
    key = text.composite_key(F.col("inv_id"), F.col("service_id"))
    return lines.select("inv_id", "service_id", key.alias("compose_key"))


@query
def count_drift(spark, sf_dir):
    return watermark.count_drift(*_source_and_copy(spark, sf_dir))


@query
def high_watermark_key(spark, sf_dir):
    return watermark.high_watermark(_source_and_copy(spark, sf_dir)[1], LINE_KEY)


def _drifted_copy(lines: DataFrame) -> DataFrame:
    """As many rows, but in some spans of the order numbers lines are renumbered or changed."""
    here = F.floor(F.col("inv_id") / 512) % 7 == 3
    moved = F.when(here & (F.col("inv_id") % 5 == 0), F.col("inv_id") + 1_000_000_000)
    longer = F.when(here & (F.col("inv_id") % 5 == 1), F.col("days") + 1)
    return lines.select(
        F.coalesce(moved, "inv_id").alias("inv_id"), "service_id", F.coalesce(longer, "days").alias("days"), "nb_guests"
    )


@query
def range_drift(spark, sf_dir):
    lines = _source_and_copy(spark, sf_dir)[0]
    return drift.range_drift(lines, _drifted_copy(lines), LINE_KEY, leaf=512)


@query
def row_drift(spark, sf_dir):
    lines = _source_and_copy(spark, sf_dir)[0]
    return drift.row_drift(lines, _drifted_copy(lines), LINE_KEY, leaf=512)


@query
def rows_after_watermark(spark, sf_dir):
    return watermark.rows_after(*_source_and_copy(spark, sf_dir), LINE_KEY)


@query
def rows_not_loaded(spark, sf_dir):
    return watermark.rows_not_loaded(*_source_and_copy(spark, sf_dir), LINE_KEY)


# --- star and marts ---------------------------------------------------------
def _dimension(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(star.dimension(inputs.sales_stage(spark, sf_dir), name))

    return run


for _name in star.DIMENSIONS:
    QUERIES[_name] = _dimension(_name)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.fact_sale(inputs.sales_stage(spark, sf_dir))


def _dim(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return star.dimension(inputs.sales_stage(spark, sf_dir), name)


@query
def fact_sale(spark, sf_dir):
    return plain(_fact(spark, sf_dir))


@query
def fact_sale_amount(spark, sf_dir):
    return plain(star.fact_sale(inputs.sales_stage(spark, sf_dir), measure="amount"))


@query
def sales_trends_by_month(spark, sf_dir):
    return plain(marts.monthly_sales(_fact(spark, sf_dir)))


@query
def sales_with_moving_average(spark, sf_dir):
    return plain(marts.sales_with_moving_average(_fact(spark, sf_dir)))


@query
def sales_growth_by_month(spark, sf_dir):
    return plain(marts.sales_growth_by_month(_fact(spark, sf_dir)))


@query
def average_sales_by_day_of_week(spark, sf_dir):
    return plain(marts.average_sales_by_day_of_week(_fact(spark, sf_dir)))


@query
def average_sales_by_day_of_week_shifted(spark, sf_dir):
    return plain(marts.average_sales_by_day_of_week(_fact(spark, sf_dir), dates.SHIFTED))


@query
def average_sales_by_seller(spark, sf_dir):
    seller = _dim(spark, sf_dir, "dim_seller")
    return plain(marts.average_sales_by_seller(_fact(spark, sf_dir), seller))


@query
def sales_by_service(spark, sf_dir):
    service = _dim(spark, sf_dir, "dim_service")
    return plain(marts.sales_by_service(_fact(spark, sf_dir), service))


@query
def customer_age_groups(spark, sf_dir):
    return marts.customer_age_groups(_dim(spark, sf_dir, "dim_customer"))


@query
def customer_age_groups_decades(spark, sf_dir):
    return marts.customer_age_groups(_dim(spark, sf_dir, "dim_customer"), REPEATED)


@query
def sales_by_country_and_region(spark, sf_dir):
    country, resort = _dim(spark, sf_dir, "dim_country"), _dim(spark, sf_dir, "dim_resort")
    return plain(marts.sales_by_country_and_region(_fact(spark, sf_dir), country, resort))


@query
def sales_by_employee(spark, sf_dir):
    seller = _dim(spark, sf_dir, "dim_seller")
    return plain(marts.sales_by_employee(_fact(spark, sf_dir), seller))


# --- emissions normalisation ------------------------------------------------
def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_emissions(inputs.emission_tables(spark, sf_dir))


@query
def dim_address(spark, sf_dir):
    return emissions.dim_address(emissions.parsed_extract(_extract(spark, sf_dir)))


@query
def dim_organization(spark, sf_dir):
    return emissions.dim_organization(emissions.parsed_extract(_extract(spark, sf_dir)))


@query
def bridge_org_address(spark, sf_dir):
    return emissions.normalise(_extract(spark, sf_dir)).organizations_x_address


@query
def dim_category(spark, sf_dir):
    return emissions.dim_category(_extract(spark, sf_dir))


@query
def emission_objects(spark, sf_dir):
    extract = materialize(_extract(spark, sf_dir), "extract")
    return plain(emissions.objects(extract, emissions.dim_category(extract)))


@query
def emissions_fact(spark, sf_dir):
    return emissions.normalise(_extract(spark, sf_dir)).environmental_emissions
