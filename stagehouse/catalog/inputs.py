"""Source, staging and ledger tables derived from the given parquet tables.

Each function mirrors the view of the same purpose in ``inputs_sql``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stagehouse.schemas import COMPANY_XML, EMPLOYEE_XML, REGION_XML
from stagehouse.sources.tables import TableSource, read_table

C = F.col
Given = Callable[[str], DataFrame]


# Columns of the given tables. Declared, so that no job has to look them up.
GIVEN = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def text(value: Column) -> Column:
    return value.cast("string")


def label(prefix: str, value: Column) -> Column:
    return F.concat(F.lit(prefix), text(value))


# --- sales ------------------------------------------------------------------
@dataclass(frozen=True)
class GivenSales:
    """The 14 source tables, each built from the given ones when it is asked for."""

    spark: SparkSession
    sf_dir: str

    def load(self, table: str) -> DataFrame:
        return SALES[table](lambda name: given(self.spark, self.sf_dir, name))

    def count(self, table: str) -> int:
        return self.load(table).count()

    def load_from(self, table: str, low: int | None) -> DataFrame:
        return self.load(table)


def _brand_number() -> Column:
    return F.substring("p_brand", 7, 9).cast("long")


def _age() -> Column:
    """5 to 94, null for one customer in 97."""
    return F.when(C("c_custkey") % 97 != 0, 5 + C("c_custkey") % 90)


def _age_group(t: Given) -> DataFrame:
    low = C("age_min")
    return (
        t("customer")
        .select((_age() - _age() % 10).cast("long").alias("age_min"))
        .where(low.isNotNull())
        .distinct()
        .select(
            (low / 10).cast("long").alias("age_group_id"),
            "age_min",
            (low + 9).alias("age_max"),
            F.concat(text(low), F.lit("-"), text(low + 9)).alias("age_range"),
        )
    )


def _city(t: Given) -> DataFrame:
    return t("nation").select(
        C("n_nationkey").alias("city_id"),
        F.concat(F.lit("City "), C("n_name")).alias("city"),
        C("n_regionkey").alias("region_id"),
    )


def _country(t: Given) -> DataFrame:
    return t("region").select(C("r_regionkey").alias("country_id"), C("r_name").alias("country"))


def _customer(t: Given) -> DataFrame:
    key = C("c_custkey")
    return t("customer").select(
        key.alias("cust_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        _age().alias("age"),
        F.concat(F.lit("+7"), F.lpad(text(key), 10, "0")).alias("phone_number"),
        C("c_mktsegment").alias("address"),
        C("c_nationkey").alias("city_id"),
        (key % 10).alias("sales_id"),
        F.when(key % 7 != 0, key - key % 7).alias("sponsor_id"),
    )


def _invoice_line(t: Given) -> DataFrame:
    return t("lineitem").select(
        C("l_orderkey").alias("inv_id"),
        C("l_partkey").alias("service_id"),
        C("l_linenumber").alias("days"),
        C("l_quantity").alias("nb_guests"),
    )


def _region(t: Given) -> DataFrame:
    return t("region").select(
        C("r_regionkey").alias("region_id"),
        F.concat(F.lit("Region "), C("r_name")).alias("region"),
        C("r_regionkey").alias("country_id"),
    )


def _region_sline(t: Given) -> DataFrame:
    return (
        t("part")
        .groupBy(_brand_number().alias("sl_id"), (C("p_size") % 5).alias("region_id"))
        .agg(F.sum(C("p_retailprice").cast("decimal(12,2)")).alias("sales_revenue"))
    )


def _reservation_line(t: Given) -> DataFrame:
    return (
        t("lineitem")
        .where(C("l_linestatus") == "O")
        .select(
            C("l_orderkey").alias("res_id"),
            C("l_partkey").alias("service_id"),
            C("l_linenumber").alias("res_days"),
            C("l_quantity").alias("future_guests"),
        )
    )


def _reservations(t: Given) -> DataFrame:
    return (
        t("orders")
        .where(C("o_orderstatus") == "O")
        .select(
            C("o_orderkey").alias("res_id"),
            C("o_custkey").alias("cust_id"),
            C("o_orderdate").alias("res_date"),
        )
    )


def _resort(t: Given) -> DataFrame:
    return t("nation").select(
        C("n_nationkey").alias("resort_id"),
        C("n_name").alias("resort"),
        C("n_regionkey").alias("country_id"),
    )


def _sales(t: Given) -> DataFrame:
    return t("orders").select(
        C("o_orderkey").alias("inv_id"),
        C("o_custkey").alias("cust_id"),
        C("o_orderdate").alias("invoice_date"),
    )


def _sales_person(t: Given) -> DataFrame:
    return t("supplier").select(
        C("s_suppkey").alias("sales_id"), C("s_name").alias("sales_person")
    )


def _service(t: Given) -> DataFrame:
    return t("part").select(
        C("p_partkey").alias("service_id"),
        C("p_name").alias("service"),
        _brand_number().alias("sl_id"),
        C("p_retailprice").alias("price"),
    )


def _service_line(t: Given) -> DataFrame:
    return (
        t("part")
        .select(
            _brand_number().alias("sl_id"),
            C("p_brand").alias("service_line"),
            (_brand_number() - 1).alias("resort_id"),
        )
        .distinct()
    )


SALES: dict[str, Callable[[Given], DataFrame]] = {
    "age_group": _age_group,
    "city": _city,
    "country": _country,
    "customer": _customer,
    "invoice_line": _invoice_line,
    "region": _region,
    "region_sline": _region_sline,
    "reservation_line": _reservation_line,
    "reservations": _reservations,
    "resort": _resort,
    "sales": _sales,
    "sales_person": _sales_person,
    "service": _service,
    "service_line": _service_line,
}


def sales_source(spark: SparkSession, sf_dir: str) -> GivenSales:
    return GivenSales(spark, sf_dir)


class SalesStage(dict):
    """Source tables by name, read with their declared columns on first use."""

    def __init__(self, source: TableSource):
        super().__init__()
        self.source = source

    def __missing__(self, table: str) -> DataFrame:
        self[table] = read_table(self.source, table)
        return self[table]


def sales_stage(spark: SparkSession, sf_dir: str) -> SalesStage:
    return SalesStage(sales_source(spark, sf_dir))


# --- employees --------------------------------------------------------------
def employee_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All-text staging of three requests; some ids carry a leading zero, some
    entries have no deviation date."""
    event, user, ts = C("event_id"), C("user_id"), C("ts")
    return given(spark, sf_dir, "events").select(
        label("req-", ((F.dayofmonth(ts) - 1) / 10).cast("int")).alias("request_id"),
        event.alias("record_id"),
        F.when(event % 37 == 0, label("0", user)).otherwise(text(user)).alias("id_employee"),
        F.concat_ws(" ", C("event_type"), label("u", user), F.lit("x")).alias("fio"),
        text(event % 50).alias("id_region"),
        text(event % 70).alias("id_company"),
        text(event % 11).alias("l_faktor"),
        text(event % 13).alias("j_faktor"),
        text(event % 17).alias("x_faktor"),
        F.date_format(F.date_sub(F.to_date(ts), (user % 9000).cast("int")), "yyyy-MM-dd").alias(
            "birth_date"
        ),
        F.when(event % 53 != 0, text(ts)).alias("date_devations"),
        label("U", event % 5).alias("uik"),
        text(event % 19).alias("uik_num"),
    )


def employee_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One successful request per staged batch, dated by its first event."""
    return (
        employee_stage(spark, sf_dir)
        .groupBy("request_id")
        .agg(F.min("record_id").alias("_n"), F.min("date_devations").alias("_first"))
        .select(
            "request_id",
            F.lit(EMPLOYEE_XML.table).alias("table_name"),
            F.concat(F.lit("employee_"), C("request_id"), F.lit(".xml")).alias("filename"),
            F.lit("SUCCESS").alias("status"),
            C("_first").cast("timestamp_ntz").alias("load_date"),
        )
    )


def employee_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first request as logged earlier, without a third of the employees."""
    user = C("id_employee").cast("long")
    return (
        employee_stage(spark, sf_dir)
        .where((C("request_id") == "req-0") & (user % 3 != 0))
        .select(
            "request_id",
            "record_id",
            F.when(C("record_id") % 29 == 0, "DELETE").otherwise("CREATE").alias("mode"),
            user.alias("id_employee"),
            "fio",
            *[C(c).cast("long").alias(c) for c in ("id_region", "id_company")],
            *[C(c).cast("long").alias(c) for c in ("l_faktor", "j_faktor", "x_faktor")],
            C("birth_date").cast("timestamp_ntz").alias("birth_date"),
            C("date_devations").cast("timestamp_ntz").alias("date_devations"),
            "uik",
            C("uik_num").cast("long").alias("uik_num"),
        )
    )


# --- files and their ledger -------------------------------------------------
def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per order, over the three kinds of files."""
    key = C("o_orderkey")
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), (key % 3 + 1).cast("int"))
    table = F.element_at(F.array(*[F.lit(t) for t in KIND_TABLES]), (key % 3 + 1).cast("int"))
    status = (
        F.when(C("o_orderstatus") == "F", "SUCCESS")
        .when(C("o_orderstatus") == "O", "RUNNING")
        .when(C("o_orderstatus") == "P", "FAILED")
    )
    return given(spark, sf_dir, "orders").select(
        label("f-", key).alias("request_id"),
        table.alias("table_name"),
        F.concat(kind, F.lit("_"), text(key), F.lit(".xml")).alias("filename"),
        status.alias("status"),
        C("o_orderdate").alias("load_date"),
    )


KINDS = ("region", "companies", "employee")
KIND_TABLES = (REGION_XML.table, COMPANY_XML.table, EMPLOYEE_XML.table)


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What lies in the folder: the files of the ledger and a note per invoice line."""
    known = file_ledger(spark, sf_dir).select("filename")
    notes = given(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("note_"), text(C("l_orderkey")), F.lit(".txt")).alias("filename")
    )
    return known.unionAll(notes)


# --- regions and companies --------------------------------------------------
def _batch_ledger(rows: DataFrame, table: str, prefix: str) -> DataFrame:
    """Requests ``prefix-N``, dated N days after New Year 2024; the last one failed."""
    number = F.split_part("request_id", F.lit("-"), F.lit(2)).cast("int")
    return (
        rows.select("request_id")
        .distinct()
        .select(
            "request_id",
            F.lit(table).alias("table_name"),
            F.concat(F.lit(f"{prefix}_"), text(number), F.lit(".xml")).alias("filename"),
            F.when(number == 2, "FAILED").otherwise("SUCCESS").alias("status"),
            F.date_add(F.lit("2024-01-01").cast("date"), number)
            .cast("timestamp_ntz")
            .alias("load_date"),
        )
    )


def region_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, nation = C("c_custkey"), C("c_nationkey")
    return given(spark, sf_dir, "customer").select(
        label("reg-", key % 3).alias("request_id"),
        C("c_name").alias("region_name"),
        text(key).alias("id_region"),
        C("c_mktsegment").alias("region_parent"),
        text(C("c_acctbal").cast("decimal(12,2)")).alias("population"),
        F.concat(F.lit("Region "), text(key)).alias("name_eng"),
        text(nation).alias("code"),
        text(key * 1000 + nation).alias("region_oktmo"),
        F.concat(F.lit(" "), text(nation), F.lit(" ")).alias("region_okato"),
        F.when(key % 4 == 0, "").otherwise(text(key % 100)).alias("f_value"),
    )


def region_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_ledger(region_stage(spark, sf_dir), REGION_XML.table, "reg")


def region_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regions loaded earlier: all but one segment, with an older name."""
    key = C("c_custkey")
    number = key.cast("decimal(14,0)")
    return (
        given(spark, sf_dir, "customer")
        .where(C("c_mktsegment") != "BUILDING")
        .select(
            key.alias("id_region"),
            F.concat(F.lit("old "), C("c_name")).alias("region_name"),
            C("c_mktsegment").alias("region_parent"),
            number.alias("population"),
            F.lit("old").alias("name_eng"),
            key.alias("code"),
            key.alias("region_oktmo"),
            key.alias("region_okato"),
            key.cast("decimal(13,0)").alias("f_value"),
        )
    )


def company_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = C("p_partkey")
    day = F.date_add(F.lit("2020-01-01").cast("date"), (key % 1000).cast("int"))
    return given(spark, sf_dir, "part").select(
        label("com-", key % 3).alias("request_id"),
        text(key).alias("id_company"),
        C("p_name").alias("company_name"),
        C("p_brand").alias("company_parent"),
        text(C("p_size")).alias("id_region"),
        F.when(key % 41 != 0, C("p_type")).alias("type_company"),
        F.when(key % 43 != 0, C("p_brand")).alias("type_industry"),
        text(C("p_retailprice").cast("decimal(12,2)")).alias("rosstat"),
        F.date_format(day, "yyyy-MM-dd").alias("create_date"),
        F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 10:20:30")).alias("date2"),
        label("77", key).alias("inn"),
    )


def company_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch_ledger(company_stage(spark, sf_dir), COMPANY_XML.table, "com")


def type_company(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types known so far: those of large parts, coded by their largest key."""
    return (
        given(spark, sf_dir, "part")
        .where(C("p_size") > 40)
        .groupBy(C("p_type").alias("type_company_name"))
        .agg(F.max("p_partkey").alias("type_company_cd"))
        .select("type_company_cd", "type_company_name")
    )


def type_industry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        given(spark, sf_dir, "part")
        .where(C("p_size") > 48)
        .groupBy(C("p_brand").alias("type_indystry_name"))
        .agg(F.max("p_partkey").alias("type_industry_cd"))
        .select("type_industry_cd", "type_indystry_name")
    )


# --- emissions --------------------------------------------------------------
def emission_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six registry tables; a customer is an object, a nation its organisation."""
    key, nation = C("c_custkey"), C("n_nationkey")
    category = (
        F.when(key % 4 == 0, "I")
        .when(key % 4 == 1, "II")
        .when(key % 4 == 2, "III")
        .otherwise("IV")
    )
    street = F.when(nation % 4 == 0, ", улица Ленина").otherwise(", ул. Мира")
    address = F.when(nation % 7 == 0, F.lit("no address")).otherwise(
        F.concat(
            text(100000 + nation),
            F.lit(", Московская область, г. Химки"),
            street,
            F.lit(", д. "),
            text(nation % 9 + 1),
            F.lit("а"),
        )
    )
    total = F.when(
        key % 11 != 0,
        F.concat(text(key % 10), F.lit(" "), F.lpad(text(key % 1000), 3, "0"), F.lit(",5")),
    ).otherwise("")
    measured = given(spark, sf_dir, "customer").where(C("c_acctbal") > 0)

    def measures(count: str | None, value: str) -> DataFrame:
        extra = [(key % 9).cast("long").alias(count)] if count else []
        return measured.select(key.alias("nvos_id"), *extra, total.alias(value))

    return {
        "nvosentities": given(spark, sf_dir, "customer").select(
            key.alias("nvos_id"),
            label("OBJ-", key).alias("code"),
            F.when(key % 13 == 0, "")
            .otherwise(F.concat(F.lit("Object  "), C("c_mktsegment")))
            .alias("name"),
            F.concat(F.lit("Site \t "), text(C("c_nationkey"))).alias("location"),
            category.alias("category"),
            C("c_nationkey").alias("org_id"),
        ),
        "organizations": given(spark, sf_dir, "nation").select(
            nation.alias("org_id"),
            F.when(nation % 5 == 0, F.concat(F.lit("ИП "), C("n_name")))
            .otherwise(F.concat(F.lit('ООО "'), C("n_name"), F.lit('"')))
            .alias("organization_name"),
            address.alias("legal_address"),
            F.when(nation % 6 == 0, "")
            .otherwise(label("ИНН ", F.lit(7700000000) + nation))
            .alias("inn"),
        ),
        "emissions": measures("source_count", "total_emission"),
        "discharges": measures("discharge_count", "total_discharge"),
        "waste": measures("object_count", "total_mass"),
        "greenhousegases": measures(None, "co2_emission"),
    }
