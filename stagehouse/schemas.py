"""Column lists and types of every table the engine reads or writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(),
    "text": T.StringType(),
    "time": T.TimestampNTZType(),
    "double": T.DoubleType(),
    "num12_2": T.DecimalType(12, 2),
    "num13": T.DecimalType(13, 0),
    "num14": T.DecimalType(14, 0),
    "num14_2": T.DecimalType(14, 2),
}


def struct(columns: str) -> T.StructType:
    """``"id:long name:text"`` as a schema; a bare name is text."""
    fields = [(item.split(":") + ["text"])[:2] for item in columns.split()]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in fields])


def text_only(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in columns])


# --- sales source -----------------------------------------------------------
# Table and column names of the sales source.
SALES_TABLES = {
    "age_group": struct("age_group_id:long age_min:long age_max:long age_range"),
    "city": struct("city_id:long city region_id:long"),
    "country": struct("country_id:long country"),
    "customer": struct(
        "cust_id:long first_name last_name age:long phone_number address "
        "city_id:long sales_id:long sponsor_id:long"
    ),
    "invoice_line": struct("inv_id:long service_id:long days:long nb_guests:long"),
    "region": struct("region_id:long region country_id:long"),
    "region_sline": struct("sl_id:long region_id:long sales_revenue:num14_2"),
    "reservation_line": struct("res_id:long service_id:long res_days:long future_guests:long"),
    "reservations": struct("res_id:long cust_id:long res_date:time"),
    "resort": struct("resort_id:long resort country_id:long"),
    "sales": struct("inv_id:long cust_id:long invoice_date:time"),
    "sales_person": struct("sales_id:long sales_person"),
    "service": struct("service_id:long service sl_id:long price:num12_2"),
    "service_line": struct("sl_id:long service_line resort_id:long"),
}

# The column a partitioned JDBC read is split on.
SPLIT_COLUMN = {name: schema.fieldNames()[0] for name, schema in SALES_TABLES.items()}

# Names under which the load ledger knows the staging tables.
LEDGER_TABLE = "DWH/DSO/3STGmetadata"
STAGE_NAMES = {
    "age_group": "/DWH/AO/0age_group",
    "city": "/DWH/AO/0city",
    "country": "/DWH/AO/0country",
    "customer": "/DWH/AO/0customer",
    "invoice_line": "/DWH/DSO/3STGinvoice_line",
    "region": "/DWH/AO/0region",
    "region_sline": "/DWH/DSO/3STGregion_sline",
    "reservation_line": "/DWH/DSO/3STGreservation_line",
    "reservations": "/DWH/DSO/3STGreservations",
    "resort": "/DWH/AO/0resort",
    "sales": "/DWH/DSO/3STGsales",
    "sales_person": "/DWH/AO/0sales_person",
    "service": "/DWH/AO/0service",
    "service_line": "/DWH/DSO/3STGservice_line",
}


# --- arriving XML files -----------------------------------------------------
@dataclass(frozen=True)
class RecordType:
    """One kind of XML file: which child element feeds which staging column."""

    table: str
    elements: dict[str, str]

    @property
    def xml_schema(self) -> T.StructType:
        return text_only(list(self.elements))

    @property
    def stage_columns(self) -> list[str]:
        return list(self.elements.values())


# Child element -> staging column, per file kind. In
# "Датаcозданияорг" the letter after "Дата" is a Latin c.
EMPLOYEE_XML = RecordType(
    "DWH_DSO_1STGemployees",
    {
        "IDсотрудника": "id_employee",
        "ФИО": "fio",
        "IDРегиона": "id_region",
        "IDКомпании": "id_company",
        "Лфактор": "l_faktor",
        "Жфактор": "j_faktor",
        "Хфактор": "x_faktor",
        "Датарождения": "birth_date",
        "Датаотклонения": "date_devations",
        "УИК": "uik",
        "УИКЧисло": "uik_num",
    },
)
REGION_XML = RecordType(
    "DWH_AO_0regions",
    {
        "НазваниеРегиона": "region_name",
        "IDРегиона": "id_region",
        "ФО": "region_parent",
        "ГражданКол-во": "population",
        "Name": "name_eng",
        "Code": "code",
        "ОКТМО": "region_oktmo",
        "ОКАТО": "region_okato",
        "Ф_Значение": "f_value",
    },
)
COMPANY_XML = RecordType(
    "DWH_AO_0companies",
    {
        "IDКомпании": "id_company",
        "Название": "company_name",
        "ГоловнаяОрганизация": "company_parent",
        "idРегиона": "id_region",
        "ТипКомпании": "type_company",
        "ТипОтрасли": "type_industry",
        "Росстат": "rosstat",
        "Датаcозданияорг": "create_date",
        "Дата2": "date2",
        "ИНН": "inn",
    },
)

# --- typed targets of the file jobs -----------------------------------------
EMPLOYEE_NDS = struct(
    "id_employee:long fio id_region:long id_company:long l_faktor:long j_faktor:long "
    "x_faktor:long birth_date:time date_devations:time uik uik_num:long"
)
EMPLOYEE_LOG = struct("request_id record_id:long mode").fields + EMPLOYEE_NDS.fields
EMPLOYEE_LOG = T.StructType(EMPLOYEE_LOG)
PERSONS = struct("id_employee:long first_name last_name sur_name birth_date:time")
EMPLOYMENT = struct(
    "id_employee:long id_region:long id_company:long l_faktor:num14 j_faktor:num14 "
    "x_faktor:num14 date_devations:time uik uik_num:num14"
)
REGION_NDS = struct(
    "id_region:long region_name region_parent population:num14 name_eng code:long "
    "region_oktmo:long region_okato:long f_value:num13"
)
COMPANY_NDS = struct(
    "id_company:long company_name company_parent id_region:long type_company_cd:long "
    "type_industry_cd:long rosstat:num14 create_date:time date2:time inn"
)
# Fixed values: "indystry" is how the industry dimension spells its name column.
TYPE_COMPANY = struct("type_company_cd:long type_company_name")
TYPE_INDUSTRY = struct("type_industry_cd:long type_indystry_name")
LEDGER = struct("request_id table_name filename status load_date:time")

# --- emissions --------------------------------------------------------------
ADDRESS = struct("id:long postcode region locality street house_number")
ORGANIZATIONS = struct("id:long org_name org_inn")
ORGANIZATIONS_X_ADDRESS = struct("id:long organization_id:long address_id:long")
OBJECT_CATEGORY = struct("id:long category_name category_code category_num:long")
OBJECTS = struct(
    "id:long nvos_id:long object_code object_name object_location category_id:long "
    "emission_count:long discharge_count:long waste_count:long"
)
ENVIRONMENTAL_EMISSIONS = struct(
    "nvos_id:long org_address_id:long obj_id:long emission_total:double "
    "discharge_total:double waste_total:double co2_total:double"
)
