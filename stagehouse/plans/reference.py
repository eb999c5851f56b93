"""Regions and companies: the newest staged batch into the typed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.changes import latest_request, pick, rows_of
from stagehouse.operators.lookup import lookup_codes_by_name
from stagehouse.operators.merge import new_dim_values, upsert
from stagehouse.operators.typing import to_typed
from stagehouse.schemas import (
    COMPANY_NDS,
    COMPANY_XML,
    REGION_NDS,
    REGION_XML,
    TYPE_COMPANY,
    TYPE_INDUSTRY,
)


def latest_rows(stage: DataFrame, ledger: DataFrame, table: str) -> DataFrame:
    """Staged rows of the table's newest request."""
    return rows_of(stage, pick(latest_request(ledger, table)))


def typed_regions(rows: DataFrame) -> DataFrame:
    """Only ``f_value`` may be blank; a blank elsewhere fails the load."""
    return to_typed(rows, REGION_NDS, blank_null=("f_value",))


def load_regions(stage: DataFrame, ledger: DataFrame, target: DataFrame) -> DataFrame:
    rows = latest_rows(stage, ledger, REGION_XML.table)
    return upsert(target, typed_regions(rows), ["id_region"])


def new_company_types(rows: DataFrame, dim: DataFrame, dedupe: bool = True) -> DataFrame:
    name, code = TYPE_COMPANY.fieldNames()[1], TYPE_COMPANY.fieldNames()[0]
    return new_dim_values(dim, rows.select("type_company"), name, code, dedupe)


def new_company_industries(rows: DataFrame, dim: DataFrame, dedupe: bool = True) -> DataFrame:
    name, code = TYPE_INDUSTRY.fieldNames()[1], TYPE_INDUSTRY.fieldNames()[0]
    return new_dim_values(dim, rows.select("type_industry"), name, code, dedupe)


def typed_companies(
    rows: DataFrame, type_company: DataFrame, type_industry: DataFrame
) -> DataFrame:
    """Typed rows with both codes; rows whose type or industry is null drop out."""
    return to_typed(lookup_codes_by_name(rows, type_company, type_industry), COMPANY_NDS)


def load_companies(
    stage: DataFrame,
    ledger: DataFrame,
    type_company: DataFrame,
    type_industry: DataFrame,
    dedupe: bool = True,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows to append: companies, then the new types and the new industries."""
    rows = latest_rows(stage, ledger, COMPANY_XML.table)
    types = new_company_types(rows, type_company, dedupe)
    industries = new_company_industries(rows, type_industry, dedupe)
    companies = typed_companies(
        rows, type_company.unionByName(types), type_industry.unionByName(industries)
    )
    return companies, types, industries


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    return rows.select(F.col(column)).distinct()
