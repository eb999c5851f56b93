"""Normalisation of the emissions registry into six tables."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stagehouse.functions.address import PARTS, address_parts
from stagehouse.functions.text import (
    blank_to_null,
    blanks_to_null,
    collapse_whitespace,
    digits_only,
    org_name,
    parse_decimal,
)
from stagehouse.operators.joins import join_null_safe
from stagehouse.operators.keys import Keyed, reused_keys, surrogate_keys
from stagehouse.operators.lookup import lookup
from stagehouse.operators.typing import MEASURES, fill_measures
from stagehouse.session import materialize

# Category code -> (name, number).
CATEGORIES = {
    "I": ("Первая категория", 1),
    "II": ("Вторая категория", 2),
    "III": ("Третья категория", 3),
    "IV": ("Четвёртая категория", 4),
}
# First surrogate key of a full run, and how object and category
# ids derive from the object id and the row position.
FULL_START = 1
OBJECT_FACTOR = 9
CATEGORY_FACTOR, CATEGORY_OFFSET = 12, 1

ORG_KEY = ["org_name", "inn"]
PAIR = ["organization_id", "address_id"]


def parsed_extract(extract: DataFrame) -> DataFrame:
    """The extract with five address parts, the organisation name and the INN digits."""
    return extract.select(
        *[c for c in extract.columns if c not in ("org_address", *ORG_KEY)],
        *address_parts("org_address"),
        org_name(F.col("org_name")).alias("org_name"),
        digits_only(F.col("inn")).alias("inn"),
    )


def dim_address(parsed: DataFrame, start: int = FULL_START) -> DataFrame:
    return surrogate_keys(parsed, PARTS, "id", start).select("id", *PARTS)


def organization_keys(parsed: DataFrame, start: int = FULL_START) -> DataFrame:
    """Keys over the values as parsed: a blank INN and a missing one differ here."""
    return surrogate_keys(parsed, ORG_KEY, "id", start)


def clean_organizations(keys: DataFrame) -> DataFrame:
    return blanks_to_null(keys.select("id", "org_name", F.col("inn").alias("org_inn")))


def dim_organization(parsed: DataFrame, start: int = FULL_START) -> DataFrame:
    return clean_organizations(organization_keys(parsed, start))


def object_parties(parsed: DataFrame, organizations: DataFrame, address: DataFrame) -> DataFrame:
    """Organisation and address key per object, its totals riding along."""
    with_org = join_null_safe(
        parsed, organizations.withColumnRenamed("id", "organization_id"), ORG_KEY
    )
    both = join_null_safe(with_org, address.withColumnRenamed("id", "address_id"), PARTS)
    return both.select("nvos_id", "organization_id", "address_id", *MEASURES)


def bridge_org_address(parties: DataFrame, start: int = FULL_START) -> DataFrame:
    return surrogate_keys(parties, PAIR, "id", start).select("id", *PAIR)


def known_category(df: DataFrame, column: str) -> DataFrame:
    """``df`` itself; a code outside the four, or none, fails the run."""
    code = F.col(column)
    message = F.concat(F.lit("unknown object category: "), F.coalesce(code, F.lit("null")))
    known = F.coalesce(code.isin(list(CATEGORIES)), F.lit(False))
    return df.where(F.when(known, F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))


def category_recode(df: DataFrame, column: str) -> DataFrame:
    """Add ``category_name`` and ``category_num``."""
    name = F.create_map(*[F.lit(v) for k, (text, _) in CATEGORIES.items() for v in (k, text)])
    number = F.create_map(*[F.lit(v) for k, (_, num) in CATEGORIES.items() for v in (k, num)])
    return (
        known_category(df, column)
        .withColumn("category_name", F.element_at(name, F.col(column)))
        .withColumn("category_num", F.element_at(number, F.col(column)).cast("long"))
    )


def dim_category(extract: DataFrame) -> DataFrame:
    """Categories in use, keyed by the position of their first object.

    The position counts the objects before it in ``nvos_id`` order. There are
    at most four first objects, so they are read and the count is one more
    aggregate over the id column, without numbering or sorting the rows.
    """
    firsts = {
        code: first
        for code, first in known_category(extract, "object_category")
        .groupBy("object_category")
        .agg(F.min("nvos_id"))
        .collect()
    }
    spark = extract.sparkSession
    schema = "category_code string, id long"
    if not firsts:
        return category_recode(spark.createDataFrame([], schema), "category_code").select(
            "id", "category_name", "category_code", "category_num"
        )
    before = extract.agg(
        *[F.count_if(F.col("nvos_id") < first).alias(code) for code, first in firsts.items()]
    )
    rows = before.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(code).alias("category_code"),
                        (F.col(code) * CATEGORY_FACTOR + CATEGORY_OFFSET).alias("id"),
                    )
                    for code in firsts
                ]
            )
        )
    )
    return category_recode(rows, "category_code").select(
        "id", "category_name", "category_code", "category_num"
    )


def new_categories(found: DataFrame, known: DataFrame) -> DataFrame:
    """Categories of a run that no earlier run has stored.

    A position starts at 0 again in every run, so their ids are moved past the
    last known one; the step of the ids stays the same.
    """
    last = known.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    shift = -(-last // CATEGORY_FACTOR) * CATEGORY_FACTOR
    return found.join(known.select("category_code"), "category_code", "left_anti").select(
        (F.col("id") + shift).alias("id"), "category_name", "category_code", "category_num"
    )


def object_id(column: str = "nvos_id"):
    return F.col(column) * OBJECT_FACTOR


def objects(extract: DataFrame, category: DataFrame, compat_literal: bool = False) -> DataFrame:
    ids = category.select("category_code", F.col("id").alias("category_id"))
    rows = lookup(
        extract,
        "object_category",
        ids,
        "category_code",
        "category_id",
        max_entries=len(CATEGORIES),
    )
    return blanks_to_null(
        rows.select(
            object_id().alias("id"),
            "nvos_id",
            "object_code",
            collapse_whitespace(F.col("object_name"), compat_literal).alias("object_name"),
            collapse_whitespace(F.col("object_location"), compat_literal).alias("object_location"),
            "category_id",
            "emission_count",
            "discharge_count",
            "waste_count",
        )
    )


def one_row_per_object(parsed: DataFrame) -> None:
    """Raise when an object comes twice: its keys would be ambiguous."""
    twice = parsed.groupBy("nvos_id").count().where(F.col("count") > 1).first()
    if twice is not None:
        raise ValueError(f"object {twice['nvos_id']} comes {twice['count']} times")


def emissions_fact(parties: DataFrame, bridge: DataFrame) -> DataFrame:
    """Bridge id, object id and the four totals per object; missing totals are 0."""
    links = join_null_safe(parties, bridge.withColumnRenamed("id", "org_address_id"), PAIR)
    return fill_measures(
        links.select(
            "nvos_id",
            "org_address_id",
            object_id().alias("obj_id"),
            *[parse_decimal(F.col(m)).alias(m) for m in MEASURES],
        )
    )


@dataclass(frozen=True)
class EmissionTables:
    address: DataFrame
    organizations: DataFrame
    organizations_x_address: DataFrame
    object_category: DataFrame
    objects: DataFrame
    environmental_emissions: DataFrame


def _all_fresh(ids: DataFrame) -> Keyed:
    return Keyed(ids, ids)


def address_ids(parsed: DataFrame, start: int, stored: DataFrame | None) -> Keyed:
    if stored is None:
        return _all_fresh(dim_address(parsed, start))
    return reused_keys(parsed, PARTS, stored, "id", start)


def organization_ids(parsed: DataFrame, start: int, stored: DataFrame | None) -> Keyed:
    """Beside stored organisations a blank and a missing value are one, as they are once stored."""
    if stored is None:
        return _all_fresh(organization_keys(parsed, start))
    held = stored.withColumnRenamed("org_inn", "inn")
    return reused_keys(parsed, ORG_KEY, held, "id", start, blank_to_null)


def bridge_ids(parties: DataFrame, start: int, stored: DataFrame | None) -> Keyed:
    if stored is None:
        return _all_fresh(bridge_org_address(parties, start))
    return reused_keys(parties, PAIR, stored, "id", start)


def normalise(
    extract: DataFrame,
    start: int = FULL_START,
    compat_literal: bool = False,
    stored: Mapping[str, DataFrame] | None = None,
) -> EmissionTables:
    """All six tables. The parsed extract and the ids are written down once,
    since several tables read each of them.

    With the ``stored`` tables of earlier runs, addresses, organisations, pairs and
    categories keep the ids they have; those four tables then hold what is new only.
    """
    stored = stored or {}
    parsed = materialize(parsed_extract(extract), "emissions-parsed")
    one_row_per_object(parsed)
    with ThreadPoolExecutor(2) as pool:
        addresses = pool.submit(copy_context().run, address_ids, parsed, start, stored.get("address"))
        organizations = organization_ids(parsed, start, stored.get("organizations"))
        address = addresses.result()
    parties = materialize(
        object_parties(parsed, organizations.every, address.every), "emissions-parties"
    )
    bridge = bridge_ids(parties, start, stored.get("organizations_x_address"))
    category = all_categories = dim_category(parsed)
    if (known := stored.get("object_category")) is not None:
        category = new_categories(category, known)
        all_categories = known.unionByName(category)
    return EmissionTables(
        address=address.fresh,
        organizations=clean_organizations(organizations.fresh),
        organizations_x_address=bridge.fresh,
        object_category=category,
        objects=objects(parsed, all_categories, compat_literal),
        environmental_emissions=emissions_fact(parties, bridge.every),
    )


