"""Text clean-up as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def blank_to_null(column: Column) -> Column:
    return F.nullif(column, F.lit(""))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Every empty string of every text column becomes null."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def first_group(column: Column, pattern: str) -> Column:
    """Group 1 of the first match, null where the pattern does not match.

    For patterns whose group 1 cannot match the empty string.
    """
    return blank_to_null(F.regexp_extract(column, pattern, 1))


def composite_key(*columns: Column) -> Column:
    """The key parts as one text; a null part is skipped.

    Different keys can read the same (1, 23 and 12, 3): compare keys as
    structs, and use this where the text itself is wanted.
    """
    return F.concat_ws("", *columns)


def name_part(column: Column, position: int) -> Column:
    """The ``position``-th blank-separated part; missing is ``''``, null stays null."""
    return F.split_part(column, F.lit(" "), F.lit(position))


# (?U) makes Java's \D and \s cover the whole of Unicode, as the data needs:
# digits other than ASCII are kept and no-break spaces count as blanks.
def digits_only(column: Column) -> Column:
    return F.regexp_replace(column, r"(?U)\D", "")


def collapse_whitespace(column: Column, compat_literal: bool = False) -> Column:
    r"""Runs of blanks become one space.

    ``compat_literal`` replaces the literal text ``\s+`` instead, which is what
    a replace call without regex mode does.
    """
    if compat_literal:
        return F.replace(column, F.lit(r"\s+"), F.lit(" "))
    return F.regexp_replace(column, r"(?U)\s+", " ")


def parse_decimal(column: Column) -> Column:
    """``'1 234,5'`` as 1234.5; empty and null give null, other bad text raises."""
    compact = F.regexp_replace(blank_to_null(column), r"(?U)\s", "")
    return (
        F.replace(compact, F.lit(","), F.lit(".")).cast(T.DecimalType(38, 9)).cast(T.DoubleType())
    )


# Organisation name between the first and last quote or backtick.
ORG_NAME = '(?:"|`)(.*)(?:`|")'


def org_name(column: Column) -> Column:
    """The quoted name; ``''`` for empty quotes, null without quotes."""
    return F.when(column.rlike(ORG_NAME), F.regexp_extract(column, ORG_NAME, 1))


# File kinds by the text their names contain, first hit wins.
ROUTES = {"region": "region", "companies": "companies", "employee": "employee"}


def route_by_name(file_name: Column, routes: dict[str, str] | None = None) -> Column:
    """Which loader a file goes to; null when none takes it."""
    chain: Column | None = None
    for text, route in (routes or ROUTES).items():
        hit = file_name.contains(text)
        chain = F.when(hit, route) if chain is None else chain.when(hit, route)
    return chain
