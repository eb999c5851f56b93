"""Star schema over the staged sales tables.

The rule that fills the fact follows the foreign keys of the staged tables:
invoice line -> invoice -> customer -> seller, and invoice line -> service ->
service line -> resort -> country.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagehouse.operators.keys import one_per_key

# Dimension -> (staged table, {dimension column: staged column}); key first.
DIMENSIONS = {
    "dim_resort": (
        "resort",
        {"resort_id": "resort_id", "resort": "resort", "country_id": "country_id"},
    ),
    "dim_seller": ("sales_person", {"seller_id": "sales_id", "sales_person": "sales_person"}),
    "dim_service": (
        "service",
        {"service_id": "service_id", "service": "service", "sl_id": "sl_id", "price": "price"},
    ),
    "dim_country": ("country", {"country_id": "country_id", "country": "country"}),
    "dim_service_line": (
        "service_line",
        {"sl_id": "sl_id", "service_line": "service_line", "resort_id": "resort_id"},
    ),
    "dim_customer": (
        "customer",
        {
            "cust_id": "cust_id",
            "first_name": "first_name",
            "last_name": "last_name",
            "age": "age",
            "city_id": "city_id",
            "seller_id": "sales_id",
        },
    ),
}


def dimension(stage: Mapping[str, DataFrame], name: str) -> DataFrame:
    """One row per key out of the staged batch."""
    table, columns = DIMENSIONS[name]
    rows = stage[table].select(*[F.col(src).alias(dst) for dst, src in columns.items()])
    key = next(iter(columns))
    return one_per_key(rows, [key])


def dim_resort(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_resort")


def dim_seller(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_seller")


def dim_service(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_service")


def dim_country(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_country")


def dim_service_line(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_service_line")


def dim_customer(stage: Mapping[str, DataFrame]) -> DataFrame:
    return dimension(stage, "dim_customer")


def _measure(name: str) -> Column:
    if name == "price":
        return F.col("price")
    if name == "amount":
        # The factors are cast first: price * bigint * bigint would otherwise
        # be a 38-digit decimal that cannot be summed exactly.
        days, guests = F.col("days").cast("decimal(6,0)"), F.col("nb_guests").cast("decimal(6,0)")
        return (F.col("price") * days * guests).cast("decimal(24,2)")
    raise ValueError(f"unknown measure {name}")


def service_terms(stage: Mapping[str, DataFrame]) -> DataFrame:
    """What a line takes from its service: a row per service that has a resort."""
    return (
        stage["service"]
        .select("service_id", "sl_id", "price")
        .join(stage["service_line"].select("sl_id", "resort_id"), "sl_id")
        .join(stage["resort"].select("resort_id", "country_id"), "resort_id")
        .select("service_id", "price", "sl_id", "resort_id", "country_id")
    )


def place_lines(
    lines: DataFrame,
    invoices: DataFrame,
    customers: DataFrame,
    terms: DataFrame,
    measure: str = "price",
) -> DataFrame:
    """Every line with its fact columns, ``placed`` where invoice, customer and service are known.

    For loads that come in parts: :func:`fact_sale` leaves out a line whose
    other tables lack its keys, here it can wait for them.
    """
    known = invoices.select("inv_id", "cust_id", "invoice_date").join(
        customers.select("cust_id", F.col("sales_id").alias("seller_id")), "cust_id"
    )
    placed = F.col("_invoice").isNotNull() & F.col("_service").isNotNull()
    return (
        lines.select("inv_id", "service_id", "days", "nb_guests")
        .join(terms.withColumn("_service", F.lit(True)), "service_id", "left")
        .join(known.withColumn("_invoice", F.lit(True)), "inv_id", "left")
        .withColumn("price", _measure(measure))
        .withColumn("placed", placed)
        .drop("_invoice", "_service")
    )


def fact_sale(stage: Mapping[str, DataFrame], measure: str = "price") -> DataFrame:
    """One row per invoice line with its invoice, seller, service, resort and country.

    The service side is joined table by table: each is a plain scan whose size
    Catalyst knows, so a small one is broadcast and no invoice line moves for
    it. Invoices and customers both grow with the sales, so they are joined to
    each other first and the lines, the widest table, move once for the pair.
    ``measure="amount"`` puts price x days x guests into ``price``.
    """
    invoices = (
        stage["sales"]
        .select("inv_id", "cust_id", "invoice_date")
        .join(
            stage["customer"].select("cust_id", F.col("sales_id").alias("seller_id")), "cust_id"
        )
    )
    return (
        stage["invoice_line"]
        .select("inv_id", "service_id", "days", "nb_guests")
        .join(stage["service"].select("service_id", "sl_id", "price"), "service_id")
        .join(stage["service_line"].select("sl_id", "resort_id"), "sl_id")
        .join(stage["resort"].select("resort_id", "country_id"), "resort_id")
        .join(invoices, "inv_id")
        .select(
            "inv_id",
            "cust_id",
            "invoice_date",
            _measure(measure).alias("price"),
            "seller_id",
            "service_id",
            "sl_id",
            "resort_id",
            "country_id",
        )
    )
