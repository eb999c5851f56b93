"""The nine reporting marts, one function each, over any fact and dimensions.

Every mart that needs a dimension sums the fact by the dimension's key first
and joins afterwards. The join then meets one row per key (and date), however
many sales a hot seller, service or resort has, and names that two keys share
merge in a last, small sum. Sums stay decimal; an average is the exact sum
over the count.

In place of the fact (or the customers) a mart also takes sums of it, made by
:func:`sums_by` (:func:`counts_by`) over at least the keys the mart needs. Such
sums add up, so a load can keep them and add those of what came since.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stagehouse.functions.buckets import HISTORY, AgeBuckets, age_bucket
from stagehouse.functions.dates import SUNDAY_FIRST, sale_month, sale_year, weekday_label
from stagehouse.operators.joins import unplaced


def _average(total: Column, count: Column) -> Column:
    return total.cast("double") / count


def _sums(rows: DataFrame) -> tuple[Column, Column]:
    """Sum and count of the prices, out of the fact or of sums of it (whose type stays)."""
    if "_total" in rows.columns:
        total = F.sum("_total").cast(rows.schema["_total"].dataType)
        return total.alias("_total"), F.sum("_count").alias("_count")
    return F.sum("price").alias("_total"), F.count("price").alias("_count")


def sums_by(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(*_sums(fact))


def _rows(customers: DataFrame) -> Column:
    return F.sum("_count") if "_count" in customers.columns else F.count(F.lit(1))


def counts_by(customers: DataFrame, keys: Sequence[str]) -> DataFrame:
    return customers.groupBy(*keys).agg(_rows(customers).alias("_count"))


def monthly_sales(fact: DataFrame) -> DataFrame:
    """``sales_trends_by_month``; growth and moving average build on it."""
    return fact.groupBy(
        sale_year(F.col("invoice_date")).alias("sale_year"),
        sale_month(F.col("invoice_date")).alias("sale_month"),
    ).agg(_sums(fact)[0].alias("total_sales"))


def moving_average(monthly: DataFrame) -> DataFrame:
    """Average over the three months before, the month and the one after, as listed.

    The frame counts rows, so a month without sales does not widen it. The one
    unpartitioned window of the engine: its input has a row per month.
    """
    frame = (
        Window.orderBy(F.asc_nulls_last("sale_year"), F.asc_nulls_last("sale_month"))
        .rowsBetween(-3, 1)
    )
    average = _average(F.sum("total_sales").over(frame), F.count("total_sales").over(frame))
    return monthly.select(
        "sale_year", "sale_month", "total_sales", average.alias("moving_average")
    )


def growth(monthly: DataFrame) -> DataFrame:
    """Each month against the month before in the same year.

    A range frame that starts and ends one below the current month finds that
    month's row or nothing: a gap stays empty, and so does January. It reads
    the monthly sums once, where a self join would build them twice.
    """
    before = Window.partitionBy("sale_year").orderBy("sale_month").rangeBetween(-1, -1)
    previous = F.when(F.col("sale_month").isNotNull(), F.first("total_sales").over(before))
    return monthly.withColumn("previous_month_sales", previous).select(
        "sale_year",
        "sale_month",
        F.col("total_sales").alias("current_month_sales"),
        "previous_month_sales",
        (F.col("total_sales") - F.col("previous_month_sales")).alias("sales_growth"),
    )


def sales_with_moving_average(fact: DataFrame) -> DataFrame:
    return moving_average(monthly_sales(fact))


def sales_growth_by_month(fact: DataFrame) -> DataFrame:
    return growth(monthly_sales(fact))


def average_sales_by_day_of_week(
    fact: DataFrame, labels: tuple[str, ...] = SUNDAY_FIRST
) -> DataFrame:
    return (
        fact.groupBy(weekday_label(F.col("invoice_date"), labels).alias("day_of_week"))
        .agg(*_sums(fact))
        .select("day_of_week", _average(F.col("_total"), F.col("_count")).alias("average_sale"))
    )


def _named(sums: DataFrame, dim: DataFrame, key: str, name: str) -> DataFrame:
    return sums.join(unplaced(dim.select(key, name)), key)


def average_sales_by_seller(fact: DataFrame, seller: DataFrame) -> DataFrame:
    return (
        _named(sums_by(fact, ["seller_id"]), seller, "seller_id", "sales_person")
        .groupBy("sales_person")
        .agg(_average(F.sum("_total"), F.sum("_count")).alias("average_sale"))
    )


def sales_by_service(fact: DataFrame, service: DataFrame) -> DataFrame:
    return (
        _named(sums_by(fact, ["service_id"]), service, "service_id", "service")
        .groupBy("service")
        .agg(F.sum("_total").alias("total_sales"))
    )


def customer_age_groups(customer: DataFrame, buckets: AgeBuckets = HISTORY) -> DataFrame:
    rows = counts_by(customer, ["age"])
    if buckets.keep:
        rows = rows.where(F.col("age").between(*buckets.keep))
    return rows.groupBy(age_bucket(F.col("age"), buckets).alias("age_group")).agg(
        F.sum("_count").alias("customer_count")
    )


def sales_by_country_and_region(
    fact: DataFrame, country: DataFrame, resort: DataFrame
) -> DataFrame:
    sums = sums_by(fact, ["country_id", "resort_id", "invoice_date"])
    named = _named(_named(sums, country, "country_id", "country"), resort, "resort_id", "resort")
    return named.groupBy("country", "resort", "invoice_date").agg(
        F.sum("_total").alias("total_sales")
    )


def sales_by_employee(fact: DataFrame, seller: DataFrame) -> DataFrame:
    sums = sums_by(fact, ["seller_id", "invoice_date"])
    return (
        _named(sums, seller, "seller_id", "sales_person")
        .groupBy("sales_person", "invoice_date")
        .agg(F.sum("_total").alias("total_price"))
    )
