import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stagehouse.functions.buckets import REPEATED
from stagehouse.plans import emissions, employees, marts, star
from stagehouse.schemas import EMPLOYEE_LOG, SALES_TABLES
from stagehouse.sources.emissions import extract_emissions


def day(month, number=1, year=2024):
    return dt.datetime(year, month, number)


FACT = "invoice_date timestamp_ntz, price decimal(12,2), seller_id long, service_id long, country_id long, resort_id long"


def fact(spark, entries):
    """(date, price[, seller, service, country, resort]) per sale."""
    filled = [(d, Decimal(p), *(list(k) + [1] * (4 - len(k)))) for d, p, *k in entries]
    return spark.createDataFrame(filled, FACT)


def test_growth_needs_the_month_before(spark, rows):
    sales = fact(
        spark,
        [
            (day(12, year=2023), 5), (day(1), 10), (day(1, 9), 1), (day(2), 7),
            (day(4), 3), (None, 2), (None, 4),
        ],
    )
    found = rows(marts.sales_growth_by_month(sales))
    assert found == [
        (None, None, 6, None, None),
        (2023, 12, 5, None, None),
        (2024, 1, 11, None, None),
        (2024, 2, 7, 11, -4),
        (2024, 4, 3, None, None),
    ]


@pytest.mark.parametrize(
    "totals, averages",
    [([4], [4.0]), ([1, 2, 3], [1.5, 2.0, 2.0]), ([1, 2, 3, 4, 5, 6], [1.5, 2.0, 2.5, 3.0, 4.0, 4.5])],
)
def test_moving_average(spark, totals, averages):
    # The frame counts listed months: every second month is missing here.
    sales = fact(spark, [(day(1 + 2 * i), t) for i, t in enumerate(totals)])
    found = marts.sales_with_moving_average(sales).orderBy("sale_year", "sale_month").collect()
    assert [r.moving_average for r in found] == averages


def test_weekday_average(spark, rows):
    sales = fact(spark, [(day(1, 7), 2), (day(1, 14), 4), (day(1, 8), 5), (None, 9)])
    assert rows(marts.average_sales_by_day_of_week(sales)) == [
        ("Воскресенье", 3.0), ("Неизвестный день", 9.0), ("Понедельник", 5.0),
    ]


def test_names_merge_and_unknown_keys_drop(spark, rows):
    sales = fact(
        spark,
        [
            (day(1), 1, 1, 1, 1, 1), (day(1), 2, 2, 2, 1, 2), (day(1), 4, 3, 3, 9, 1),
            (day(2), 8, None, None, 1, None), (day(2), 16, 1, 1, 1, 1),
        ],
    )
    seller = spark.createDataFrame([(1, "S"), (2, "S"), (3, "T")], "seller_id long, sales_person string")
    service = spark.createDataFrame([(1, "X"), (2, "X")], "service_id long, service string")
    country = spark.createDataFrame([(1, "C")], "country_id long, country string")
    resort = spark.createDataFrame([(1, "R"), (2, "R")], "resort_id long, resort string")
    assert rows(marts.average_sales_by_seller(sales, seller)) == [("S", 19 / 3), ("T", 4.0)]
    assert rows(marts.sales_by_service(sales, service)) == [("X", 19)]
    assert rows(marts.sales_by_country_and_region(sales, country, resort)) == [
        ("C", "R", day(1), 3), ("C", "R", day(2), 16),
    ]
    assert rows(marts.sales_by_employee(sales, seller)) == [
        ("S", day(1), 3), ("S", day(2), 16), ("T", day(1), 4),
    ]


def test_marts_sum_to_the_fact(spark):
    sales = fact(spark, [(day(1 + i % 12, 1 + i % 28), i, i % 7, i % 5, 1, i % 3) for i in range(300)])
    total = sales.agg(F.sum("price")).first()[0]
    seller = spark.range(7).select(F.col("id").alias("seller_id"), F.lit("s").alias("sales_person"))
    service = spark.range(5).select(F.col("id").alias("service_id"), F.lit("x").alias("service"))
    for mart, column in (
        (marts.monthly_sales(sales), "total_sales"),
        (marts.sales_by_service(sales, service), "total_sales"),
        (marts.sales_by_employee(sales, seller), "total_price"),
    ):
        assert mart.agg(F.sum(column)).first()[0] == total


def test_customer_age_groups(spark, rows):
    customer = spark.createDataFrame([(a,) for a in (5, 17, 18, 45, 80, 81, None)], "age long")
    assert rows(marts.customer_age_groups(customer)) == [("18-29", 1), ("40-49", 1), ("60-80", 1)]
    assert rows(marts.customer_age_groups(customer, REPEATED)) == [
        ("10-19", 2), ("40-49", 1), ("80 and Over", 2), ("Under 10", 1), ("Unknown", 1),
    ]


def sales_stage(spark):
    data = {
        "invoice_line": [(1, 10, 2, 3), (1, 11, 1, 1), (2, 10, 1, 1), (9, 10, 1, 1), (1, 99, 1, 1)],
        "sales": [(1, 5, day(1)), (2, 6, day(2)), (3, 5, day(3))],
        "service": [(10, "ski", 1, Decimal("2.50")), (11, "spa", 2, Decimal("7.00"))],
        "service_line": [(1, "sport", 100), (2, "rest", 101)],
        "resort": [(100, "A", 7), (101, "B", None)],
        "customer": [
            (5, "f", "l", 30, "p", "a", 1, 50, None), (6, "f", "l", None, "p", "a", 1, None, 5),
        ],
        "country": [(7, "C")],
        "sales_person": [(50, "S"), (50, "R")],
    }
    return {t: spark.createDataFrame(r, SALES_TABLES[t]) for t, r in data.items()}


def test_fact_follows_the_keys(spark, rows):
    stage = sales_stage(spark)
    found = star.fact_sale(stage)
    columns = ("inv_id", "service_id", "price", "seller_id", "resort_id", "country_id", "invoice_date")
    assert rows(found, *columns) == [
        (1, 10, Decimal("2.50"), 50, 100, 7, day(1)),
        (1, 11, Decimal("7.00"), 50, 101, None, day(1)),
        (2, 10, Decimal("2.50"), None, 100, 7, day(2)),
    ]
    amount = star.fact_sale(stage, measure="amount")
    assert rows(amount, "inv_id", "service_id", "price")[0] == (1, 10, Decimal("15.00"))
    with pytest.raises(ValueError, match="measure"):
        star.fact_sale(stage, measure="tips")


def test_dimension_has_one_row_per_key(spark, rows):
    stage = sales_stage(spark)
    assert rows(star.dim_seller(stage)) == [(50, "R")]
    assert star.dim_customer(stage).columns[-1] == "seller_id"
    for build in (star.dim_resort, star.dim_service, star.dim_country, star.dim_service_line):
        assert build(stage).count() > 0


# --- employees --------------------------------------------------------------
def test_current_state(spark, rows):
    def entry(record, ident, fio, date, region=1):
        return ("r", record, "CREATE", ident, fio, region, 2, 3, 4, 5, day(1, year=1990), date, "u", 9)

    log = spark.createDataFrame(
        [
            entry(1, 1, "A B C", day(1)), entry(2, 1, "A2 B2", day(2), region=8),
            entry(3, 2, None, day(1)), entry(4, 2, "X", None), entry(5, 3, None, day(1)),
        ],
        EMPLOYEE_LOG,
    )
    persons = employees.current_persons(log)
    assert rows(persons, "id_employee", "first_name", "last_name", "sur_name") == [
        (1, "A2", "B2", ""), (2, "X", "", ""), (3, None, None, None),
    ]
    employment = employees.current_employment(log)
    assert rows(employment, "id_employee", "id_region")[0] == (1, 8)
    assert dict(employment.dtypes)["l_faktor"] == "decimal(14,0)"
    only = employees.current_persons(log, ids=log.where("id_employee = 1"))
    assert rows(only, "id_employee") == [(1,)]


def test_advancing_batch_by_batch_equals_the_whole_log(spark, rows):
    from stagehouse.operators.merge import upsert
    from stagehouse.schemas import EMPLOYMENT, PERSONS

    rng = random.Random(7)
    log = spark.createDataFrame([], EMPLOYEE_LOG)
    persons, employment = spark.createDataFrame([], PERSONS), spark.createDataFrame([], EMPLOYMENT)
    for number in range(3):
        entries = [
            (
                f"r{number}", 100 * number + i, "CREATE", rng.randrange(12), f"N{number} {i}",
                i, 2, 3, 4, 5, day(1), rng.choice([None, *(day(m) for m in range(1, 5))]), "u", 9,
            )
            for i in range(20)
        ]
        batch = spark.createDataFrame(entries, EMPLOYEE_LOG)
        newer = employees.advance(batch, employment)
        persons = upsert(persons, employees.persons_of(newer), ["id_employee"])
        employment = upsert(employment, employees.employment_of(newer), ["id_employee"])
        persons, employment = (
            spark.createDataFrame(persons.collect(), PERSONS),
            spark.createDataFrame(employment.collect(), EMPLOYMENT),
        )
        log = log.unionByName(batch)
    assert rows(persons) == rows(employees.current_persons(log))
    assert rows(employment) == rows(employees.current_employment(log))


# --- emissions --------------------------------------------------------------
def emission_tables(spark):
    objects = [
        (2, "c2", "Old  name", "here \t there", "IV", 1), (1, "c1", "", None, "I", 1),
        (3, "c3", "n", "l", "I", 2), (4, "c4", "n", "l", "IV", 3), (5, "c5", "n", "l", "II", 3),
    ]
    orgs = [
        (1, 'ООО "Ромашка"', "141400, Московская область, г. Химки, ул. Мира, д. 1", "ИНН 77"),
        (2, "ИП Х", "nowhere", ""),
        (3, "ИП Y", None, None),
    ]
    totals = [(1, 1, "1 000,5"), (2, 2, ""), (3, 3, None), (4, 4, "2"), (6, 6, "9")]
    count = "nvos_id long, {} long, {} string"
    return {
        "nvosentities": spark.createDataFrame(
            objects, "nvos_id long, code string, name string, location string, category string, org_id long"
        ),
        "organizations": spark.createDataFrame(
            orgs, "org_id long, organization_name string, legal_address string, inn string"
        ),
        "emissions": spark.createDataFrame(totals, count.format("source_count", "total_emission")),
        "discharges": spark.createDataFrame(totals, count.format("discharge_count", "total_discharge")),
        "waste": spark.createDataFrame(totals, count.format("object_count", "total_mass")),
        "greenhousegases": spark.createDataFrame(
            [(i, t) for i, _, t in totals], "nvos_id long, co2_emission string"
        ),
    }


def test_extract_drops_unmeasured_objects(spark, rows):
    tables = emission_tables(spark)
    assert rows(extract_emissions(tables), "nvos_id") == [(1,), (2,), (3,), (4,)]
    assert rows(extract_emissions(tables, [2, 5]), "nvos_id") == [(2,)]


def test_normalise(spark, rows):
    result = emissions.normalise(extract_emissions(emission_tables(spark)))
    assert rows(result.address) == [
        (1, None, None, None, None, None),
        (2, "141400", "Московская обл", "г. Химки", "ул. Мира", "д. 1"),
    ]
    # A blank and a missing INN get ids of their own and look alike afterwards.
    assert rows(result.organizations) == [(1, None, None), (2, None, None), (3, "Ромашка", "77")]
    assert rows(result.organizations_x_address) == [(1, 1, 1), (2, 2, 1), (3, 3, 2)]
    assert rows(result.object_category, "id", "category_code", "category_name", "category_num") == [
        (1, "I", "Первая категория", 1), (13, "IV", "Четвёртая категория", 4),
    ]
    assert rows(result.objects, "id", "nvos_id", "object_name", "object_location", "category_id") == [
        (9, 1, None, None, 1), (18, 2, "Old name", "here there", 13),
        (27, 3, "n", "l", 1), (36, 4, "n", "l", 13),
    ]
    assert rows(result.environmental_emissions) == [
        (1, 3, 9, 1000.5, 1000.5, 1000.5, 1000.5), (2, 3, 18, 0.0, 0.0, 0.0, 0.0),
        (3, 2, 27, 0.0, 0.0, 0.0, 0.0), (4, 1, 36, 2.0, 2.0, 2.0, 2.0),
    ]


def test_an_object_may_come_once(spark):
    tables = emission_tables(spark)
    tables["waste"] = tables["waste"].union(tables["waste"])
    with pytest.raises(ValueError, match="comes 2 times"):
        emissions.normalise(extract_emissions(tables))


@pytest.mark.parametrize("code", ["V", None])
def test_unknown_category_fails(spark, code):
    df = spark.createDataFrame([(1, code)], "nvos_id long, object_category string")
    with pytest.raises(Exception, match="unknown object category"):
        emissions.dim_category(df)
    with pytest.raises(Exception, match="unknown object category"):
        emissions.category_recode(df, "object_category").collect()


def test_no_objects(spark):
    df = spark.createDataFrame([], "nvos_id long, object_category string")
    assert emissions.dim_category(df).count() == 0


def test_new_categories_continue(spark, rows):
    found = spark.createDataFrame(
        [(1, "d", "IV", 4), (13, "a", "I", 1)],
        "id long, category_name string, category_code string, category_num long",
    )
    known = found.where("category_code = 'I'")
    assert rows(emissions.new_categories(found, known), "id", "category_code") == [(25, "IV")]
    assert rows(emissions.new_categories(found, known.limit(0))) == rows(found)
