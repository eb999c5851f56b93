import datetime as dt

import pytest
from pyspark.sql import functions as F

from stagehouse.functions import address, buckets, dates, text


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, expression, values, kind="string"):
    return [r[0] for r in column(spark, values, kind).select(expression(F.col("v"))).collect()]


def test_weekday_labels(spark):
    days = [dt.datetime(2024, 1, 7) + dt.timedelta(days=i) for i in range(7)] + [None]
    plain = apply(spark, dates.weekday_label, days, "timestamp_ntz")
    assert plain[0] == "Воскресенье" and plain[1] == "Понедельник" and plain[6] == "Суббота"
    assert plain[7] == "Неизвестный день"
    shifted = apply(spark, lambda c: dates.weekday_label(c, dates.SHIFTED), days, "timestamp_ntz")
    assert shifted[0] == "Понедельник" and shifted[6] == "Воскресенье"
    assert apply(spark, dates.day_of_week, days[:7], "timestamp_ntz") == list(range(7))


def test_age_buckets(spark):
    ages = [9, 10, 17, 18, 29, 30, 59, 60, 79, 80, 81, None]
    history = apply(spark, buckets.age_bucket, ages, "long")
    assert history == [
        "Unknown", "Unknown", "Unknown", "18-29", "18-29", "30-39", "50-59", "60-80", "60-80",
        "60-80", "Unknown", "Unknown",
    ]
    repeated = apply(spark, lambda c: buckets.age_bucket(c, buckets.REPEATED), ages, "long")
    assert repeated == [
        "Under 10", "10-19", "10-19", "10-19", "20-29", "30-39", "50-59", "60-69", "70-79",
        "80 and Over", "80 and Over", "Unknown",
    ]


def test_name_parts(spark):
    names = [None, "Иванов", "Иванов Иван", "Иванов  Иван", "a b c d", ""]
    parts = [apply(spark, lambda c, i=i: text.name_part(c, i), names) for i in (1, 2, 3)]
    assert list(zip(*parts, strict=True)) == [
        (None, None, None),
        ("Иванов", "", ""),
        ("Иванов", "Иван", ""),
        ("Иванов", "", "Иван"),
        ("a", "b", "c"),
        ("", "", ""),
    ]


ADDRESSES = {
    "postcode": {"141400, x": "141400", "1234": None, "1234567": "123456", None: None},
    "region": {
        "1, Московская область, x": "Московская обл",
        "1, Пермский край, x": "Пермский край",
        "Пермский край": None,
        "1, Пермский край": "Пермский край",
    },
    "locality": {
        "a, г. Йошкар-Ола, x": "г. Йошкар-Ола",
        "a, г. Нижний Новгород, x": None,
        "a, село Ёлкино, z": None,
        "a, посёлок Лесной, z": "посёлок Лесной",
        "a, c Горки, z": "c Горки",
        "a, г. Химки": None,
    },
    "street": {
        "a, улица Ленина, д. 5": "улица",
        "a, ул. Ленина, д. 5": "ул. Ленина",
        "a, Ленина ул., д. 5": None,
        "a, пр-кт Мира": "пр-кт Мира",
        None: None,
    },
    "house_number": {
        "a, Д. 12Б": "Д. 12Б",
        "a, дом 7а": "дом 7а",
        "a, д 3": "д 3",
        "д. 3": None,
    },
}


@pytest.mark.parametrize("part", address.PARTS)
def test_address_parts(spark, part):
    cases = ADDRESSES[part]
    found = apply(spark, lambda c: address.address_part(c, part), list(cases))
    assert dict(zip(cases, found, strict=True)) == cases


def test_org_name(spark):
    cases = {'ООО "А "Б""': 'А "Б"', "ИП `Х`": "Х", 'ООО ""': "", "ИП Иванов": None, None: None}
    assert apply(spark, text.org_name, list(cases)) == list(cases.values())


def test_digits_and_whitespace(spark):
    assert apply(spark, text.digits_only, ["ИНН 77 01", "", None]) == ["7701", "", None]
    values = ["a  b", "a \t b", "a\\s+b", None]
    assert apply(spark, text.collapse_whitespace, values) == ["a b", "a b", "a\\s+b", None]
    literal = apply(spark, lambda c: text.collapse_whitespace(c, compat_literal=True), values)
    assert literal == ["a  b", "a \t b", "a b", None]


def test_parse_decimal(spark):
    values = ["1 234,5", "1 234,5", "", None, "-0,25"]
    assert apply(spark, text.parse_decimal, values) == [1234.5, 1234.5, None, None, -0.25]
    for bad in ("abc", " "):
        with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
            apply(spark, text.parse_decimal, [bad])


def test_blanks_to_null(spark):
    df = spark.createDataFrame([("", 1, None), ("a", None, " ")], "a string, b int, c string")
    assert [tuple(r) for r in text.blanks_to_null(df).collect()] == [
        (None, 1, None),
        ("a", None, " "),
    ]


def test_route_priority(spark):
    names = ["companies_region.xml", "companies.xml", "employee_1.xml", "Region.xml", "note"]
    assert apply(spark, text.route_by_name, names) == [
        "region", "companies", "employee", None, None,
    ]


def test_composite_key(spark):
    df = spark.createDataFrame([(1, 23), (12, 3), (5, None), (None, None)], "a long, b long")
    keys = [r[0] for r in df.select(text.composite_key(F.col("a"), F.col("b"))).collect()]
    assert keys == ["123", "123", "5", ""]
