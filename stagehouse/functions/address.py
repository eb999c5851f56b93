"""Parts of a free-text Russian postal address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stagehouse.functions.text import first_group

# The patterns that decide what counts as each address part. One
# locality alternative is a Latin c, "д." has an unescaped dot, the letter
# class lacks "ё", and only group 1 is kept; results depend on all of it.
POSTCODE = r"(\d{5,6})"
REGION = r",\s*([А-Яа-я]*\s(край|обл|область))"
LOCALITY = (
    r",\s*((?:г\.|г|город|с\.|c|село|п\.|п|пос(е|ё)лок|д\.|д.|деревня)\s*[А-Яа-я-]*)\s*,"
)
STREET = (
    r",\s*((пр-кт|ул\.|ул|улица|пр-д)\s*[А-Яа-я]*),?|,\s*([А-Яа-я]*\s*(улица|ул\.|ул)),?"
)
HOUSE_NUMBER = r",\s*((д|д\.|дом)\s*\d{1,4}[а-я]*)"

# (?U): \s and \d cover Unicode; (?iU): case is folded for Cyrillic too.
PATTERNS = {
    "postcode": "(?U)" + POSTCODE,
    "region": "(?U)" + REGION,
    "locality": "(?U)" + LOCALITY,
    "street": "(?U)" + STREET,
    "house_number": "(?iU)" + HOUSE_NUMBER,
}
PARTS = list(PATTERNS)


def address_part(column: Column, part: str) -> Column:
    return first_group(column, PATTERNS[part]).alias(part)


def address_parts(column: str) -> list[Column]:
    return [address_part(F.col(column), part) for part in PARTS]
