import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))

import check_oracle  # noqa: E402
import __spark_entry__ as contract  # noqa: E402
from stagehouse.catalog import oracle  # noqa: E402
from stagehouse.catalog.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


def test_every_query_has_its_sql():
    assert set(oracle.oracle_sql()) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_its_sql(spark, con, name):
    verdict = check_oracle.compare(spark, con, SF, name, contract.oracle_sql().get(name))
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def test_flagship(spark):
    df = contract.entry(spark)
    assert df.columns == ["sale_year", "sale_month", "total_sales", "moving_average"]
    assert df.count() == 80
