"""Registered corpus queries run over whole tables; those with SQL agree with it; the pipeline chains."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "tools"))

import __spark_entry__ as contract  # noqa: E402
import corpus_pipeline  # noqa: E402
from check_oracle import compare, connect  # noqa: E402
from stagehouse.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
NOT_A_ROW_EACH = ("op2_decontaminate", "op13_embedding_whitening")
TABLE = {"op7_warc": "pages", "op8_embedding_neardup": "embeddings"}


@pytest.mark.parametrize("name", list(queries.ORACLE_SQL))
def test_agrees_with_its_sql(spark, name):
    assert compare(spark, connect(SF), SF, name, queries.ORACLE_SQL[name]).startswith("ok")


@pytest.mark.parametrize("name", [q for q in queries.QUERIES if q not in (*queries.ORACLE_SQL, *NOT_A_ROW_EACH)])
def test_returns_a_row_per_row(spark, name):
    table = spark.read.parquet(f"{SF}/{TABLE.get(name, 'documents')}.parquet")
    assert contract.queries()[name](spark, SF).count() == table.count()


def test_pipeline_runs(spark):
    out = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert set(docs.columns) <= set(out.columns) and 0 < out.count() <= 3 * docs.count()
