"""XML files of the queries, from tables whose first task reads no rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from stagehouse.catalog import inputs, job_queries
from stagehouse.catalog.queries import upsert_regions
from stagehouse.schemas import EMPLOYEE_XML, REGION_XML

KEPT = "spark.sql.files.maxPartitionBytes"


def event(i, days=0.8):
    """``days`` after the one before; by an employee of five."""
    ts = datetime.datetime(2024, 1, 1) + datetime.timedelta(days=i * days)
    return (i, ts, i % 5, f"e{i}", float(i), "{}")


def put(spark, folder, table, values):
    frame = spark.createDataFrame(values, inputs.GIVEN[table])
    frame.coalesce(1).write.parquet(f"{folder}/{table}.parquet")


@pytest.fixture
def split_tables(spark, tmp_path):
    """Writes a table as one row group, which the second task reads: its middle lies there."""
    before = spark.conf.get(KEPT)

    def write(table, values):
        put(spark, tmp_path, table, values)
        (part,) = (tmp_path / f"{table}.parquet").glob("part-*")
        footer = int.from_bytes(part.read_bytes()[-8:-4], "little") + 8
        spark.conf.set(KEPT, str((part.stat().st_size - footer) // 3 + 1))
        read = inputs.given(spark, str(tmp_path), table).select(F.spark_partition_id())
        assert read.distinct().collect() == [(1,)]
        return str(tmp_path)

    yield write
    spark.conf.set(KEPT, before)


def test_employee_job_with_a_first_task_without_rows(spark, split_tables, rows):
    events = [event(i) for i in range(1, 37)]
    found = rows(job_queries.job_employees_files(spark, split_tables("events", events)))
    last = {user: (name, ts) for _, ts, user, name, *_ in events}
    assert found == [
        (user, name, f"u{user}", "x", datetime.datetime(ts.year, ts.month, ts.day) - datetime.timedelta(days=user))
        for user, (name, ts) in sorted(last.items())
    ]


def test_xml_employees_with_a_first_task_without_rows(spark, split_tables, rows):
    folder = split_tables("events", [event(i) for i in range(60)])
    stage = inputs.employee_stage(spark, folder)
    assert rows(job_queries.xml_employees(spark, folder)) == rows(stage, *EMPLOYEE_XML.stage_columns)


def test_xml_employees_split_with_a_first_task_without_rows(spark, split_tables, rows):
    folder = split_tables("events", [event(i) for i in range(60)])
    stage = inputs.employee_stage(spark, folder)
    found = rows(job_queries.xml_employees_split(spark, folder))
    assert found == rows(stage, *EMPLOYEE_XML.stage_columns)


def customer(key):
    return (key, f"C{key}", key % 5, key + 0.25, ("BUILDING", "MACHINERY")[key % 2])


def test_region_job_with_a_first_task_without_rows(spark, split_tables, rows):
    folder = split_tables("customer", [customer(key) for key in range(60)])
    assert rows(job_queries.job_regions_file(spark, folder)) == rows(upsert_regions(spark, folder))


def test_region_job_takes_the_newest_delivery_that_has_rows(spark, tmp_path, rows):
    put(spark, tmp_path, "customer", [customer(key) for key in (0, 1, 3, 4)])
    found = job_queries.job_regions_file(spark, str(tmp_path))
    assert rows(found, "id_region", "region_name") == [(1, "C1"), (3, "old C3"), (4, "C4")]
    assert rows(found) == rows(upsert_regions(spark, str(tmp_path)))


def test_jobs_without_any_delivery(spark, tmp_path, rows):
    for table in ("customer", "events", "part"):
        put(spark, tmp_path, table, [])
    assert rows(job_queries.job_regions_file(spark, str(tmp_path))) == []
    assert rows(job_queries.job_companies_file(spark, str(tmp_path))) == []
    assert rows(job_queries.job_employees_files(spark, str(tmp_path))) == []


def test_xml_regions_with_a_first_task_without_rows(spark, split_tables, rows):
    folder = split_tables("customer", [customer(key) for key in range(60)])
    stage = inputs.region_stage(spark, folder)
    assert rows(job_queries.xml_regions(spark, folder)) == rows(stage, *REGION_XML.stage_columns)
