import pytest

import xmlfiles
from stagehouse.schemas import COMPANY_XML, EMPLOYEE_XML, REGION_XML, SALES_TABLES
from stagehouse.sources import xml
from stagehouse.sources.tables import FrameSource, JdbcSource, ParquetSource, read_table


@pytest.mark.parametrize("table", list(SALES_TABLES))
def test_snapshot_reads_declared_columns_only(spark, tmp_path, table):
    schema = SALES_TABLES[table]
    wide = spark.createDataFrame([], schema).withColumn("unwanted", schema_value())
    wide.write.parquet(str(tmp_path / table))
    df = read_table(ParquetSource(spark, str(tmp_path)), table)
    assert df.schema.fieldNames() == schema.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in schema]
    scan = df._jdf.queryExecution().executedPlan().toString()
    assert "unwanted" not in scan.split("ReadSchema")[-1]


def schema_value():
    from pyspark.sql import functions as F

    return F.lit("x")


def test_frame_source_casts(spark):
    df = spark.createDataFrame([(1, "C", 0)], "country_id int, country string, more int")
    found = read_table(FrameSource({"country": df}), "country")
    assert found.dtypes == [("country_id", "bigint"), ("country", "string")]


def test_jdbc_reads_in_slices(spark):
    source = JdbcSource(spark, "jdbc:postgresql://db/sales", {"user": "u"}, num_partitions=8)
    assert source.bounds_query("sales") == (
        "SELECT MIN(inv_id) AS low, MAX(inv_id) AS high FROM public.sales"
    )
    assert source.count_query("sales") == "SELECT COUNT(*) AS n FROM public.sales"
    assert source.slice_options("sales", 1, 900) == {
        "table": "public.sales", "column": "inv_id", "lowerBound": 1, "upperBound": 901,
        "numPartitions": 8,
    }
    assert source.slice_options("sales", None, None) == {"table": "public.sales"}


# --- XML --------------------------------------------------------------------
KINDS = {"employee": EMPLOYEE_XML, "region": REGION_XML, "companies": COMPANY_XML}


@pytest.mark.parametrize("kind", list(KINDS))
@pytest.mark.parametrize("split", [False, True])
def test_every_child_reaches_its_column(spark, tmp_path, kind, split):
    record = KINDS[kind]
    values = [f"v{i}" for i in range(len(record.elements))]
    path = xmlfiles.write(tmp_path / f"{kind}.xml", [xmlfiles.record(record, values)])
    df = xml.read_xml(spark, path, record, split)
    assert df.columns == record.stage_columns
    assert [tuple(r) for r in df.collect()] == [tuple(values)]


@pytest.mark.parametrize("split", [False, True])
def test_blank_missing_padded_and_unknown_children(spark, tmp_path, rows, split):
    values = [["1", "", *[None] * 9], ["2", "  a & <b> ", *[None] * 9], [None] * 11]
    extra = "<Чужое>x</Чужое>"
    path = xmlfiles.write(
        tmp_path / "e.xml", [xmlfiles.record(EMPLOYEE_XML, v, extra) for v in values]
    )
    df = xml.read_xml(spark, path, EMPLOYEE_XML, split)
    assert rows(df, "id_employee", "fio", "uik") == [
        (None, None, None), ("1", "", None), ("2", "  a & <b> ", None),
    ]


@pytest.mark.parametrize("split", [False, True])
@pytest.mark.parametrize("cut", ["inside", "between"])
def test_cut_off_file_fails(spark, tmp_path, split, cut):
    records = [xmlfiles.record(REGION_XML, xmlfiles.region(i)) for i in range(50)]
    if cut == "inside":
        records[-1] = records[-1][:40]
    xmlfiles.write(tmp_path / "bad.xml", records, closed=False)
    xmlfiles.write(tmp_path / "good.xml", records[:10])
    with pytest.raises(Exception, match="(?i)malformed|failed_read_file|cut off"):
        xml.read_xml(spark, str(tmp_path), REGION_XML, split).collect()


@pytest.mark.parametrize("split", [False, True])
def test_folder_and_empty_document(spark, tmp_path, split):
    for name, count in (("a.xml", 3), ("b.xml", 0), ("c.xml", 2)):
        records = [xmlfiles.record(REGION_XML, xmlfiles.region(i)) for i in range(count)]
        xmlfiles.write(tmp_path / name, records)
    assert xml.read_xml(spark, str(tmp_path), REGION_XML, split).count() == 5


def test_one_big_file_is_parsed_by_many_tasks(spark, tmp_path, rows):
    records = [xmlfiles.record(EMPLOYEE_XML, xmlfiles.employee(i)) for i in range(4000)]
    path = xmlfiles.write(tmp_path / "big.xml", records)
    whole = xml.read_xml(spark, path, EMPLOYEE_XML)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        split = xml.read_xml_split(spark, path, EMPLOYEE_XML)
        assert split.rdd.getNumPartitions() > 4
        assert rows(split) == rows(whole)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_list_files(spark, tmp_path):
    (tmp_path / "a.xml").write_text("x")
    found = xml.list_files(spark, str(tmp_path)).collect()
    assert [(r.filename, r.length) for r in found] == [("a.xml", 1)]


def test_file_without_bytes_fails(spark, tmp_path):
    (tmp_path / "empty.xml").write_bytes(b"")
    with pytest.raises(ValueError, match="empty"):
        xml.read_xml(spark, str(tmp_path), REGION_XML)


def test_comment_after_the_root_is_no_damage(spark, tmp_path):
    (tmp_path / "a.xml").write_text("<r><record></record></r>\n<!-- end -->\n<?done?>\n")
    xml.check_complete(spark, str(tmp_path))
