import pytest

from stagehouse import ledger
from stagehouse.schemas import struct
from stagehouse.session import scratch_root
from stagehouse.sinks.warehouse import Warehouse

SCHEMA = struct("k:long v")


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_a_batch_replaces_itself_only(spark, warehouse, rows):
    name = "/DWH/AO/0country"
    assert warehouse.stage(name, SCHEMA).count() == 0
    warehouse.append_stage(frame(spark, (1, "a")), name, "r1")
    warehouse.append_stage(frame(spark, (2, "b")), name, "0042")
    warehouse.append_stage(frame(spark, (1, "a2")), name, "r1")
    found = warehouse.stage(name, SCHEMA)
    assert found.columns == ["request_id", "k", "v"]
    assert rows(found) == [("0042", 2, "b"), ("r1", 1, "a2")]
    assert rows(warehouse.staged(name, SCHEMA, "0042")) == [("0042", 2, "b")]
    assert warehouse.staged(name, SCHEMA, "none").count() == 0
    assert warehouse.staged(name, SCHEMA, None).count() == 0
    assert rows(warehouse.batch_ids("stg", name)) == [("0042",), ("r1",)]
    assert warehouse.batch_ids("stg", "nothing").count() == 0
    pruned = found.where("request_id = 'r1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(request_id" in pruned


def test_snapshot_is_rewritten_from_itself(spark, warehouse, rows):
    assert warehouse.snapshot("dds", "t", SCHEMA).count() == 0
    with pytest.raises(ValueError, match="no snapshot"):
        warehouse.snapshot("dds", "t")
    warehouse.replace(frame(spark, (1, "a")), "dds", "t")
    first = warehouse.snapshot("dds", "t")
    warehouse.replace(first.union(frame(spark, (2, "b"))), "dds", "t")
    assert rows(warehouse.snapshot("dds", "t")) == [(1, "a"), (2, "b")]
    assert rows(first) == [(1, "a")]
    assert warehouse.expire("dds", "t", keep=1) == 1
    assert rows(warehouse.snapshot("dds", "t")) == [(1, "a"), (2, "b")]


def test_an_uncommitted_version_is_not_read(spark, warehouse, rows, tmp_path):
    warehouse.replace(frame(spark, (1, "a")), "dds", "t")
    (tmp_path / "wh" / "dds" / "t" / "v=000000009-broken").mkdir()
    assert rows(warehouse.snapshot("dds", "t")) == [(1, "a")]


def test_ledger(warehouse, rows):
    log = warehouse.ledger
    assert log.rows().count() == 0
    first = log.open("T", "a.xml")
    second = log.open("T", "b.xml")
    assert log.running("T").first().request_id == first
    log.close(first, ledger.SUCCESS)
    assert tuple(log.running("T").first()) == (second, "b.xml")
    log.close(second, ledger.FAILED)
    assert log.running("T").count() == 0
    assert rows(log.loaded_files()) == [("a.xml",)]
    opened = log.rows().where(f"request_id = '{second}'").first()
    log.open("T", "b.xml", request_id=second)
    again = log.rows().where(f"request_id = '{second}'").first()
    assert (again.status, again.load_date) == (ledger.RUNNING, opened.load_date)
    assert len(log.open_all(["X", "Y"])) == 2
    assert rows(log.rows().where("status = 'CREATE'"), "table_name") == [("X",), ("Y",)]


def test_a_compacted_ledger_reads_the_same(spark, warehouse, rows):
    log = warehouse.ledger
    log.compact()
    ids = [log.open("T", f"{i}.xml") for i in range(3)]
    log.close(ids[0], ledger.SUCCESS)
    log.close(ids[1], ledger.FAILED)
    before = rows(log.rows())
    log.compact()
    assert rows(log.rows()) == before and len(log._events().inputFiles()) == 1
    log.close(ids[2], ledger.SUCCESS)
    assert rows(log.loaded_files()) == [("0.xml",), ("2.xml",)]


def test_ledger_frames(spark, rows):
    entries = spark.createDataFrame(
        [("1", "a", "SUCCESS"), ("2", "b", "RUNNING"), ("3", "c", "FAILED"), ("4", "d", None)],
        "request_id string, filename string, status string",
    )
    assert rows(ledger.loaded_files(entries)) == [("a",)]
    listing = spark.createDataFrame([(n,) for n in "abcda"], "filename string")
    assert rows(ledger.new_files(listing, entries)) == [("b",), ("c",), ("d",)]
    changed = ledger.with_status(entries, "2", ledger.SUCCESS)
    assert rows(changed, "request_id", "status") == [
        ("1", "SUCCESS"), ("2", "SUCCESS"), ("3", "FAILED"), ("4", None),
    ]


def test_several_tables_appear_together(spark, warehouse, rows):
    request = warehouse.ledger.open("both")
    warehouse.write_together({"a": frame(spark, (1, "a")), "b": frame(spark, (2, "b"))}, "x", request)
    assert warehouse.read_committed("x", "a", SCHEMA).count() == 0
    warehouse.ledger.close(request, ledger.SUCCESS)
    assert rows(warehouse.read_committed("x", "b", SCHEMA)) == [(2, "b")]


def test_scratch_is_cleared(spark):
    import os

    from stagehouse.session import clear_scratch, materialize

    df = materialize(frame(spark, (1, "a")), "t")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://"))
    assert os.path.exists(folder)
    clear_scratch(spark)
    assert not os.path.exists(folder)


def test_a_job_leaves_no_scratch(spark):
    import os

    from stagehouse.session import job_scratch, materialize

    with job_scratch(spark):
        inside = materialize(frame(spark, (1, "a")), "t").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(inside)
    assert not os.path.exists(inside)


def test_scratch_folder_is_the_shared_one(spark):
    assert scratch_root(spark).startswith(spark.sparkContext.getConf().get("spark.checkpoint.dir"))
