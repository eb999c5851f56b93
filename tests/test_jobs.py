import datetime as dt
from decimal import Decimal

import pytest

import xmlfiles
from stagehouse import ledger
from stagehouse.functions.dates import SHIFTED
from stagehouse.plans import jobs
from stagehouse.schemas import (
    COMPANY_XML,
    EMPLOYEE_XML,
    REGION_NDS,
    REGION_XML,
    SALES_TABLES,
    TYPE_COMPANY,
)
from stagehouse.operators.typing import TooManyRejected
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.tables import FrameSource
from stagehouse.streaming.folder import watch_folder
from stagehouse.streaming.poll import watch_source


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), buckets=4)


def source(spark, lines):
    data = {t: [] for t in SALES_TABLES}
    data["invoice_line"] = [(i, 10, 2, 3) for i in lines]
    data["sales"] = [(i, 5, dt.datetime(2024, 1, 7)) for i in range(1, 9)]
    data["service"] = [(10, "ski", 1, Decimal("2.50"))]
    data["service_line"] = [(1, "sport", 100)]
    data["resort"] = [(100, "A", 7)]
    data["country"] = [(7, "C")]
    data["customer"] = [(5, "f", "l", 30, "p", "a", 1, 50, None)]
    data["sales_person"] = [(50, "S")]
    return FrameSource({t: spark.createDataFrame(r, SALES_TABLES[t]) for t, r in data.items()})


def test_initial_load(spark, warehouse, rows):
    jobs.initial_load(source(spark, [1, 2]), warehouse)
    mart = lambda name: rows(warehouse.snapshot("dds", name))
    sunday = dt.datetime(2024, 1, 7)
    assert mart("sales_trends_by_month") == [(2024, 1, Decimal("5.00"))]
    assert mart("sales_with_moving_average") == [(2024, 1, Decimal("5.00"), 5.0)]
    assert mart("sales_growth_by_month") == [(2024, 1, Decimal("5.00"), None, None)]
    assert mart("average_sales_by_day_of_week") == [("Воскресенье", 2.5)]
    assert mart("average_sales_by_seller") == [("S", 2.5)]
    assert mart("sales_by_service") == [("ski", Decimal("5.00"))]
    assert mart("customer_age_groups") == [("30-39", 1)]
    assert mart("sales_by_country_and_region") == [("C", "A", sunday, Decimal("5.00"))]
    assert mart("sales_by_employee") == [("S", sunday, Decimal("5.00"))]
    opened = warehouse.ledger.rows()
    assert opened.count() == 15 and opened.where("status = 'SUCCESS'").count() == 15
    # Each staged table has an id of its own.
    assert opened.select("request_id").distinct().count() == 15


def test_repeated_load_follows_the_source(spark, warehouse, rows, tmp_path):
    jobs.initial_load(source(spark, [1, 2]), warehouse)
    assert not jobs.refresh_if_changed(source(spark, [1, 2]), warehouse)
    grown = source(spark, [1, 2, 3])
    query = watch_source(
        spark, grown, warehouse, str(tmp_path / "clock"), once=True, labels=SHIFTED
    )
    query.awaitTermination()
    assert rows(warehouse.snapshot("dds", "sales_by_service")) == [("ski", Decimal("7.50"))]
    assert rows(warehouse.snapshot("dds", "average_sales_by_day_of_week")) == [("Понедельник", 2.5)]
    assert warehouse.snapshot("ods", "fact_sale").count() == 3
    assert warehouse.snapshot("ods", "dim_seller").count() == 1
    assert not jobs.refresh_if_changed(grown, warehouse)


def test_a_refresh_may_look_at_values(spark, warehouse, rows):
    jobs.initial_load(source(spark, [1, 2]), warehouse)
    assert not jobs.refresh_if_changed(source(spark, [2, 1]), warehouse, values=True)
    other = source(spark, [1, 3])
    assert not jobs.refresh_if_changed(other, warehouse)
    assert rows(jobs.value_drift(other, warehouse)) == [(0, 1, 1, 0)]
    assert jobs.refresh_if_changed(other, warehouse, values=True)
    assert not jobs.refresh_if_changed(other, warehouse, values=True)


def test_a_failed_staging_is_recorded(spark, warehouse):
    broken = FrameSource({"country": spark.createDataFrame([], SALES_TABLES["country"])})
    with pytest.raises(KeyError):
        jobs.stage_sales(broken, warehouse)
    assert warehouse.ledger.rows().where("status = 'FAILED'").count() == 15


def test_a_refresh_that_failed_is_done_again(spark, warehouse, rows, monkeypatch):
    lines = source(spark, [1, 2])
    broken = FrameSource({"invoice_line": lines.load("invoice_line")})
    with pytest.raises(KeyError):
        jobs.refresh_if_changed(broken, warehouse)
    # Staging is whole from here on, so the row counts agree.
    for step in ("load_star", "copy_layer", "load_marts"):
        with monkeypatch.context() as patch:
            patch.setattr(jobs, step, lambda *_: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError):
                jobs.refresh_if_changed(lines, warehouse)
        assert not jobs.source_drift(lines, warehouse).first()["changed"]
        assert not jobs.last_load_finished(warehouse)
    assert jobs.refresh_if_changed(lines, warehouse)
    assert rows(warehouse.snapshot("dds", "sales_by_service")) == [("ski", Decimal("5.00"))]
    # Two of the three versions of the star are kept.
    assert warehouse.expire("nds", "fact_sale") == 0
    assert warehouse.expire("nds", "fact_sale", keep=1) == 1
    assert not jobs.refresh_if_changed(lines, warehouse)


# --- files ------------------------------------------------------------------
def put(folder, name, kind, values):
    return xmlfiles.write(folder / name, [xmlfiles.record(kind, v) for v in values])


def test_employee_files(spark, warehouse, rows, tmp_path):
    first = put(tmp_path, "employee_1.xml", EMPLOYEE_XML, [xmlfiles.employee(1), xmlfiles.employee(2)])
    second = put(
        tmp_path,
        "employee_2.xml",
        EMPLOYEE_XML,
        [xmlfiles.employee(2, "X Y Z"), xmlfiles.employee(3, date="2023-01-01"), xmlfiles.employee("07")],
    )
    requests = [jobs.stage_file(warehouse, EMPLOYEE_XML, path) for path in (first, second)]
    assert jobs.apply_all_employees(warehouse) == requests
    assert jobs.apply_employees(warehouse) is None
    log = jobs.employee_log(warehouse)
    assert rows(log, "id_employee", "mode") == [
        (1, "CREATE"), (2, "CREATE"), (2, "UPDATE"), (3, "CREATE"),
    ]
    assert log.select("record_id").distinct().count() == 4
    persons = jobs.current_persons(warehouse)
    # Both entries of 2 have one date: the later file wins.
    assert rows(persons, "id_employee", "first_name") == [(1, "A"), (2, "X"), (3, "A")]
    employment = jobs.current_employment(warehouse)
    assert rows(employment, "id_employee") == [(1,), (2,), (3,)]
    merged = rows(persons), rows(employment)
    jobs.rebuild_employees(warehouse)
    assert (rows(jobs.current_persons(warehouse)), rows(jobs.current_employment(warehouse))) == merged


def files_of(folder):
    return {str(f): f.stat().st_mtime_ns for f in folder.rglob("*.parquet")}


def test_an_upsert_leaves_other_partitions_alone(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), buckets=8)
    schema = REGION_NDS.fieldNames()
    names = lambda ids, name: spark.createDataFrame(
        [(i, name, *[None] * (len(schema) - 2)) for i in ids], REGION_NDS
    )
    assert warehouse.merge_keyed(names(range(40), "old"), "nds", "r", ["id_region"], REGION_NDS) == 8
    before = files_of(tmp_path)
    assert warehouse.merge_keyed(names([7], "new"), "nds", "r", ["id_region"], REGION_NDS) == 1
    after = files_of(tmp_path / "wh")
    kept = {f for f, at in after.items() if before.get(f) == at}
    assert {f.split("key_bucket=")[1][0] for f in after if f not in kept} == {
        f.split("key_bucket=")[1][0] for f in before if f not in after and "key_bucket=" in f
    }
    assert len({f.split("key_bucket=")[1][0] for f in kept}) == 7
    assert warehouse.merge_keyed(names([], "none"), "nds", "r", ["id_region"], REGION_NDS) == 0
    found = rows(warehouse.keyed("nds", "r", REGION_NDS), "id_region", "region_name")
    assert found == [(i, "new" if i == 7 else "old") for i in range(40)]
    with pytest.raises(Exception, match="duplicate key"):
        warehouse.merge_keyed(names([1, 1], "twice"), "nds", "r", ["id_region"], REGION_NDS)
    # A null key is a row of its own.
    warehouse.merge_keyed(names([None], "null"), "nds", "r", ["id_region"], REGION_NDS)
    assert warehouse.keyed("nds", "r", REGION_NDS).count() == 41


def test_backlog_ends_where_one_at_a_time_ends(spark, tmp_path, rows):
    one, all_at_once = (Warehouse(spark, str(tmp_path / name), buckets=2) for name in ("one", "all"))
    for name, values in (
        ("employee_1.xml", [xmlfiles.employee(1), xmlfiles.employee(2, date="2023-01-01")]),
        ("employee_2.xml", [xmlfiles.employee("007")]),
        ("employee_3.xml", [xmlfiles.employee(2, "X Y Z", date="2023-01-01"), xmlfiles.employee(3), xmlfiles.employee(3, "Q")]),
        ("employee_4.xml", [xmlfiles.employee(1, "old", date="2000-01-01"), xmlfiles.employee(3, "W")]),
    ):
        path = put(tmp_path, name, EMPLOYEE_XML, values)
        for warehouse in (one, all_at_once):
            jobs.stage_file(warehouse, EMPLOYEE_XML, path, request_id=name)
    taken = []
    while (request := jobs.apply_employees(one)) is not None:
        taken.append(request)
    assert jobs.apply_all_employees(all_at_once) == sorted([*taken]) == [f"employee_{i}.xml" for i in range(1, 5)]
    assert jobs.apply_all_employees(all_at_once) == []
    for table in (jobs.employee_log, jobs.current_persons, jobs.current_employment):
        assert rows(table(one)) == rows(table(all_at_once)), table
    status = lambda w: rows(w.ledger.rows(), "filename", "status")
    assert status(one) == status(all_at_once)


def test_records_are_numbered_as_they_stand(spark, warehouse, tmp_path):
    files = tmp_path / "files"
    files.mkdir()
    put(files, "b.xml", EMPLOYEE_XML, [xmlfiles.employee(i) for i in (9, 3, 7)])
    put(files, "a.xml", EMPLOYEE_XML, [xmlfiles.employee(i) for i in (8, 1)])
    put(files, "c.xml", EMPLOYEE_XML, [xmlfiles.employee(5)])
    first = jobs.stage_file(warehouse, EMPLOYEE_XML, f"{files}/*.xml")
    second = jobs.stage_file(warehouse, EMPLOYEE_XML, str(files / "c.xml"))
    found = [
        [(r.record_id, r.id_employee) for r in jobs.staged_file(warehouse, EMPLOYEE_XML, request)
         .orderBy("record_id").collect()]
        for request in (first, second)
    ]
    assert found == [
        [(1, "8"), (2, "1"), (3, "9"), (4, "3"), (5, "7"), (6, "5")], [(7, "5")],
    ]


def test_a_broken_off_run_is_done_again(spark, warehouse, rows, tmp_path, monkeypatch):
    path = put(tmp_path, "employee_1.xml", EMPLOYEE_XML, [xmlfiles.employee(1)])
    request = jobs.stage_file(warehouse, EMPLOYEE_XML, path)
    with monkeypatch.context() as patch:
        patch.setattr(Warehouse, "append_batch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            jobs.apply_employees(warehouse)
    assert jobs.employee_log(warehouse).count() == 0
    assert jobs.apply_employees(warehouse) == request
    assert rows(jobs.employee_log(warehouse), "id_employee", "mode") == [(1, "CREATE")]
    assert jobs.current_persons(warehouse).count() == 1


def test_a_request_without_usable_rows_leaves_the_queue(spark, warehouse, tmp_path):
    path = put(tmp_path, "employee_1.xml", EMPLOYEE_XML, [xmlfiles.employee("007")])
    request = jobs.stage_file(warehouse, EMPLOYEE_XML, path)
    assert jobs.apply_all_employees(warehouse) == [request]
    assert warehouse.ledger.rows().first().status == ledger.EMPTY


def test_records_that_do_not_parse_may_be_set_aside(spark, warehouse, rows, tmp_path):
    files = {
        "employee_1.xml": [xmlfiles.employee(1), xmlfiles.employee(2, date="soon"), xmlfiles.employee("x", region="y")],
        "employee_2.xml": [xmlfiles.employee(3), xmlfiles.employee(2)],
        "employee_3.xml": [xmlfiles.employee(4, region="far")],
    }
    requests = [
        jobs.stage_file(warehouse, EMPLOYEE_XML, put(tmp_path, name, EMPLOYEE_XML, values), request_id=name)
        for name, values in files.items()
    ]
    with pytest.raises(TooManyRejected, match="3 of 6"):
        jobs.apply_all_employees(warehouse, most_rejected=0.4)
    assert jobs.employee_log(warehouse).isEmpty()
    assert jobs.apply_all_employees(warehouse, most_rejected=0.5) == requests
    log = jobs.employee_log(warehouse)
    assert sorted(rows(log, "id_employee", "mode")) == [(1, "CREATE"), (2, "CREATE"), (3, "CREATE")]
    aside = jobs.rejected_employees(warehouse)
    assert sorted(rows(aside, "request_id", "rejected")) == [
        ("employee_1.xml", "date_devations"),
        ("employee_1.xml", "id_employee,id_region"),
        ("employee_3.xml", "id_region"),
    ]
    assert aside.where("get_json_object(raw, '$.id_region') = 'far'").count() == 1
    # The request that had nothing else leaves the queue.
    assert jobs.apply_all_employees(warehouse, most_rejected=0.5) == []


def test_region_files_upsert(spark, warehouse, rows, tmp_path):
    for name, values in (
        ("region_1.xml", [xmlfiles.region(1, "old"), xmlfiles.region(2, "two")]),
        ("region_2.xml", [xmlfiles.region(1, "new", f_value="7")]),
    ):
        jobs.stage_file(warehouse, REGION_XML, put(tmp_path, name, REGION_XML, values))
        jobs.apply_regions(warehouse)
    regions = jobs.current_regions(warehouse)
    assert rows(regions, "id_region", "region_name", "population", "f_value") == [
        (1, "new", 3, 7), (2, "two", 3, None),
    ]


def test_company_files_append(spark, warehouse, rows, tmp_path):
    values = [xmlfiles.company(1), xmlfiles.company(2, kind=None), xmlfiles.company(3, kind="S")]
    path = put(tmp_path, "companies_1.xml", COMPANY_XML, values)
    jobs.apply_companies(warehouse)
    for _ in range(2):
        jobs.stage_file(warehouse, COMPANY_XML, path)
        jobs.apply_companies(warehouse)
    types = warehouse.snapshot("nds", jobs.TYPE_COMPANY_TABLE, TYPE_COMPANY)
    assert rows(types) == [(1, None), (2, "S"), (3, "T")]
    # A file delivered twice is appended twice, but its names stay single.
    assert rows(jobs.companies(warehouse), "id_company", "type_company_cd") == [
        (1, 3), (1, 3), (3, 2), (3, 2),
    ]


def test_polled_folder(spark, warehouse, rows, tmp_path):
    queue, archive = tmp_path / "queue", tmp_path / "archive"
    queue.mkdir()
    put(queue, "employee_1.xml", EMPLOYEE_XML, [xmlfiles.employee(1)])
    put(queue, "region_1.xml", REGION_XML, [xmlfiles.region(1)])
    (queue / "note.txt").write_text("x")
    assert jobs.stage_running(warehouse, REGION_XML, str(queue)) is None
    request = jobs.register_new_file(warehouse, str(queue))
    assert jobs.stage_running(warehouse, EMPLOYEE_XML, str(queue)) is None
    assert jobs.stage_running(warehouse, REGION_XML, str(queue), str(archive)) == request
    assert [p.name for p in archive.iterdir() if not p.name.startswith(".")] == ["region_1.xml"]
    request = jobs.register_new_file(warehouse, str(queue))
    jobs.stage_running(warehouse, EMPLOYEE_XML, str(queue), str(archive))
    assert jobs.apply_all_employees(warehouse) == [request]
    assert jobs.register_new_file(warehouse, str(queue)) is None
    # A file that failed is new again; one of a loaded name is not.
    (queue / "region_2.xml").write_text("<records><record>")
    failed = jobs.register_new_file(warehouse, str(queue))
    with pytest.raises(ValueError, match="cut off"):
        jobs.stage_running(warehouse, REGION_XML, str(queue), str(archive))
    put(queue, "region_1.xml", REGION_XML, [xmlfiles.region(1)])
    again = jobs.register_new_file(warehouse, str(queue))
    assert again not in (failed, None)
    found = warehouse.ledger.rows().where("filename = 'region_2.xml'")
    assert rows(found, "status") == [("FAILED",), ("RUNNING",)]


# --- folder stream ----------------------------------------------------------
def run_watch(spark, tmp_path, warehouse, **options):
    query = watch_folder(
        spark, str(tmp_path / "queue"), warehouse, str(tmp_path / "checkpoint"), once=True, **options
    )
    query.awaitTermination()


def test_watched_folder(spark, warehouse, rows, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    put(queue, "employee_1.xml", EMPLOYEE_XML, [xmlfiles.employee(1)])
    put(queue, "companies_of_region.xml", REGION_XML, [xmlfiles.region(1)])
    put(queue, "note.xml", REGION_XML, [xmlfiles.region(9)])
    run_watch(spark, tmp_path, warehouse, archive=str(tmp_path / "archive"))
    done = warehouse.ledger.rows()
    assert rows(done, "table_name", "filename", "status") == [
        ("DWH_AO_0regions", "companies_of_region.xml", "SUCCESS"),
        ("DWH_DSO_1STGemployees", "employee_1.xml", "SUCCESS"),
    ]
    assert rows(jobs.current_regions(warehouse), "id_region") == [(1,)]
    run_watch(spark, tmp_path, warehouse, archive=str(tmp_path / "archive"))
    assert warehouse.ledger.rows().count() == 2
    put(queue, "employee_2.xml", EMPLOYEE_XML, [xmlfiles.employee(1, "Q Q Q")])
    run_watch(spark, tmp_path, warehouse, archive=str(tmp_path / "archive"))
    assert rows(jobs.employee_log(warehouse), "id_employee", "mode") == [(1, "CREATE"), (1, "UPDATE")]
    archived = [p.name for p in (tmp_path / "archive").rglob("*.xml")]
    assert "employee_1.xml" in archived


def test_a_broken_file_loads_once_it_is_repaired(spark, warehouse, rows, tmp_path):
    queue = tmp_path / "queue"
    queue.mkdir()
    records = [xmlfiles.record(REGION_XML, xmlfiles.region(i)) for i in range(3)]
    xmlfiles.write(queue / "region_1.xml", records, closed=False)
    with pytest.raises(Exception, match="(?i)malformed|failed_read_file|exception"):
        run_watch(spark, tmp_path, warehouse)
    assert rows(warehouse.ledger.rows(), "filename", "status") == [("region_1.xml", "FAILED")]
    assert warehouse.ledger.loaded_files().count() == 0
    xmlfiles.write(queue / "region_1.xml", records)
    run_watch(spark, tmp_path, warehouse)
    assert rows(warehouse.ledger.rows(), "filename", "status") == [("region_1.xml", "SUCCESS")]
    assert jobs.current_regions(warehouse).count() == 3


# --- emissions --------------------------------------------------------------
def test_emissions_job_goes_on_after_the_last_key(spark, warehouse, rows):
    from test_plans import emission_tables

    tables = emission_tables(spark)
    read = lambda name: warehouse.read_committed(
        jobs.EMISSIONS_LAYER, name, jobs.EMISSION_SCHEMAS[name]
    )
    jobs.emissions_job(tables, warehouse, nvos_ids=[2, 4])
    assert rows(read("object_category"), "id", "category_code") == [(1, "IV")]
    assert rows(read("address"), "id") == [(1,), (2,)]
    jobs.emissions_job(tables, warehouse, nvos_ids=[1])
    assert rows(read("object_category"), "id", "category_code") == [(1, "IV"), (13, "I")]
    # Object 1 brings an organisation that is stored already.
    assert rows(read("organizations"), "id", "org_name") == [(1, None), (2, "Ромашка")]
    assert rows(read("objects"), "nvos_id", "category_id") == [(1, 13), (2, 1), (4, 1)]
    facts = read("environmental_emissions")
    links = dict(rows(facts, "nvos_id", "org_address_id"))
    assert len(links) == 3 and links[1] == links[2] != links[4]


def test_emission_runs_keep_stored_ids(spark, warehouse, rows):
    from test_plans import emission_tables

    tables = emission_tables(spark)
    read = lambda name: warehouse.read_committed(
        jobs.EMISSIONS_LAYER, name, jobs.EMISSION_SCHEMAS[name]
    )
    jobs.emissions_job(tables, warehouse, nvos_ids=[2, 4])
    jobs.emissions_job(tables, warehouse, only_new=True)
    keyed = {name: rows(read(name)) for name in jobs.KEYED_TABLES}
    facts = rows(read("environmental_emissions"), "nvos_id", "org_address_id")
    assert [n for n, _ in facts] == [1, 2, 3, 4]
    # The same objects once more: new facts, but not one key.
    jobs.emissions_job(tables, warehouse)
    assert {name: rows(read(name)) for name in jobs.KEYED_TABLES} == keyed
    assert rows(read("environmental_emissions"), "nvos_id", "org_address_id") == sorted(facts * 2)
    for name, start in (("address", 1), ("organizations", 1), ("organizations_x_address", 1), ("object_category", 2)):
        values = [tuple(v or None for v in row[start:]) for row in keyed[name]]
        assert len(values) == len(set(values)), name
    # Nothing is left that is not stored.
    assert jobs.unknown_objects(tables, warehouse)["nvosentities"].where("nvos_id <= 4").isEmpty()
