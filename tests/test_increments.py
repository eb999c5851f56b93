import datetime as dt
import random
from decimal import Decimal

import pytest

from stagehouse.functions.buckets import REPEATED
from stagehouse.operators import watermark
from stagehouse.plans import increments, jobs, star
from stagehouse.schemas import SALES_TABLES
from stagehouse.sinks.warehouse import Warehouse
from stagehouse.sources.tables import FrameSource, JdbcSource, ParquetSource, read_table

MARTS = [
    "sales_trends_by_month",
    "sales_with_moving_average",
    "sales_growth_by_month",
    "average_sales_by_day_of_week",
    "average_sales_by_seller",
    "sales_by_service",
    "customer_age_groups",
    "sales_by_country_and_region",
    "sales_by_employee",
]


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"), buckets=4)


def sales(seed=1):
    """All rows of a small source; a third of all lines have one service."""
    rng = random.Random(seed)
    data = {t: [] for t in SALES_TABLES}
    data["country"] = [(1, "C1"), (2, "C2")]
    data["resort"] = [(10, "R10", 1), (11, "R11", 2), (12, "R11", 2)]
    data["service_line"] = [(20, "L20", 10), (21, "L21", 11), (22, "L22", 12)]
    data["service"] = [(30 + k, f"S{k % 4}", 20 + k % 3, Decimal(k + 1) / 4 if k else None) for k in range(6)]
    data["sales_person"] = [(40, "A"), (41, "B"), (42, "A")]
    data["customer"] = [
        (k, "f", "l", rng.choice([None, 17, 25, 37, 64, 90]), "p", "a", 1, 40 + k % 3, None) for k in range(30)
    ]
    start = dt.datetime(2023, 10, 1)
    data["sales"] = [
        (k, rng.randrange(32), start + dt.timedelta(days=rng.randrange(400)) if k % 9 else None) for k in range(90)
    ]
    pairs = {(k, 31 if rng.random() < 0.35 else 30 + rng.randrange(7)) for k in range(95) for _ in range(3)}
    data["invoice_line"] = [(i, s, 2, 3) for i, s in sorted(pairs)]
    return data


def as_source(spark, data):
    return FrameSource({t: spark.createDataFrame(r, SALES_TABLES[t]) for t, r in data.items()})


def up_to(data, line, invoice, customer, late=()):
    part = dict(data)
    part["invoice_line"] = [r for r in data["invoice_line"] if r[0] < line and r[0] not in late]
    part["sales"] = [r for r in data["sales"] if r[0] < invoice and r[0] not in late]
    part["customer"] = [r for r in data["customer"] if r[0] < customer]
    return part


def assert_like_full_load(spark, rows, warehouse, data, tmp_path, name, **options):
    full = Warehouse(spark, str(tmp_path / name))
    jobs.initial_load(as_source(spark, data), full, options.get("measure", "price"))
    jobs.load_marts(full, "nds", buckets=REPEATED)
    for mart in MARTS:
        want, got = (w.snapshot("dds", mart) for w in (full, warehouse))
        assert rows(got) == rows(want), mart
        assert got.dtypes == want.dtypes, mart
    assert rows(increments.facts(warehouse, **options)) == rows(full.snapshot("nds", "fact_sale"))


def test_marts_equal_the_full_reload(spark, warehouse, rows, tmp_path):
    data = sales()
    # Lines come before their invoices and customers, and two invoices come late.
    for part, reconcile in [
        (up_to(data, 50, 40, 12, late=(7, 45)), False),
        (up_to(data, 80, 80, 25, late=(7, 45)), False),
    ]:
        assert increments.incremental_load(as_source(spark, part), warehouse, reconcile)
    late = up_to(data, 80, 80, 25)
    assert not increments.incremental_load(as_source(spark, late), warehouse)
    assert increments.incremental_load(as_source(spark, data), warehouse, reconcile=True)
    assert_like_full_load(spark, rows, warehouse, data, tmp_path, "full")
    assert len(warehouse.batch_ids(increments.LAYER, "by_seller").collect()) == 2


def test_changed_names_and_prices(spark, warehouse, rows, tmp_path):
    data = sales(3)
    increments.incremental_load(as_source(spark, up_to(data, 60, 99, 99)), warehouse)
    named = {**data, "sales_person": [(40, "A"), (41, "New"), (42, "B")]}
    increments.incremental_load(as_source(spark, named), warehouse)
    sellers = warehouse.snapshot("dds", "average_sales_by_seller")
    assert {r.sales_person for r in sellers.collect()} == {"A", "B", "New"}
    dearer = {**named, "service": [(*r[:3], Decimal(9)) if r[0] == 31 else r for r in named["service"]]}
    assert increments.incremental_load(as_source(spark, dearer), warehouse)
    assert_like_full_load(spark, rows, warehouse, dearer, tmp_path, "dearer")


def test_broken_load_is_run_again(spark, warehouse, rows, tmp_path, monkeypatch):
    data = sales(4)
    increments.incremental_load(as_source(spark, up_to(data, 40, 60, 20)), warehouse, measure="amount")
    with monkeypatch.context() as patch:
        patch.setattr(jobs, "write_marts", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            increments.incremental_load(as_source(spark, data), warehouse, measure="amount")
    assert warehouse.ledger.rows().where("status = 'FAILED'").count() == 1
    assert increments.incremental_load(as_source(spark, data), warehouse, measure="amount")
    assert_like_full_load(spark, rows, warehouse, data, tmp_path, "full", measure="amount")


def test_empty_source(spark, warehouse):
    nothing = as_source(spark, {t: [] for t in SALES_TABLES})
    increments.incremental_load(nothing, warehouse)
    assert all(warehouse.snapshot("dds", mart).isEmpty() for mart in MARTS)


def test_the_scan_compares_the_mark(spark, tmp_path):
    lines = [(k, s, 1, 1) for k in range(20) for s in (1, 2)]
    spark.createDataFrame(lines, SALES_TABLES["invoice_line"]).write.parquet(str(tmp_path / "invoice_line"))
    source = ParquetSource(spark, str(tmp_path))
    found = read_table(source, "invoice_line", low=17).where(
        watermark.past_mark(["inv_id", "service_id"], [17, 1])
    )
    assert sorted(r[:2] for r in found.collect()) == [(17, 2), (18, 1), (18, 2), (19, 1), (19, 2)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The plan's text is cut off behind the start of the second part.
    assert "GreaterThanOrEqual(inv_id,17), Or(GreaterThan(inv_id,17),And(EqualTo(inv_id," in plan


def test_bounds_from_the_mark(spark):
    source = JdbcSource(spark, "jdbc:none:")
    assert source.bounds_query("sales").endswith("FROM public.sales")
    assert source.bounds_query("sales", 41).endswith("FROM public.sales WHERE inv_id >= 41")


def test_lines_without_partners_are_kept(spark):
    stage = as_source(spark, sales()).tables
    placed = star.place_lines(stage["invoice_line"], stage["sales"], stage["customer"], star.service_terms(stage))
    assert placed.count() == stage["invoice_line"].count()
    assert placed.where("placed").count() == star.fact_sale(stage).count()
